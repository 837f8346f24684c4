"""Histogram tree ensembles for many models at once (ML4-ML9): boosting with all five search parameters, bagged forests.

Features are binned once, at exact quantiles. Rows with the same bins and fold have the same margin in every round, so
they make one cell with its counts of zeros and ones (a forest's cells have such counts for each tree's sample); cells
are summed by a shuffle and stored in blocks. Derivatives, losses and confusion counts of a cell are those of a row
times its counts. All models (trials, folds of a cross-validation, trees of a forest) grow their next tree together:

* A node with more than ``SMALL`` cells is divided by one Spark aggregate over (model, node, feature, bin) of
  first and second derivatives, made by the tasks of the blocks; the planner combines and shuffles them, and
  windows over the bins give each node's best split.
* The cells of smaller nodes are sent, packed, to the task of their (model, node), which grows the rest of
  the subtree; a model with so few cells in all gets its next rounds there, too (all of them if its trees aren't
  asked for). Both ways find the same splits: derivatives are whole multiples of 2**-24, so sums don't depend
  on how rows fall into tasks, and equal gains go to the first feature and the lowest bin.
* Boosting goes on where it stands: margins are stored every ``KEEP`` rounds, and only the rounds since then are
  applied again. No tree is ever fitted twice, and a run with a ``state`` folder goes on after a lost driver.

A split's gain is 1/2 (s(left) + s(right) - s(node)), s = T(G)^2 / (H + lambda), T shrinking |G| by alpha; a leaf
is -T(G) / (H + lambda) times the learning rate. Each child needs a sum of second derivatives of min_child_weight.
Null and NaN are a bin of their own, under all others.

The driver holds the trees of a round (two entries a leaf), and tasks get them as broadcasts. With ``keep=False`` it holds
none: a model that isn't one task's has its cells in a table of its own (``_OWN``), where the tasks that grow its subtrees
put the new margins, so the driver gets the divided nodes, losses and counts only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.operators.quantiles import kth_values, long_values
from tallyspark.session import materialize, remove_path, shared_path, shuffles_removed, workers_import

#: Derivatives are whole multiples of 1 / SCALE, losses of 1 / LOSS_SCALE.
SCALE, LOSS_SCALE = float(1 << 24), float(1 << 32)
#: Cells of a block, cells and bins of a node that one task may finish, rounds between stored margins.
BLOCK, SMALL, SMALL_BINS, KEEP = 8192, 1 << 20, 1 << 24, 4
#: Rounds and nodes of trees that a task may add at once to a model whose cells it has, and rounds with a state folder.
AHEAD, AHEAD_NODES, AHEAD_STATE = 1024, 20_000, 32
#: Rows that a task makes cells of at once, cells that a bucket is for, trees of a forest that share a table of cells.
TOGETHER, BUCKET, TREES = 1 << 18, 1 << 16, 128
#: Nodes times bins up to which sums of a level are laid out whole (more, if it has more cells), and those of one feature.
WHOLE, PLACES = 1 << 11, 1 << 23
#: Bins of a feature beside the one of nulls.
BINS = 64
#: A split must gain more.
LEAST_GAIN = 1e-6

#: A tree's nodes, root first; a right child follows its left one. Without gain and cover it still gives values.
TREE = np.dtype([("feature", "i2"), ("cut", "i2"), ("left", "i4"), ("value", "f8"), ("gain", "f8"), ("cover", "f8")])
SLIM = np.dtype(TREE.descr[:4])
#: Bounds of 16-bit draws for 0, 1, 2, ... copies of a row in a sample with replacement (Poisson, mean 1).
COPIES = [round(65536 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(8)]


@dataclass(frozen=True)
class Spec:
    """One model: its parameters, the fold that it is validated on (-1: none), and for trees of a forest the features
    tried at a node and the number that its hashes start with."""
    max_depth: int = 6
    learning_rate: float = 0.3
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    fold: int = -1
    node_features: int = 0
    tree: int = -1
    seed: str = "42"

    @classmethod
    def of(cls, params: Mapping, fold: int = -1) -> Spec:
        names = ("max_depth", "learning_rate", "reg_alpha", "reg_lambda", "min_child_weight")
        return cls(**{k: (int if k == "max_depth" else float)(params[k]) for k in names if k in params}, fold=fold)


@dataclass
class Binned:
    """A table whose features are to be bins: its rows (x, y, fold, key), and its cells in blocks."""
    spark: SparkSession
    rows: DataFrame
    features: list[str]
    cuts: list[np.ndarray]
    sizes: dict[int, int]          # rows of each fold

    @cached_property
    def table(self) -> DataFrame:
        return cells(self)


@dataclass
class Boosted:
    """What boosting gives: for each model its trees, its loss and confusion counts (tp, fp, tn, fn) after each round."""
    trees: list[list[np.ndarray]]
    losses: list[list[float]]
    counts: list[list[tuple[int, int, int, int]]]
    best: list[int | None] = field(default_factory=list)     # None: no rows
    stop: list[int | None] = field(default_factory=list)
    fitted: int = 0                # trees that were grown in this run


# ------------------------------------------------------------------ binning

def bin_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper bounds of the bins of each feature: its values at the ranks ceil(i * n / bins). F x bins numbers."""
    def ranks(n: DataFrame) -> DataFrame:
        i = F.explode(F.sequence(F.lit(1), F.lit(bins - 1))).alias("_tid")
        return n.select("column_name", "_n", i).withColumn("_rank", F.floor((F.col("_tid") * F.col("_n") + bins - 1) / bins).cast("bigint"))

    found = kth_values(long_values(df, features), ["column_name"], ranks).select("column_name", "_value").distinct().collect()
    cuts: dict[str, set] = {f: set() for f in features}
    for r in found:
        cuts[r["column_name"]].add(float(r["_value"]))
    return [np.array(sorted(cuts[f])) for f in features]


def binned(df: DataFrame, features: Sequence[str], label: str, fold: str | None = None, key: str | None = None, bins: int = BINS,
           cuts: list[np.ndarray] | None = None) -> Binned:
    """A table with the bounds of its bins; ``key`` is needed by forests only."""
    if not 2 <= bins <= 254:
        raise ValueError("bins must be from 2 to 254")
    spark, features = df.sparkSession, list(features)
    workers_import(spark)
    cuts = bin_cuts(df, features, bins) if cuts is None else cuts
    rows = df.select(F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("x"), F.col(label).cast("int").alias("y"),
                     (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"),
                     (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"))
    sizes: dict[int, int] = {}
    for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["fold"]] = r["n"]
    return Binned(spark, rows, features, cuts, sizes)


def bin_numbers(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """0 for null and NaN, else 1 + the number of bounds under the value."""
    out = np.zeros(x.shape, np.uint8)
    for j, c in enumerate(cuts):
        v = x[:, j]
        out[:, j] = np.where(np.isnan(v), 0, 1 + np.searchsorted(c, v, side="left"))
    return out


_CELLS = "n bigint, bins binary, zeros binary, ones binary, fold binary"
#: Blocks of one model's cells, each with its margin; what a step gives for a node and round.
_OWN = f"{_CELLS}, margins binary, m int"
_OWN_NAMES = [x.split()[0] for x in _OWN.split(", ")]
_GIVEN = "node int, turn int, tree binary, loss bigint, seen array<bigint>"


def cells(data: Binned, trees: Sequence[Spec] = ()) -> DataFrame:
    """Blocks of the table's cells: rows with the same bins and fold, with their counts of zeros and ones; for ``trees``
    cells of bins alone, with such counts of each tree's sample. A task makes cells of its rows, buckets sum them."""
    spark, cuts, width = data.spark, data.cuts, max(1, len(trees))
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = max(tasks, sum(data.sizes.values()) * width // (BUCKET * 16))
    made = data.rows.mapInArrow(lambda batches: _row_cells(batches, cuts, trees, buckets), "bucket int, what binary, zeros binary, ones binary")
    dealt = made.repartition(min(buckets, 4 * tasks), "bucket")     # a number of its own: the blocks are few bytes for much work
    return materialize(dealt.groupBy("bucket").applyInArrow(lambda rows: _bucket_cells(rows, len(cuts), width), _CELLS), "blocks")


def _merged(what: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cells (rows of bytes) and the sums of their counts."""
    packed = np.zeros((len(what), -(-what.shape[1] // 8) * 8), np.uint8)
    packed[:, :what.shape[1]] = what
    words = packed.view(np.uint64)
    order = np.lexsort(words.T)
    words = words[order]
    first = np.flatnonzero(np.append(True, (words[1:] != words[:-1]).any(1))[:len(words)])
    return what[order][first], *[np.add.reduceat(v[order], first, axis=0, dtype=np.int64) if len(first) else v for v in (zeros, ones)]


def _row_cells(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray], trees: Sequence[Spec], buckets: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= TOGETHER:
            yield _cells_of(pa.Table.from_batches(held), cuts, trees, buckets)
            held, n = [], 0
    if n:
        yield _cells_of(pa.Table.from_batches(held), cuts, trees, buckets)


def _cells_of(rows: pa.Table, cuts: list[np.ndarray], trees: Sequence[Spec], buckets: int) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    n = rows.num_rows
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False).astype(float) for c in rows.column(0).chunks])     # nulls come as NaN
    bins = bin_numbers(flat.reshape(n, len(cuts)), cuts)
    y, fold = (np.nan_to_num(rows.column(i).to_numpy().astype(float)).astype(np.int32) for i in (1, 2))
    ones = (y == 1)[:, None]
    if trees:
        fold[:] = 0
        weight = tree_copies(trees, rows.column(3).to_pylist())
        zeros, ones = np.where(ones, 0, weight), np.where(ones, weight, 0)
    else:
        zeros = ~ones
    what, zeros, ones = _merged(np.concatenate([fold.view(np.uint8).reshape(n, 4), bins], 1), zeros, ones)
    bucket = np.zeros(len(what), np.uint64)
    for j in range(what.shape[1]):
        bucket = (bucket ^ what[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        bucket ^= bucket >> np.uint64(29)
    bucket = (bucket % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    full, first = np.unique(bucket[order], return_index=True)
    parts = np.split(order, first[1:])
    return pa.RecordBatch.from_arrays([pa.array(full), *[pa.array([v[i].tobytes() for i in parts], pa.binary())
                                                         for v in (what, zeros.astype(np.int32), ones.astype(np.int32))]], names=["bucket", "what", "zeros", "ones"])


def _bucket_cells(rows: pa.Table, n_features: int, width: int) -> pa.Table:
    what, zeros, ones = [np.frombuffer(b"".join(rows.column(i).to_pylist()), t).reshape(-1, k)
                         for i, t, k in ((1, np.uint8, 4 + n_features), (2, np.int32, width), (3, np.int32, width))]
    what, zeros, ones = _merged(what, zeros, ones)
    out: list[list] = [[], [], [], [], []]
    for at in range(0, len(what), BLOCK):
        part = slice(at, at + BLOCK)
        for column, v in zip(out, (len(what[part]), what[part, 4:].tobytes(), *_counts(zeros[part], ones[part]), what[part, :4].tobytes()), strict=True):
            column.append(v)
    return pa.table({k: pa.array(v, pa.int64() if k == "n" else pa.binary()) for k, v in zip(("n", "bins", "zeros", "ones", "fold"), out, strict=True)})


def _counts(zeros: np.ndarray, ones: np.ndarray) -> list[bytes]:
    """Counts in the least type that holds a block's; readers tell it from the number of bytes."""
    kind = np.promote_types(*[np.min_scalar_type(v.max()) for v in (zeros, ones)])
    return [v.astype(kind).tobytes() for v in (zeros, ones)]


def node_size(n_cells: int, rows: int) -> int:
    """What a node counts for: its cells, or more if it has so many rows that sums of their derivatives in one task would not be exact."""
    return max(n_cells, rows >> 8)


# ------------------------------------------------------------------ one tree, in numpy

def shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def node_features(spec: Spec, path: str, n: int) -> list[int]:
    """The features tried at a node: all, or those with the smallest hashes."""
    if not spec.node_features or spec.node_features >= n:
        return list(range(n))
    order = sorted(range(n), key=lambda f: hashlib.md5(f"{spec.seed}:{spec.tree}:{path}:{f}".encode()).hexdigest())
    return sorted(order[:spec.node_features])


def shrunk_square(g, alpha: float):
    return np.maximum(np.abs(g) - alpha, 0.0) ** 2


def _whole_level(bins: np.ndarray, node: np.ndarray, g: np.ndarray, h: np.ndarray, gs: np.ndarray, hs: np.ndarray, top: np.ndarray, width: int,
                 spec: Spec, tried: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gain, feature or -1, bin) of each node's best split, from sums over (feature, node, bin) laid out whole. An empty bin has the gain of
    the one before, and equal gains go to the lowest bin; a side without cells is too light."""
    n, k = len(bins), len(gs)
    place = (bins + (node * width + np.arange(n)[:, None] * (k * width))).ravel()
    lg, lh = (np.bincount(place, np.tile(v, n), n * k * width).reshape(n, k, width).cumsum(2) / SCALE for v in (g, h))
    right_h = hs[:, None] - lh
    fine = (lh >= spec.min_child_weight) & (right_h >= spec.min_child_weight)
    if tried is not None:
        fine &= tried[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        s = (shrunk_square(lg, spec.reg_alpha) / (lh + spec.reg_lambda)
             + shrunk_square(gs[:, None] - lg, spec.reg_alpha) / (right_h + spec.reg_lambda))
        gain = np.where(fine, 0.5 * (s - top[:, None]), -np.inf)
    cut = gain.argmax(2)
    gain = np.take_along_axis(gain, cut[:, :, None], 2)[:, :, 0]
    feature, nodes = gain.argmax(0), np.arange(k)
    best, cut = gain[feature, nodes], cut[feature, nodes]
    good = best > LEAST_GAIN
    return np.where(good, best, LEAST_GAIN), np.where(good, feature, -1), np.where(good, cut, 0)


def grow(columns: np.ndarray, g: np.ndarray, h: np.ndarray, spec: Spec, path: str = "1") -> tuple[np.ndarray, np.ndarray]:
    """The tree (``TREE`` records, root first) of cells with whole derivatives ``g`` and ``h``, and each cell's leaf; ``columns`` are
    their bins (a row for each feature), ``path`` is the root's place in the full tree."""
    n_features, width = len(columns), int(columns.max(initial=0)) + 1
    levels, made, depth, start = [], 1, len(path) - 1, 0
    rows, node, paths, leaf = np.arange(len(g)), np.zeros(len(g), np.int64), [path], np.zeros(len(g), np.int64)
    while paths:
        k = len(paths)
        leaf[rows] = start + node
        rg, rh = g[rows], h[rows]
        total_g, total_h = (np.bincount(node, v, k) for v in (rg, rh))          # whole numbers under 2**53: exact
        gs, hs = total_g / SCALE, total_h / SCALE
        top = shrunk_square(gs, spec.reg_alpha) / (hs + spec.reg_lambda)
        best, feature, cut = np.full(k, LEAST_GAIN), np.full(k, -1), np.zeros(k, np.int64)
        # Rows of nodes that are too light for two children stay as they are.
        heavy = hs >= 2 * spec.min_child_weight
        if not heavy.all():
            stay = np.flatnonzero(heavy[node])
            rows, node = rows[stay], node[stay]
            rg, rh = rg[stay], rh[stay]
        if depth < spec.max_depth and len(rows):
            before_g, before_h = (np.concatenate([[0.0], np.cumsum(np.where(heavy, v, 0.0))[:-1]]) for v in (total_g, total_h))
            first = node * width
            tried = None
            if spec.node_features:
                tried = np.zeros((n_features, k), bool)
                for i, p in enumerate(paths):
                    tried[node_features(spec, p, n_features), i] = True
            whole = k * width <= max(WHOLE, len(rows)) and spec.min_child_weight > 0
            if whole:
                best, feature, cut = _whole_level(columns[:, rows], node, rg, rh, gs, hs, top, width, spec, tried)
            for f in range(0 if whole else n_features):
                place = first + columns[f][rows]
                if k * width <= PLACES:                                # sums by place; only places with cells count
                    full = np.zeros(k * width, bool)
                    full[place] = True
                    place_at = np.flatnonzero(full)
                    sum_g, sum_h = (np.cumsum(np.bincount(place, v, k * width)[place_at]) for v in (rg, rh))
                else:
                    order = np.argsort(place)
                    place = place[order]
                    ends = np.flatnonzero(np.append(place[1:] != place[:-1], True))
                    place_at = place[ends]
                    sum_g, sum_h = (np.cumsum(v[order])[ends] for v in (rg, rh))
                at = place_at // width
                turn = at[1:] != at[:-1]
                fine = np.flatnonzero(~turn)                           # the last bin of a node leaves nothing on the right
                if tried is not None:
                    fine = fine[tried[f, at[fine]]]
                who = at[fine]
                lg, lh = (sum_g[fine] - before_g[who]) / SCALE, (sum_h[fine] - before_h[who]) / SCALE
                right_h = hs[who] - lh
                enough = np.flatnonzero((lh >= spec.min_child_weight) & (right_h >= spec.min_child_weight))
                if not len(enough):
                    continue
                if len(enough) < len(fine):
                    fine, who, lg, lh, right_h = fine[enough], who[enough], lg[enough], lh[enough], right_h[enough]
                s = (shrunk_square(lg, spec.reg_alpha) / (lh + spec.reg_lambda)
                     + shrunk_square(gs[who] - lg, spec.reg_alpha) / (right_h + spec.reg_lambda))
                gain = 0.5 * (s - top[who])
                firsts = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
                most = np.maximum.reduceat(gain, firsts)
                better = most > best[who[firsts]]
                if not better.any():
                    continue
                sizes = np.diff(np.append(firsts, len(who)))
                hit = np.flatnonzero(gain == np.repeat(most, sizes))
                foremost = hit[np.searchsorted(hit, firsts)]           # the lowest bin of each node's best
                mine = who[firsts][better]
                best[mine], feature[mine], cut[mine] = most[better], f, place_at[fine[foremost[better]]] - mine * width
        split = feature >= 0
        level = np.zeros(k, TREE)
        level["feature"], level["cut"], level["cover"] = feature, cut, hs
        level["gain"] = np.where(split, best, 0.0)
        level["value"] = np.where(split, 0.0, -shrunk(gs, spec.reg_alpha) / (hs + spec.reg_lambda) * spec.learning_rate)
        kids = made + 2 * (np.cumsum(split) - 1)
        level["left"] = np.where(split, kids, -1)
        levels.append(level)
        start += k
        made += 2 * int(split.sum())
        stay = np.flatnonzero(split[node])
        rows, node = rows[stay], node[stay]
        right = columns[feature[node], rows] > cut[node]
        node = 2 * (np.cumsum(split) - 1)[node] + right
        paths = [p + side for p, s in zip(paths, split.tolist(), strict=True) if s for side in "01"] if spec.node_features else [""] * (2 * int(split.sum()))
        depth += 1
    return np.concatenate(levels), leaf


def leaf_of(tree: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    feature, cut, left = (np.ascontiguousarray(tree[x]).astype(np.int64) for x in ("feature", "cut", "left"))
    flat, width = bins.ravel(), bins.shape[1]
    node, live, at = np.zeros(len(bins), np.int64), np.arange(len(bins)), np.zeros(len(bins), np.int64)
    while True:
        inner = np.flatnonzero(feature[at] >= 0)
        if len(inner) < len(live):
            node[live] = at
            live, at = live[inner], at[inner]
        if not len(live):
            return node
        at = left[at] + (flat[live * width + feature[at]] > cut[at])


# ------------------------------------------------------------------ all models, in Spark

def _blocks(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[tuple]:
    """(bins, zeros, ones, fold, margins or None) of each block; zeros and ones have a column, or one for each tree."""
    for b in batches:
        for i in range(b.num_rows):
            n = b.column(0)[i].as_py()
            bins, zeros, ones, fold = (b.column(j)[i].as_py() for j in range(1, 5))
            margins = np.frombuffer(b.column(5)[i].as_py(), float).reshape(n, -1) if b.num_columns > 5 else None
            yield np.frombuffer(bins, np.uint8).reshape(n, n_features), zeros, ones, np.frombuffer(fold, np.int32), margins


#: Copies of a row for each draw.
_COPIES_OF = np.searchsorted(COPIES, np.arange(1 << 16), side="right").astype(np.uint8)


def _draws(seed: str, group: int, keys: Sequence[str]) -> np.ndarray:
    """Draws (rows x 8) of eight trees: they share a digest."""
    start = f"{seed}:{group}:"
    return np.frombuffer(b"".join([hashlib.md5(f"{start}{k}".encode()).digest() for k in keys]), ">u2").reshape(-1, 8)


def copies(spec: Spec, keys: Sequence[str]) -> np.ndarray:
    """How often each row is in a tree's sample; eight trees share a digest."""
    return _COPIES_OF[_draws(spec.seed, spec.tree // 8, keys)[:, spec.tree % 8]].astype(np.int64)


def tree_copies(trees: Sequence[Spec], keys: Sequence[str]) -> np.ndarray:
    """The same of all trees (a column each), every digest made once."""
    out, made = np.zeros((len(keys), len(trees)), np.uint8), {}
    for j, s in enumerate(trees):
        which = (s.seed, s.tree // 8)
        if which not in made:
            made = {which: _COPIES_OF[_draws(*which, keys)]}
        out[:, j] = made[which][:, s.tree % 8]
    return out


def _margins(bins: np.ndarray, stored: np.ndarray | None, columns: list[int], active: list[int], since: list[dict]) -> np.ndarray:
    """Margins (rows x active models) after the stored rounds and those since."""
    if stored is None:
        out = np.zeros((len(bins), len(active)))
    else:
        out = stored[:, [columns.index(m) for m in active]].copy()
    for trees in since:
        for j, m in enumerate(active):
            for t in trees.get(m, ()):
                out[:, j] += t["value"][leaf_of(t, bins)]
    return out


def derivatives(spec: Spec, margins: np.ndarray | None, zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole first and second derivatives of the log loss, as floats; for a tree of a forest from the counts alone."""
    n = (zeros + ones).astype(float)
    if spec.tree >= 0:
        return -SCALE * ones, SCALE * n
    p = 1.0 / (1.0 + np.exp(-margins))
    return zeros * np.rint(p * SCALE) + ones * np.rint((p - 1) * SCALE), n * np.rint(p * (1.0 - p) * SCALE)


def parts_of(specs: list[Spec], active: list[int], margins_of, blocks) -> Iterator[tuple]:
    """(model, bins, zeros, ones, training cells, their margins, validation cells, their margins) for every block and model; no ``margins_of``:
    a forest, whose margins are none."""
    for bins, zeros, ones, fold, stored in blocks:
        width = 1 if margins_of else len(specs)
        kind = np.dtype(f"u{len(zeros) // (width * len(fold))}")
        zeros, ones = (np.frombuffer(v, kind).reshape(-1, width).astype(np.int64) for v in (zeros, ones))
        margins = margins_of and margins_of(bins, stored)
        for j, m in enumerate(active):
            if margins is None:
                learn = np.flatnonzero(zeros[:, m] + ones[:, m])
                yield m, bins, zeros[:, m], ones[:, m], learn, np.zeros(0), learn[:0], np.zeros(0)
            else:
                learn, held = np.flatnonzero(fold != specs[m].fold), np.flatnonzero(fold == specs[m].fold)
                yield m, bins, zeros[:, 0], ones[:, 0], learn, margins[learn, j], held, margins[held, j]


def own_parts(specs: list[Spec], batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[tuple]:
    """The same of models with cells of their own (``_OWN``)."""
    for b in batches:
        for m, block in zip(b.column("m").to_pylist(), _blocks([b], n_features), strict=True):
            yield from parts_of(specs, [m], lambda bins, stored: stored, [block])


def own_blocks(m: int, fold: int, bins: np.ndarray, zeros: np.ndarray, ones: np.ndarray, margins: np.ndarray) -> Iterator[tuple]:
    """Rows of ``_OWN``."""
    for at in range(0, len(bins), BLOCK):
        part = slice(at, at + BLOCK)
        n = len(bins[part])
        yield n, bins[part].tobytes(), *_counts(zeros[part], ones[part]), np.full(n, fold, np.int32).tobytes(), margins[part].tobytes(), m


@dataclass
class Round:
    """What a step gives a model: trees and, after each, validation loss (whole units) and confusion counts."""
    trees: list[np.ndarray]
    losses: list[int]
    seen: list[list[int]]


class _Grower:
    """Grows one tree for each active model."""

    def __init__(self, data: Binned, specs: list[Spec]):
        self.data, self.specs = data, specs
        self.size = None
        self.own: str | None = None     # the table of models with cells of their own

    def step(self, table: DataFrame, active: list[int], margins_of, ahead: dict[int, tuple[int, float, int]], kind=TREE, trees: bool = True) -> dict[int, Round]:
        """The next tree of each active model; of a model whose cells one task has, the next ones up to ``ahead[m]``:
        (rounds, least loss so far in whole units, rounds without a better one that end it). Without ``trees`` such a
        model gets all of them there, and they stay there; of other models margins are kept in ``own``."""
        self.active = active
        if self.own:
            table = self.data.spark.read.schema(_OWN).parquet(self.own).where(F.col("n").isNotNull() & F.col("m").isin(active))
        n_features = len(self.data.features)
        small = max(1, min(SMALL, SMALL_BINS // n_features))
        leaf = np.zeros(1, TREE)
        leaf["feature"] = -1
        tops = {m: leaf.copy() for m in active}
        paths = {m: {0: "1"} for m in active}
        large = {}
        if self.size is None:
            self.size = node_size(table.agg(F.sum("n").alias("n")).first()["n"] or 0, sum(self.data.sizes.values()))
        for m in active:
            if self.size > small and self.specs[m].max_depth > 0:
                large[m] = [0]
        apart = bool(large) and not trees
        alone = {} if apart else {m: ahead[m] for m in active if m in ahead and m not in large}
        while large:
            rows = self._best_splits(table, margins_of, tops, paths, large, n_features)
            large = {}
            for r in rows:
                if r["best"] is None:
                    continue
                m, at, top = r["m"], r["node"], tops[r["m"]]
                kids = len(top)
                top = tops[m] = np.concatenate([top, leaf, leaf])
                top["feature"][at], top["cut"][at], top["left"][at] = r["best"]["feature"], r["best"]["bin"], kids
                top["gain"][at], top["cover"][at] = r["best"]["gain"], r["h"] / SCALE
                for kid, side, n in ((kids, "0", r["best"]["c"]), (kids + 1, "1", r["c"] - r["best"]["c"])):
                    paths[m][kid] = paths[m][at] + side
                    if n > small and len(paths[m][kid]) - 1 < self.specs[m].max_depth:
                        large.setdefault(m, []).append(kid)
                del paths[m][at]
        return self._finish(table, margins_of, tops, paths, n_features, alone, kind, trees, apart)

    def _parts(self, margins_of, n_features):
        """How a task gets the parts of its blocks."""
        specs, active = self.specs, self.active
        if self.own:
            return lambda batches: own_parts(specs, batches, n_features)
        return lambda batches: parts_of(specs, active, margins_of, _blocks(batches, n_features))

    def _best_splits(self, table, margins_of, tops, paths, large, n_features):
        """The best split of every large node, by one aggregate over (model, node, feature, bin)."""
        specs, parts = self.specs, self._parts(margins_of, n_features)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, np.ndarray] = {}
            for m, bins, zeros, ones, learn, margins, *_ in parts(batches):
                if m not in large:
                    continue
                g, h = derivatives(specs[m], margins, zeros[learn], ones[learn])
                size = 1 + (zeros + ones >> 8)[learn]
                at = leaf_of(tops[m], bins[learn])
                for node in large[m]:
                    inside = np.flatnonzero(at == node)
                    for f in node_features(specs[m], paths[m][node], n_features):
                        b = bins[learn[inside], f]
                        got = held.setdefault((m, node, f), np.zeros((3, 256), np.int64))
                        for i, v in enumerate((g[inside], h[inside], size[inside])):
                            got[i] += np.bincount(b, v, 256).astype(np.int64)
            for (m, node, f), got in held.items():
                b = np.flatnonzero(got[2])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), v), t) for v, t in ((m, pa.int32()), (node, pa.int32()), (f, pa.int32()))]
                                                 + [pa.array(v.astype(np.int64)) for v in (b, *got[:, b])], names=["m", "node", "feature", "bin", "g", "h", "c"])

        each = table.mapInArrow(sums, "m int, node int, feature int, bin bigint, g bigint, h bigint, c bigint")
        hist = each.groupBy("m", "node", "feature", "bin").agg(*[F.sum(x).alias(x) for x in ("g", "h", "c")])
        terms = self.data.spark.createDataFrame(
            [(m, float(s.reg_alpha), float(s.reg_lambda), float(s.min_child_weight)) for m, s in enumerate(self.specs) if m in large],
            "m int, alpha double, lambda double, least double")            # a row for each model
        whole = Window.partitionBy("m", "node", "feature")
        upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        sides = hist.select("m", "node", "feature", "bin", *[F.sum(x).over(upto).alias(f"l{x}") for x in ("g", "h", "c")],
                            *[F.sum(x).over(whole).alias(x) for x in ("g", "h", "c")]).join(F.broadcast(terms), "m")

        def score(g, h):
            t = F.greatest(F.abs(g) - F.col("alpha"), F.lit(0.0))
            return t * t / (h + F.col("lambda"))

        gs, hs, lg, lh = (F.col(x) / SCALE for x in ("g", "h", "lg", "lh"))
        gain = 0.5 * (score(lg, lh) + score(gs - lg, hs - lh) - score(gs, hs))
        fine = (F.col("lc") < F.col("c")) & (lh >= F.col("least")) & (hs - lh >= F.col("least"))
        rated = sides.withColumn("gain", F.when(fine, gain)).withColumn("gain", F.when(F.col("gain") > LEAST_GAIN, F.col("gain")))
        order = F.when(F.col("gain").isNotNull(), F.struct("gain", -F.col("feature"), -F.col("bin")))
        return rated.groupBy("m", "node").agg(F.max("h").alias("h"), F.max("c").alias("c"), F.max_by(
            F.struct("feature", "bin", "gain", F.col("lc").alias("c")), order).alias("best")).collect()     # a row for each large node

    def _finish(self, table, margins_of, tops, paths, n_features, alone, kind, trees, apart):
        """The subtrees of all open nodes, each grown where its cells meet, with the validation loss after it; if models are ``apart``,
        their cells with the new margins are written in place of the trees."""
        specs, parts = self.specs, self._parts(margins_of, n_features)

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for m, bins, zeros, ones, learn, margins, held, held_margins in parts(batches):
                whole = len(tops[m]) == 1
                at, at_held = (np.zeros(len(v), int) if whole else leaf_of(tops[m], bins[v]) for v in (learn, held))
                out = []
                for node in paths[m]:
                    a, b = np.flatnonzero(at == node), np.flatnonzero(at_held == node)
                    if len(a) + len(b):
                        out.append((m, node, *[v.tobytes() for i, x in ((learn[a], margins[a] if len(margins) else margins), (held[b], held_margins[b]))
                                               for v in (bins[i], x, zeros[i], ones[i])]))
                columns = zip(*out, strict=True) if out else [[]] * 10
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, [pa.int32()] * 2 + [pa.binary()] * 8, strict=True)],
                                                 names=["m", "node", "bins", "margins", "zeros", "ones", "vbins", "vmargins", "vzeros", "vones"])

        def finish(rows: pa.Table) -> pa.Table:
            m, node = rows.column(0)[0].as_py(), rows.column(1)[0].as_py()
            bins, margins, zeros, ones, vbins, vmargins, vzeros, vones = [
                np.frombuffer(b"".join(rows.column(i).to_pylist()), t)
                for i, t in enumerate((np.uint8, float, np.int64, np.int64) * 2, start=2)]
            columns, vbins = np.ascontiguousarray(bins.reshape(-1, n_features).T), vbins.reshape(-1, n_features)
            most, least, wait = alone.get(m, (1, math.inf, 1))
            got, nodes, waited = Round([], [], []), 0, 0
            asked = trees or not apart and m not in alone
            while len(got.losses) < most and (nodes < AHEAD_NODES or not asked):
                tree, leaf = grow(columns, *derivatives(specs[m], margins, zeros, ones), specs[m], paths[m][node])
                if asked:
                    got.trees.append(tree.astype(kind) if kind is TREE else tree[list(kind.names)].astype(kind))
                nodes += len(tree)
                loss, seen = 0, [0, 0, 0, 0]
                if specs[m].tree < 0:
                    if m in alone or apart:
                        margins = margins + tree["value"][leaf]
                    vmargins = vmargins + tree["value"][leaf_of(tree, vbins)]
                    loss, seen = validation(vmargins, vzeros, vones)
                got.losses.append(loss)
                got.seen.append(seen)
                waited, least = (0, loss) if loss < least else (waited + 1, least)
                if waited >= wait:
                    break
            n = len(got.losses)
            given = pa.table({"m": pa.array([m] * n, pa.int32()), "node": pa.array([node] * n, pa.int32()),
                              "turn": pa.array(range(n), pa.int32()), "tree": pa.array([t.tobytes() for t in got.trees] if asked else [None] * n, pa.binary()),
                              "loss": pa.array(got.losses, pa.int64()), "seen": pa.array(got.seen, pa.list_(pa.int64()))})
            if not apart:
                return given
            fold = specs[m].fold             # of the others it only counts that they have another
            own = [*own_blocks(m, fold + 1, bins.reshape(-1, n_features), zeros, ones, margins), *own_blocks(m, fold, vbins, vzeros, vones, vmargins)]
            kept = pa.table({x: pa.array(list(v), t) for x, t, v in zip(_OWN_NAMES, [pa.int64()] + [pa.binary()] * 5 + [pa.int32()], zip(*own, strict=True), strict=True)})
            return pa.concat_tables([kept, given], promote_options="default")

        sent = table.mapInArrow(send, "m int, node int, bins binary, margins binary, zeros binary, ones binary, "
                                "vbins binary, vmargins binary, vzeros binary, vones binary")
        # A number of its own: the rows are few bytes for much work, so the planner would put them into few tasks.
        tasks = min(4 * sum(map(len, paths.values())), max(8 * self.data.spark.sparkContext.defaultParallelism,
                                                       int(self.data.spark.conf.get("spark.sql.shuffle.partitions"))))
        done = sent.repartition(tasks, "m", "node").groupBy("m", "node").applyInArrow(finish, f"{_OWN}, {_GIVEN}" if apart else f"m int, {_GIVEN}")
        if apart:
            before, self.own = self.own, shared_path(self.data.spark, "own-cells")
            with shuffles_removed(self.data.spark):
                done.write.parquet(self.own)
            done = self.data.spark.read.schema(f"n bigint, m int, {_GIVEN}").parquet(self.own).where(F.col("n").isNull()).drop("n")
            if before:
                remove_path(self.data.spark, before)
        out: dict[int, Round] = {}
        tops = {m: t.astype(kind) if kind is TREE else t[list(kind.names)].astype(kind) for m, t in tops.items()}
        for r in sorted(done.collect(), key=lambda r: (r["m"], r["turn"], r["node"])):
            m = r["m"]
            got = out.setdefault(m, Round([], [], []))
            if len(got.losses) <= r["turn"]:
                got.losses.append(0)
                got.seen.append([0, 0, 0, 0])
                if r["tree"] is not None:
                    got.trees.append(tops[m])
            got.losses[-1] += r["loss"]
            got.seen[-1] = [a + b for a, b in zip(got.seen[-1], r["seen"], strict=True)]
            if r["tree"] is None:
                continue
            whole, sub = got.trees[-1], np.frombuffer(r["tree"], kind).copy()
            # The subtree's root takes the open node's place; the others follow.
            sub["left"] = np.where(sub["feature"] >= 0, sub["left"] + len(whole) - 1, -1)
            whole = np.concatenate([whole, sub[1:]])
            whole[r["node"]] = sub[0]
            got.trees[-1] = whole
        return out


def validation(margins: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> tuple[int, list[int]]:
    """Sum of the log losses, in whole multiples of 1 / LOSS_SCALE, and tp, fp, tn, fn at probabilities rounded half to even."""
    p = np.clip(1.0 / (1.0 + np.exp(-margins)), 1e-15, 1 - 1e-15)
    loss = sum(int((n * np.rint(-np.log(q) * LOSS_SCALE).astype(np.int64)).sum()) for n, q in ((ones, p), (zeros, 1.0 - p)))
    said = np.rint(p).astype(bool)
    return loss, [int(n[which].sum()) for n, which in ((ones, said), (zeros, said), (zeros, ~said), (ones, ~said))]


def forest(data: Binned, trees: int = 100, max_depth: int = 300, node_features_: int | None = None, seed: str = "42") -> list[np.ndarray]:
    """ML4: trees on samples with replacement (hashed Poisson draws), a few features tried at each node; a leaf is the share of ones."""
    few = node_features_ or max(1, int(math.sqrt(len(data.features))))
    specs = [Spec(max_depth=max_depth, learning_rate=1.0, reg_lambda=0.0, min_child_weight=1.0, node_features=few, tree=t, seed=seed) for t in range(trees)]
    out = []
    for at in range(0, trees, TREES):
        some = specs[at:at + TREES]
        got = _Grower(data, some).step(cells(data, some), list(range(len(some))), None, {})
        out += [got[t].trees[0] for t in range(len(some))]
    return out


def boost(data: Binned, specs: Sequence[Spec], rounds: int, patience: int | None = None, keep: bool = True,
          state: str | None = None) -> Boosted:
    """ML5-ML9: boosts all models together; one stops once ``patience`` rounds brought no better validation loss.

    ``keep=False`` asks for no trees (a search needs none): they stay where they grow, only margins go on. With a ``state``
    folder margins, trees and losses stay there every ``KEEP`` rounds or more, and a later call with the same
    folder, data, models and ``keep`` goes on after them.
    """
    specs, spark = list(specs), data.spark
    n_features, kind = len(data.features), TREE if keep else SLIM
    out = Boosted([[] for _ in specs], [[] for _ in specs], [[] for _ in specs])
    table, columns, base, step = data.table, [], None, 0
    if state:
        step, columns = _resume(spark, state, out, kind)
        if step:
            table = spark.read.parquet(f"{state}/step-{step}/margins")
    saved = [len(x) for x in out.losses]
    held = [max(1, data.sizes.get(s.fold, 0)) for s in specs]
    casts, grower, bare = [], _Grower(data, specs), set()

    def going() -> list[int]:
        return [m for m in range(len(specs)) if m not in bare and len(out.losses[m]) < rounds and _stopped(out.losses[m], patience)[1] is None]

    active = going()
    while active:
        def margins_of(bins, stored, casts=tuple(casts), columns=columns, active=active):
            return _margins(bins, stored, columns, active, [c.value for c in casts])

        ahead = {}
        for m in active:
            best = _stopped(out.losses[m], patience)[0]
            least = round(out.losses[m][best] * LOSS_SCALE * held[m]) if out.losses[m] else math.inf
            wait = patience - (len(out.losses[m]) - 1 - best) if patience is not None and out.losses[m] else patience
            ahead[m] = (min(min(AHEAD, AHEAD_STATE) if state else AHEAD if keep else rounds, rounds - len(out.losses[m])), least, wait if wait is not None else rounds + 1)
        got = grower.step(table, active, margins_of, ahead, kind, keep or bool(state))
        bare.update(set(active) - set(got))        # no rows: no trees
        if not got:
            break
        for m, r in got.items():
            out.fitted += len(r.losses)
            out.trees[m] += r.trees
            out.losses[m] += [v / LOSS_SCALE / held[m] for v in r.losses]
            out.counts[m] += [tuple(map(int, x)) for x in r.seen]
        worked, active = sorted(got), going()
        if grower.own:                              # has the margins
            continue
        casts.append(spark.sparkContext.broadcast({m: r.trees for m, r in got.items()}))
        since = max(len(out.losses[m]) - saved[m] for m in worked)
        if since >= KEEP and active or state and not active:
            step += 1
            path = f"{state}/step-{step}/margins" if state else shared_path(spark, "margins")
            live = active or worked
            _stored_margins(table, path, columns, live, casts, n_features)
            if state:
                _save(spark, state, step, saved, out, live)
            table, columns, saved = spark.read.parquet(path), live, [len(x) for x in out.losses]
            if base:
                remove_path(spark, base)
            base = None if state else path
            for c in casts:
                c.unpersist()
            casts = []
            if not keep:
                for x in out.trees:
                    x.clear()
    for path in (base, grower.own):
        if path:
            remove_path(spark, path)
    for m, s in enumerate(specs):
        best, stop = _stopped(out.losses[m], patience) if s.fold >= 0 else (len(out.losses[m]) - 1, None)
        out.best.append(best if out.losses[m] else None)
        out.stop.append(stop)
    return out


def _stopped(losses: Sequence[float], patience: int | None) -> tuple[int, int | None]:
    """Best round so far, and the first round that came ``patience`` rounds after it (None: none did)."""
    best = 0
    for i, v in enumerate(losses):
        if v < losses[best]:
            best = i
        if patience is not None and i - best >= patience:
            return best, i
    return best, None


def _stored_margins(table: DataFrame, path: str, columns: list[int], active: list[int], casts: list, n_features: int) -> None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        since = [c.value for c in casts]
        for b in batches:
            made = [_margins(bins, stored, columns, active, since).tobytes() for bins, _, _, _, stored in _blocks([b], n_features)]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(made, pa.binary())], names=["n", "bins", "zeros", "ones", "fold", "margins"])

    table.mapInArrow(run, f"{_CELLS}, margins binary").write.mode("overwrite").parquet(path)


_TREES = "step int, round int, m int, tree binary, loss double, seen array<bigint>, columns array<int>"


def _save(spark: SparkSession, state: str, step: int, saved: list[int], out: Boosted, live: list[int]) -> None:
    """Trees and losses since the last saved step; its margins are there already, so this table closes it."""
    rows = [(step, r, m, bytearray(out.trees[m][r - len(out.losses[m])].tobytes()), out.losses[m][r], list(out.counts[m][r]), live)
            for m in range(len(out.losses)) for r in range(saved[m], len(out.losses[m]))]
    spark.createDataFrame(rows, _TREES).write.mode("overwrite").parquet(f"{state}/step-{step}/trees")


def _resume(spark: SparkSession, state: str, out: Boosted, kind: np.dtype) -> tuple[int, list[int]]:
    """(the last step that was closed, the models of its margins); puts trees and losses into ``out``."""
    from pyspark.errors import AnalysisException
    try:
        rows = spark.read.schema(_TREES).parquet(f"{state}/step-*/trees").orderBy("m", "round").collect()
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" not in str(ex):
            raise
        return 0, []
    for r in rows:
        out.trees[r["m"]].append(np.frombuffer(r["tree"], kind))
        out.losses[r["m"]].append(r["loss"])
        out.counts[r["m"]].append(tuple(r["seen"]))
    last = max(rows, key=lambda r: r["step"], default=None)
    return (last["step"], list(last["columns"])) if last else (0, [])


# ------------------------------------------------------------------ what ensembles tell

def gain_importance(trees: Sequence[np.ndarray], n_features: int) -> list[float]:
    """Mean gain of a feature's splits, as shares of all features."""
    gains, splits = np.zeros(n_features), np.zeros(n_features)
    for t in trees:
        inner = t[t["feature"] >= 0]
        gains += np.bincount(inner["feature"], inner["gain"], n_features)
        splits += np.bincount(inner["feature"], minlength=n_features)
    mean = np.where(splits > 0, gains / np.maximum(splits, 1), 0.0)
    return (mean / mean.sum() if mean.sum() else mean).tolist()


def impurity_importance(trees: Sequence[np.ndarray], n_features: int) -> list[float]:
    """Mean over trees of the share that a feature's splits have in the tree's decrease of impurity."""
    total = np.zeros(n_features)
    for t in trees:
        inner = t[t["feature"] >= 0]
        gains = np.bincount(inner["feature"], inner["gain"], n_features)
        total += gains / gains.sum() if gains.sum() else 0.0
    return (total / total.sum() if total.sum() else total).tolist()


NODES = ("tree int, node int, depth int, feature string, threshold double, left int, right int, value double, gain double, cover double")


def node_table(spark: SparkSession, data: Binned, trees: Sequence[np.ndarray]) -> DataFrame:
    """``NODES``: an ensemble as rows, to be stored and scored (:func:`tallyspark.operators.scoring.score_ensembles`).

    A row goes left if its value is null or at most the threshold (null threshold: only nulls do). ``feature`` is
    null at leaves.
    """
    rows = []
    for i, t in enumerate(trees):
        depth = np.zeros(len(t), int)
        for j, x in enumerate(t):              # parents come before their children
            f, cut, left = int(x["feature"]), int(x["cut"]), int(x["left"])
            if f >= 0:
                depth[[left, left + 1]] = depth[j] + 1
            bound = float(data.cuts[f][cut - 1]) if f >= 0 and cut else None
            rows.append((i, j, int(depth[j]), data.features[f] if f >= 0 else None, bound, left, left + 1 if f >= 0 else -1,
                         float(x["value"]), float(x["gain"]), float(x["cover"])))
    return spark.createDataFrame(rows, NODES)


# ------------------------------------------------------------------ searches

def rates(seen: tuple[int, int, int, int]) -> dict[str, float]:
    """accuracy, precision, recall, f1 of confusion counts; 0 where nothing is to be divided by."""
    tp, fp, tn, fn = seen
    part = lambda a, b: a / b if b else 0.0
    return {"accuracy": part(tp + tn, tp + fp + tn + fn), "precision": part(tp, tp + fp), "recall": part(tp, tp + fn),
            "f1": part(2 * tp, 2 * tp + fp + fn)}


def metric_name(metric: str) -> str:
    name = {"f1_score": "f1"}.get(metric, metric)
    if name not in ("accuracy", "precision", "recall", "f1"):
        raise ValueError(f"unknown metric {metric!r}")
    return name


def random_search(data: Binned, trials: Sequence[Mapping], metric: str = "f1", rounds: int = 800, patience: int = 40, fold: int = 1,
                  state: str | None = None) -> list[dict]:
    """ML8: every trial is trained without the rows of ``fold`` and judged on them at its best round; loss = 1 - metric."""
    name = metric_name(metric)
    got = boost(data, [Spec.of(t, fold) for t in trials], rounds, patience, keep=bool(state), state=state)
    out = []
    for m, t in enumerate(trials):
        best = got.best[m]
        r = rates(got.counts[m][best] if best is not None else (0, 0, 0, 0))
        out.append({**t, **r, "logloss": got.losses[m][best] if best is not None else None, "loss": 1.0 - r[name], "best_round": best, "rounds": len(got.losses[m])})
    return out


def cv_search(data: Binned, trials: Sequence[Mapping], k: int, metric: str = "f1", rounds: int = 1000, patience: int = 50,
              state: str | None = None) -> list[dict]:
    """ML9: every trial on every fold, all at once; a trial's score is the mean of its folds' metrics."""
    name = metric_name(metric)
    got = boost(data, [Spec.of(t, f) for t in trials for f in range(k)], rounds, patience, keep=bool(state), state=state)
    out = []
    for i, t in enumerate(trials):
        mine = range(i * k, i * k + k)
        mean = sum(rates(got.counts[m][got.best[m]])[name] for m in mine if got.best[m] is not None) / k
        out.append({**t, f"mean_{name}": mean, "loss": 1.0 - mean, "rounds": sum(len(got.losses[m]) for m in mine)})
    return out
