"""Exact top-k inner-product search with a three-phase uniform threshold.

A score is the sum of ``LISTS`` local scores, one for each run of components (a
list). Candidates lie in shards, queries in blocks; a task meets a few shards with
the blocks of a query group, so no pair of rows is ever a row of a table.

1. *Gather.* Each list of each task names its k best candidates by local score.
   Their exact scores are known at once; the k-th best of those gathered anywhere
   can't exceed the true k-th best score. That is the query's safe cutoff.
2. *Collect.* A candidate whose local scores all lie under cutoff / LISTS can't
   reach the cutoff. Each list sends the others; one that some lists didn't send is
   held to that share there, and goes if the sum stays under the cutoff.
3. *Resolve.* The rest get their exact scores, and the k best of each task by
   (score, id) are ranked.

Components are floor(64 * x) as integers. Local scores are products of matrices in
the smallest kind of number that holds every sum exactly.

Defined results: vectors that are null or hold a null or a component that isn't
finite take no part; missing components at the end of a shorter vector are 0;
components beyond +-2^62 are held to that, and a score beyond a long is the nearest
long; a null vec_id is no query and comes after every other on a tie; rows that
repeat a vec_id are candidates, and queries, of their own. Only vec_id and
embedding are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import arrow_map, give_back, spark_python, stored

LISTS = 2
#: Rows of a shard and queries of a block at most (a matrix of local scores is 8 MB), shards and blocks that a task meets on average.
SHARD, BLOCK, SHARDS, BLOCKS = 4096, 512, 4, 8
#: Components of a shard at most (4 MB), so wide vectors make shorter shards.
CELLS = 1 << 19
#: Gathered score lists that meet in one step of finding a cutoff.
FAN = 64
#: Null ids on a tie: after every other.
LAST = np.iinfo(np.int64).max

_SHARDS = "shard bigint, n bigint, width bigint, ids binary, known binary, vectors binary"
_BLOCKS = "block bigint, n bigint, width bigint, ids binary, shards binary, places binary, vectors binary"


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row whose vec_id is divisible by ``every``."""
    comps = F.transform("embedding", lambda x: F.floor(F.least(F.greatest(x.cast("double") * 64, F.lit(-2.0 ** 62)), F.lit(2.0 ** 62))))
    fine = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = embeddings.where(fine).select(F.col("vec_id").cast("bigint").alias("vec_id"), comps.alias("comps"),
                                         F.spark_partition_id().cast("bigint").alias("part"))
    shards = stored(arrow_map(rows, _pack, _SHARDS), "shards")
    blocks = stored(arrow_map(shards, lambda batches: _queries(batches, every), _BLOCKS), "blocks")
    sizes = shards.agg(F.count(F.lit(1))).first()[0], blocks.agg(F.count(F.lit(1))).first()[0]
    groups, teams = (max(1, -(-n // most)) for n, most in zip(sizes, (SHARDS, BLOCKS), strict=True))
    shards = _dealt(shards, "shard", groups, "grp").withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(teams - 1))))
    blocks = stored(_dealt(blocks, "block", teams, "team"), "dealt")

    def met(asked: DataFrame, fn, schema: str) -> DataFrame:
        asked = asked.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        spark_python(embeddings.sparkSession)
        return shards.groupBy("grp", "team").cogroup(asked.groupBy("grp", "team")).applyInArrow(fn, schema)

    gathered = met(blocks, lambda s, b: _gather(s, b, k), "block bigint, place bigint, grp bigint, scores array<bigint>")
    cutoffs = _cutoffs(gathered, groups, k)
    asked = blocks.join(cutoffs, "block", "left")
    found = met(asked, lambda s, b: _collect(s, b, k), "block bigint, place bigint, query_id bigint, vec_id bigint, shard bigint, spot bigint, score bigint")
    best = Window.partitionBy("block", "place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "shard", "spot")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _dealt(df: DataFrame, key: str, n: int, out: str) -> DataFrame:
    """A group of n for each row, by the hash of its number."""
    return df.withColumn(out, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))


# ------------------------------------------------------------------ shards and query blocks

def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as shards: ids (0 where null), whether an id is known, and the components as a matrix padded with 0."""
    seq = 0
    for b in batches:
        at = 0
        while at < b.num_rows:
            widest = int(b.column(1).slice(at, SHARD).value_lengths().to_numpy().max(initial=0))
            part = b.slice(at, max(1, min(SHARD, CELLS // max(1, widest))))
            at += part.num_rows
            lists = part.column(1)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), lists.value_lengths().to_numpy()
            width = int(ends.max(initial=0))
            mat = np.zeros((part.num_rows, width), np.int64)
            mat[np.arange(width) < ends[:, None]] = flat
            ids = part.column(0)
            known = np.asarray(ids.is_valid())
            ids = ids.fill_null(0).to_numpy().astype(np.int64)
            yield _row(_SHARDS, [(part.column(2)[0].as_py() << 24) + seq, part.num_rows, width, ids.tobytes(), known.tobytes(), mat.tobytes()])
            seq += 1


def _row(schema: str, values: list) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[t]) for v, (_, t) in zip(values, fields, strict=True)],
                                      names=[n for n, _ in fields])


def _shard(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool),
            np.frombuffer(row["vectors"], np.int64).reshape(row["n"], row["width"]))


def _rows(batches) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {name: b.column(j)[i].as_py() for j, name in enumerate(b.schema.names)}


def _queries(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    """The rows that ask, with their own place, in blocks."""
    held: list[tuple] = []

    def block() -> pa.RecordBatch:
        width = max(x[3].shape[1] for x in held)
        mat = np.vstack([np.pad(x[3], ((0, 0), (0, width - x[3].shape[1]))) for x in held])
        ids, shards, places = (np.concatenate([x[i] for x in held]) for i in range(3))
        own = int(shards[0]) * SHARD + int(places[0])       # its first query's place is no other block's
        return _row(_BLOCKS, [own, len(ids), width, ids.tobytes(), shards.tobytes(), places.tobytes(), mat.tobytes()])

    for row in _rows(batches):
        ids, known, mat = _shard(row)
        asks = np.flatnonzero(known & (ids % every == 0))
        for at in range(0, len(asks), BLOCK):
            some = asks[at:at + BLOCK]
            if sum(len(x[0]) for x in held) + len(some) > BLOCK:
                yield block()
                held = []
            held.append((ids[some], np.full(len(some), row["shard"]), some.astype(np.int64), mat[some]))
    if held:
        yield block()


# ------------------------------------------------------------------ local scores

def _kind(a: np.ndarray, b: np.ndarray) -> type:
    """The kind of number that holds LISTS times any sum of products exactly."""
    most = [max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) for x in (a, b)]
    bound = most[0] * most[1] * max(1, a.shape[1]) * LISTS
    return np.float32 if bound < 2 ** 24 else np.float64 if bound < 2 ** 53 else object


def _local(q: np.ndarray, v: np.ndarray) -> list[np.ndarray]:
    """One matrix (queries x candidates) of local scores for each list."""
    width = max(q.shape[1], v.shape[1])
    q, v = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (q, v))
    kind = _kind(q, v)
    q, v = q.astype(kind), v.astype(kind)
    cuts = np.linspace(0, width, LISTS + 1).astype(int)
    return [q[:, a:b] @ v[:, a:b].T if b > a else np.zeros((len(q), len(v)), kind) for a, b in zip(cuts, cuts[1:], strict=False)]


def _long(x: np.ndarray) -> np.ndarray:
    """Exact scores as longs; those beyond are the nearest long."""
    if x.dtype == object:
        x = np.array([max(min(int(y), LAST), -LAST - 1) for y in x.ravel()], np.int64).reshape(x.shape)
    return x.astype(np.int64)


def _own(row: dict, shard: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries, places) of a block's own rows in a shard: no candidates of theirs."""
    mine = np.flatnonzero(np.frombuffer(row["shards"], np.int64) == shard)
    return mine, np.frombuffer(row["places"], np.int64)[mine]


def _query_matrix(row: dict) -> np.ndarray:
    return np.frombuffer(row["vectors"], np.int64).reshape(row["n"], row["width"])


def _largest(x: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of each row, in any order."""
    if x.shape[1] <= k:
        return np.broadcast_to(np.arange(x.shape[1]), x.shape)
    if x.dtype == object:
        return np.argsort(-x, axis=1, kind="stable")[:, :k]
    return np.argpartition(x, x.shape[1] - k, axis=1)[:, -k:]


# ------------------------------------------------------------------ phase 1

def _gather(shards: pa.Table, blocks: pa.Table, k: int) -> pa.Table:
    """The k best known scores of each query in this task, from the candidates that its lists put first."""
    out = {"block": [], "place": [], "grp": [], "scores": []}
    rows = [(r, _shard(r)) for r in _rows(shards.to_batches())]
    for b in _rows(blocks.to_batches()):
        q, best = _query_matrix(b), None
        for r, (_, _, v) in rows:
            local = _local(q, v)
            total = sum(local[1:], local[0])
            mine, at = _own(b, r["shard"])
            named = np.zeros(total.shape, bool)
            for x in local:
                x[mine, at] = _least(x)
                np.put_along_axis(named, _largest(x, k), True, axis=1)
            named[mine, at] = False
            here = _named(total, named, k * LISTS)
            best = here if best is None else [_best([*x, *y], k) for x, y in zip(best, here, strict=True)]
        for place, scores in enumerate(best or []):
            out["block"].append(b["block"])
            out["place"].append(place)
            out["grp"].append(b["grp"])
            out["scores"].append(scores[:k])
    give_back()
    return pa.table({"block": pa.array(out["block"], pa.int64()), "place": pa.array(out["place"], pa.int64()),
                     "grp": pa.array(out["grp"], pa.int64()), "scores": pa.array(out["scores"], pa.list_(pa.int64()))})


def _least(x: np.ndarray):
    """A value under every local score."""
    return -(1 << 200) if x.dtype == object else -np.inf


def _named(total: np.ndarray, named: np.ndarray, most: int) -> list[list[int]]:
    """Scores of each row's named candidates, best first."""
    q, c = np.nonzero(named)
    scores = _long(total[q, c])
    order = np.lexsort((-scores.astype(object) if total.dtype == object else -scores, q))
    q, scores = q[order], scores[order]
    starts = np.searchsorted(q, np.arange(len(total) + 1))
    return [scores[a:min(b, a + most)].tolist() for a, b in zip(starts, starts[1:], strict=False)]


def _best(scores: list[int], k: int) -> list[int]:
    return sorted(scores, reverse=True)[:k]


def _cutoffs(gathered: DataFrame, groups: int, k: int) -> DataFrame:
    """(block, cutoffs): each query's k-th best gathered score, at its place in the block; null where fewer are known."""
    best = F.slice(F.sort_array(F.flatten(F.collect_list("scores")), asc=False), 1, k).alias("scores")
    lists, left = gathered, groups
    while left > FAN:       # of a large table only FAN lists meet at once
        lists = lists.groupBy("block", "place", F.floor(F.col("grp") / FAN).alias("grp")).agg(best)
        left = -(-left // FAN)
    one = lists.groupBy("block", "place").agg(best)
    cutoff = F.when(F.size("scores") == k, F.element_at("scores", k))
    return one.groupBy("block").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", cutoff.alias("cutoff")))),
                                                lambda x: x["cutoff"]).alias("cutoffs"))


# ------------------------------------------------------------------ phases 2 and 3

def _collect(shards: pa.Table, blocks: pa.Table, k: int) -> pa.Table:
    """The k best candidates of each query in this task that reach its cutoff."""
    out: list[list[np.ndarray]] = [[] for _ in range(7)]
    rows = [(r, _shard(r)) for r in _rows(shards.to_batches())]
    for b in _rows(blocks.to_batches()):
        q, asked = _query_matrix(b), np.frombuffer(b["ids"], np.int64)
        cutoffs = b["cutoffs"] or [None] * len(q)
        got: list[tuple] = []
        for r, (ids, known, v) in rows:
            local = _local(q, v)
            low = np.array([_least(local[0]) if c is None else c for c in cutoffs], object)
            low = (low if local[0].dtype == object else low.astype(np.float64))[:, None]
            # LISTS * score against the cutoff: a uniform share without fractions.
            sent = [x * LISTS >= low for x in local]
            who, what = np.nonzero(np.logical_or.reduce(sent))
            bound = sum(np.where(s[who, what], x[who, what] * LISTS, low[who, 0]) for s, x in zip(sent, local, strict=True))
            alive = bound >= low[who, 0] * LISTS
            who, what = who[alive], what[alive]
            score = sum((x[who, what] for x in local[1:]), local[0][who, what])
            fine = score >= low[who, 0]
            mine, at = _own(b, r["shard"])
            fine &= ~np.isin(who * len(v) + what, mine * len(v) + at)
            who, what, score = who[fine], what[fine], _long(score[fine])
            got.append((who, np.where(known[what], ids[what], LAST), known[what], np.full(len(who), r["shard"]), what, score))
        if not got:
            continue
        who, ids, known, shard, spot, score = (np.concatenate([g[i] for g in got]) for i in range(6))
        order = np.lexsort((spot, shard, ids, ~known, ~score, who))      # ~score falls as the score grows, without overflow
        first = np.searchsorted(who[order], who[order])
        order = order[np.arange(len(order)) - first < k]
        place = who[order]
        ids = pa.array(ids[order], pa.int64(), mask=~known[order])
        for column, values in zip(out, (np.full(len(order), b["block"]), place, asked[place], ids, shard[order], spot[order], score[order]), strict=True):
            column.append(pa.array(values, pa.int64()) if not isinstance(values, pa.Array) else values)
    give_back()
    names = ["block", "place", "query_id", "vec_id", "shard", "spot", "score"]
    return pa.table({n: pa.chunked_array(c, pa.int64()) for n, c in zip(names, out, strict=True)})


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
