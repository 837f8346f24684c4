"""Ensembles and logistic models that are trained by Spark steps: plain versions, resumption, both ways of finding splits."""

import hashlib
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import boosting as B
from tallyspark.operators import logistic as LG
from tallyspark.operators import metrics as M
from tallyspark.operators.models import ModelRegistry
from tallyspark.operators.scoring import score_ensembles

FEATURES = ["a", "b c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(1)
    n = 900
    x = np.round(r.normal(size=(n, 3)), 2)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + r.normal(size=n) > 0).astype(int)
    rows = [(i, None if i % 13 == 0 else float(a), float("nan") if i % 17 == 0 else float(b), float(c), int(t), i % 3)
            for i, ((a, b, c), t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id bigint, a double, `b c` double, d double, y int, fold int").repartition(5)


@pytest.fixture(scope="module")
def data(table):
    return B.binned(table, FEATURES, "y", "fold", "id", bins=12)


def plain_boost(table, data, spec, rounds):
    """Boosting written plainly: every node, feature and cut is tried over all rows."""
    rows = table.orderBy("id").collect()
    x = np.array([[np.nan if r[f] is None else r[f] for f in FEATURES] for r in rows])
    y, fold = np.array([r["y"] for r in rows]), np.array([r["fold"] for r in rows])
    bins = B.bin_numbers(x, data.cuts)
    margin, learn, losses = np.zeros(len(y)), fold != spec.fold, []

    def weight(g, h):
        return np.sign(g) * max(abs(g) - spec.reg_alpha, 0.0) / (h + spec.reg_lambda)

    def score(g, h):
        return weight(g, h) ** 2 * (h + spec.reg_lambda)

    def place(rows_, depth):
        g, h = G[rows_ & learn].sum(), HS[rows_ & learn].sum()
        best = (B.LEAST_GAIN, None)
        for f in range(x.shape[1] if depth < spec.max_depth else 0):
            for cut in range(int(bins.max())):
                left = rows_ & (bins[:, f] <= cut)
                gl, hl = G[left & learn].sum(), HS[left & learn].sum()
                if hl >= spec.min_child_weight and h - hl >= spec.min_child_weight and (left & learn).sum() < (rows_ & learn).sum():
                    gain = 0.5 * (score(gl, hl) + score(g - gl, h - hl) - score(g, h))
                    if gain > best[0] + 1e-12:
                        best = (gain, left)
        if best[1] is None:
            margin[rows_] += -weight(g, h) * spec.learning_rate
        else:
            place(best[1], depth + 1)
            place(rows_ & ~best[1], depth + 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        G, HS = p - y, p * (1 - p)
        place(np.ones(len(y), bool), 0)
        q = 1 / (1 + np.exp(-margin))
        held = fold == spec.fold
        losses.append(float(-np.log(np.where(y == 1, q, 1 - q))[held].mean()))
    return losses


SPECS = [B.Spec(max_depth=3, learning_rate=0.4, reg_alpha=0.2, reg_lambda=0.5, min_child_weight=2.0, fold=0),
         B.Spec(max_depth=2, learning_rate=1.0, reg_alpha=0.0, reg_lambda=3.0, min_child_weight=8.0, fold=1),
         B.Spec(max_depth=40, learning_rate=0.3, reg_alpha=0.5, reg_lambda=0.1, min_child_weight=4.0, fold=2)]


def test_losses_of_plain_boosting(table, data):
    got = B.boost(data, SPECS, 5)
    for spec, losses in zip(SPECS, got.losses, strict=True):
        assert np.allclose(losses, plain_boost(table, data, spec, 5), atol=1e-6)
    assert got.fitted == 15


def same(a, b):
    assert a.losses == b.losses and a.counts == b.counts
    # Nodes may be numbered otherwise; what they hold is equal.
    for x, y in zip(a.trees, b.trees, strict=True):
        assert [sorted(t[["feature", "cut", "value", "gain"]].tolist()) for t in x] == [sorted(t[["feature", "cut", "value", "gain"]].tolist()) for t in y]


def test_spark_splits_and_task_splits_agree(table, data, monkeypatch):
    want, trees = B.boost(data, SPECS, 2), B.forest(data, 4, 3)
    monkeypatch.setattr(B, "SMALL", 150)       # the upper levels are divided by Spark
    same(B.boost(B.binned(table.repartition(2), FEATURES, "y", "fold", "id", bins=12), SPECS, 2), want)
    assert B.impurity_importance(B.forest(data, 4, 3), 3) == pytest.approx(B.impurity_importance(trees, 3), abs=1e-12)


def test_levels_laid_out_whole_or_by_places(monkeypatch):
    r = np.random.default_rng(3)
    columns = np.stack([r.integers(0, n, 3000) for n in (65, 5, 40)]).astype(np.uint8)
    zeros, ones = r.integers(0, 4, 3000), r.integers(0, 3, 3000)
    for spec in (*SPECS, B.Spec(tree=3, max_depth=30, reg_lambda=0.0, learning_rate=1.0, node_features=2)):
        derivatives = B.derivatives(spec, r.normal(size=3000), zeros, ones)
        want, leaf = B.grow(columns, *derivatives, spec)
        for whole, places in ((1 << 40, 1 << 23), (0, 1 << 23), (0, 0)):
            with monkeypatch.context() as m:
                m.setattr(B, "WHOLE", whole)
                m.setattr(B, "PLACES", places)
                tree, at = B.grow(columns, *derivatives, spec)
            assert tree.tolist() == want.tolist() and at.tolist() == leaf.tolist()
        assert B.leaf_of(want, np.ascontiguousarray(columns.T)).tolist() == leaf.tolist()


def test_rows_with_equal_bins_are_one_cell(table, data):
    """A table repeated ten times has the same cells; its losses are those of the rows, its trees of ten times their weight."""
    many = table.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(10)))).withColumn("id", F.col("id") * 10 + F.col("i"))
    ten = B.binned(many, FEATURES, "y", "fold", "id", cuts=data.cuts)
    count = lambda d: d.table.agg(F.sum("n")).first()[0]
    assert count(ten) == count(data) < 900 and sum(ten.sizes.values()) == 9000
    spec = B.Spec(max_depth=3, reg_lambda=0.5, min_child_weight=2.0, fold=0)
    one, tens = B.boost(data, [spec], 3), B.boost(ten, [B.Spec(max_depth=3, reg_lambda=5.0, min_child_weight=20.0, fold=0)], 3)
    assert np.allclose(one.losses, tens.losses) and [tuple(10 * v for v in c) for c in one.counts[0]] == tens.counts[0]


@pytest.mark.parametrize("ahead", [3, 32])
def test_early_stop_fits_no_tree_beyond_the_stop(data, ahead, monkeypatch):
    monkeypatch.setattr(B, "AHEAD", ahead)
    got = B.boost(data, SPECS, 60, patience=4)
    assert got.fitted == sum(len(x) for x in got.losses) == sum(s + 1 for s in got.stop)
    for losses, best, stop in zip(got.losses, got.best, got.stop, strict=True):
        assert min(range(len(losses)), key=losses.__getitem__) == best and stop == best + 4 == len(losses) - 1
    want = B.boost(data, SPECS, 60, patience=4, keep=False)
    assert want.losses == got.losses and want.counts == got.counts


def test_trees_that_nobody_asks_for_stay_in_tasks(spark, table, data, monkeypatch):
    """Models with more cells than a task may have: the driver gets their losses and counts, no trees (F1 of round 4, random_search)."""
    specs = [*SPECS, B.Spec(max_depth=0, fold=1), B.Spec(max_depth=3, fold=7)]      # fold 7 has no rows
    want = B.boost(data, specs, 4, patience=2, keep=False)
    monkeypatch.setattr(B, "SMALL", 150)
    given, written, step = [], [], B._Grower.step

    def watched(self, *args, **more):
        got = step(self, *args, **more)
        given.extend(t for r in got.values() for t in r.trees)
        written.append(getattr(self, "own", None))
        return got

    monkeypatch.setattr(B._Grower, "step", watched)
    got = B.boost(B.binned(table.repartition(3), FEATURES, "y", "fold", "id", bins=12), specs, 4, patience=2, keep=False)
    assert got.losses == want.losses and got.counts == want.counts and (got.best, got.stop) == (want.best, want.stop)
    assert not given and not any(got.trees)
    assert len(set(written)) == len(written) > 2 and not any(os.path.exists(p.removeprefix("file:")) for p in written)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(name, "false") == "false"


def test_rows_do_not_add_to_cells(table, data, monkeypatch):
    """Cells and rows are bounded apart: many rows in few cells stay one task's (F1 of round 4, random_search)."""
    many = table.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(100))))
    lots = B.binned(many, FEATURES, "y", "fold", "id", cuts=data.cuts)
    n, rows = lots.table.agg(F.sum("n")).first()[0], sum(lots.sizes.values())
    assert n + (rows >> 8) > n + 100
    monkeypatch.setattr(B, "SMALL", n + 100)
    monkeypatch.setattr(B._Grower, "_best_splits", None)           # fails if it's called
    assert len(B.boost(lots, [B.Spec(max_depth=3, fold=0)], 3, keep=False).losses[0]) == 3
    assert B.node_size(10, 5 << 28) == 5 << 20


def test_boosting_goes_on_from_its_folder(data, monkeypatch):
    monkeypatch.setattr(B, "AHEAD", 3)
    folder = tempfile.mkdtemp(prefix="ts-boost-")
    want = B.boost(data, SPECS, 10)
    first = B.boost(data, SPECS, 6, state=folder)
    then = B.boost(data, SPECS, 10, state=folder)
    assert first.fitted == 18 and then.fitted == 12        # no round is fitted twice
    same(then, want)
    assert B.boost(data, SPECS, 10, state=folder).fitted == 0


def test_forest_draws_and_features(spark, data):
    spec = B.Spec(tree=11, seed="42")
    draws = [int(hashlib.md5(f"42:1:{k}".encode()).hexdigest()[12:16], 16) for k in range(500)]
    assert B.copies(spec, [str(k) for k in range(500)]).tolist() == [sum(d >= c for c in B.COPIES) for d in draws]
    assert abs(B.copies(spec, [str(k) for k in range(20000)]).mean() - 1) < 0.03
    for t in B.forest(data, 3, 300):
        assert (t["value"][t["feature"] < 0] >= 0).all() and (t["value"] <= 1).all()
    assert sum(B.impurity_importance(B.forest(data, 3, 4), 3)) == pytest.approx(1.0)


def test_edges(spark, table):
    cuts = [np.array([0.0])] * 3
    one = B.binned(table.limit(1), FEATURES, "y", "fold", cuts=cuts)
    assert [len(t) for t in B.boost(one, [B.Spec()], 2).trees[0]] == [1, 1]
    flat = table.select("id", F.lit(1.0).alias("a"), F.lit(None).cast("double").alias("b c"), F.lit(2.0).alias("d"), F.lit(1).alias("y"), "fold")
    got = B.boost(B.binned(flat, FEATURES, "y", "fold"), [B.Spec(fold=0)], 2)
    assert [len(t) for t in got.trees[0]] == [1, 1] and got.losses[0][1] < got.losses[0][0]
    empty = B.binned(table.where("false"), FEATURES, "y", "fold", cuts=cuts)
    assert B.boost(empty, [B.Spec(fold=0)], 2).trees == [[]]
    assert B.random_search(empty, [{"max_depth": 3}], rounds=3)[0]["loss"] == 1.0
    with pytest.raises(ValueError):
        B.binned(table, FEATURES, "y", bins=300)


def test_node_tables_score_like_the_trees(spark, table, data):
    got = B.boost(data, SPECS, 4)
    nodes = None
    for v, trees in enumerate(got.trees):
        one = B.node_table(spark, data, trees).withColumns({"model_name": F.lit("m"), "version": F.lit(v)})
        nodes = one if nodes is None else nodes.unionByName(one)
    scored = score_ensembles(table, nodes, FEATURES)
    for v, spec in enumerate(SPECS):
        mine = scored.where((F.col("version") == v) & (F.col("fold") == spec.fold))
        m = M.binary_metrics(mine, "y", "prediction").first()
        assert (m["tp"], m["fp"], m["tn"], m["fn"]) == got.counts[v][-1]
        assert M.log_loss(mine, "y", "prob").first()["logloss"] == pytest.approx(got.losses[v][-1], abs=1e-8)
    assert scored.count() == 3 * table.count()


# ------------------------------------------------------------------ life cycle

def test_damaged_and_missing_versions_end_the_prefix(spark, data):
    reg = ModelRegistry(spark, tempfile.mkdtemp(prefix="ts-reg-"))
    got = B.boost(data, SPECS, 2)
    for trees in [*got.trees, got.trees[0]]:
        reg.save_ensemble(B.node_table(spark, data, trees), "m")
    numbers = lambda: sorted(r["version"] for r in reg.live_versions("m").collect())
    assert numbers() == [1, 2, 3, 4]
    folder = reg.uri("m", version=3)
    part = next(f for f in sorted(os.listdir(folder)) if f.endswith(".parquet") and os.path.getsize(f"{folder}/{f}") > 1500)
    with open(f"{folder}/{part}", "r+b") as f:             # bytes that are no Parquet
        f.seek(-8, 2)
        f.write(b"damaged!")
    os.remove(f"{folder}/.{part}.crc")
    assert numbers() == [1, 2] and {r["version"]: r["is_sound"] for r in reg.sound_versions("m").collect()} == {1: True, 2: True, 3: False, 4: True}


def test_writers_at_once_get_numbers_of_their_own(spark):
    reg = ModelRegistry(spark, tempfile.mkdtemp(prefix="ts-reg-"))
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: reg.register("m", f"uri{i}"), range(6)))
    rows = {r["version"]: r["uri"] for r in reg.versions().collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6] and rows == {v: f"uri{i}" for i, v in enumerate(got)}
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda v: reg.promote("m", v, "Staging"), got))
    assert sorted(r["seq"] for r in reg.stage_events().collect()) == [1, 2, 3, 4, 5, 6]


# ------------------------------------------------------------------ logistic models

@pytest.mark.parametrize("penalty", ["l1", "l2"])
def test_logistic_weights_are_optimal(spark, table, penalty):
    x = table.select(F.array(F.coalesce("a", F.lit(0.0)), "d", F.lit(1.0)).alias("x"), F.col("y").cast("double").alias("y"), "fold")
    folds, cs = np.array([-1, 0, 1, 2]), np.array([0.01, 0.1, 1.0, 1000.0])
    w = LG.fit(x, folds, cs, penalty, 3)
    rows = x.collect()
    m, y, f = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows]), np.array([r["fold"] for r in rows])
    for i, c in enumerate(cs):
        mine = f != folds[i]
        g = c * m[mine].T @ (1 / (1 + np.exp(-m[mine] @ w[i])) - y[mine])
        if penalty == "l2":
            assert np.abs(g + w[i]).max() < 1e-6
        else:
            assert all(abs(gj + np.sign(wj)) < 1e-5 if wj else abs(gj) <= 1 + 1e-9 for gj, wj in zip(g, w[i], strict=True))
    assert penalty == "l2" or (w[0] == 0).any()
