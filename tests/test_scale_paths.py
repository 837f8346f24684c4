"""The large-data code paths, forced on small inputs and checked by brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.functions.hashing import hash52
from tallyspark.operators.orderstats import select_ranks
from tallyspark.operators.quantiles import kth_values, long_values, quantiles, with_order_key
from tallyspark.operators.profile import box_outliers, box_stats, histogram, summary_stats, violin_density
from tallyspark.operators.ranking import early_stop
from tallyspark.operators.split import kfold, stratified_split, train_valid_test


def _keyed(spark, n=997, skew=True):
    # one class holds most rows (a hot key)
    pdf = pd.DataFrame({"id": np.arange(n), "y": np.where(np.arange(n) % 7 == 0, 0, 1) if skew
                        else np.arange(n) % 2})
    return spark.createDataFrame(pdf)


def test_select_ranks_by_any_division_equals_window(spark):
    df = _keyed(spark).withColumn("y", F.when(F.col("y") == 1, 1)).withColumn("_h", hash52("s", "id"))   # a null group

    def wanted(g):
        return g.select("y", F.lit(0).alias("_tid"), F.floor(F.col("_n") / 3).cast("bigint").alias("_rank"))

    w = Window.partitionBy("y").orderBy("_h", "id")
    want = sorted(map(repr, df.withColumn("r", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("y")))
                      .where("r = floor(n / 3)").select("y", "_h", "id").toLocalIterator()))
    for bits, rows in ((12, 100_000), (3, 4), (1, 2)):   # buckets are divided again and again
        got = select_ranks(df, ["y"], wanted, h="_h", key="id", bucket_bits=bits, bucket_rows=rows)
        assert sorted(map(repr, got.select("y", F.col("_th").alias("_h"), F.col("_tk").alias("id")).toLocalIterator())) == want
    assert len(want) == 2


def test_null_label_is_a_class(spark):
    df = _keyed(spark, 100).withColumn("y", F.when(F.col("y") == 1, 1))
    got = {(r["y"], r["split"]): r["n"] for r in stratified_split(df, "y", "id", 0.2).groupBy("y", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {(None, "test"): 3, (None, "train"): 12, (1, "test"): 17, (1, "train"): 68}
    parts = train_valid_test(df, "y", "id").groupBy("y", "split").count().collect()
    assert {(r["y"], r["split"]) for r in parts} == {(y, s) for y in (None, 1) for s in ("train", "valid", "test")}


def test_stratified_split_sizes_and_determinism(spark):
    df = _keyed(spark)
    s1 = stratified_split(df, "y", "id", 0.2, seed="x").toPandas()
    s2 = stratified_split(df, "y", "id", 0.2, seed="x").toPandas()
    assert s1.sort_values("id").equals(s2.sort_values("id"))
    for y, g in s1.groupby("y"):
        assert (g["split"] == "test").sum() == round(len(g) * 0.2)
    assert len(s1) == 997  # no row dropped


def test_kfold_exact_sizes(spark):
    out = kfold(_keyed(spark, 103), "id", k=5, seed="k").toPandas()
    sizes = out["fold"].value_counts().sort_index().tolist()
    assert sizes == [21, 21, 21, 20, 20]


def test_kfold_fewer_rows_than_folds(spark):
    out = kfold(_keyed(spark, 3), "id", k=5).toPandas()
    assert sorted(out["fold"]) == [0, 1, 2]


def test_order_key_orders_doubles(spark):
    rng = np.random.default_rng(2)
    xs = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500), 2.0 ** np.arange(-1074, 1024, 7.0),
                         np.nextafter(2.0 ** np.arange(-1000, 1000, 50.0), 0), [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308,
                                                                               float("inf"), float("-inf"), 1.0, -1.0, 1e-320]])
    xs = np.unique(np.concatenate([xs, -xs]))
    df = spark.createDataFrame(pd.DataFrame({"i": np.arange(len(xs)), "x": xs}))
    keys = [r["k"] for r in with_order_key(df, "x", "k").orderBy("i").collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(np.unique(xs + 0.0))


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.exponential(10, 3000) - 5, np.full(1500, 7.25), [1e300, -1e300, 0.0]])  # a hot value
    g = np.where(np.arange(len(vals)) % 3 == 0, "a", None)   # a null group
    df = spark.createDataFrame([(x, float(v)) for x, v in zip(g, vals)], "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = quantiles(df, ["x"], probs, by=["g"]).collect()
    assert len(got) == 2 * len(probs)
    for r in got:
        want = np.quantile(vals[g == r["g"]] if r["g"] else vals[g != "a"], r["p"])
        assert abs(r["value"] - want) <= 1e-9 * max(1, abs(want)), (r, want)


def test_infinity_is_a_value(spark):
    df = spark.createDataFrame([(float(i),) for i in range(40)] + [(float("inf"),), (float("nan"),), (None,)], "x double")
    s = summary_stats(df, ["x"]).first()
    assert (s["count"], s["p50"], s["max"]) == (41, 20.0, float("inf"))
    assert quantiles(df, ["x"], [1.0]).first()["value"] == float("inf")
    b = box_stats(df, "x").first()
    assert (b["median"], b["n_outliers"], b["whisker_high"]) == (20.0, 1, 39.0)


def test_null_classes_are_kept(spark):
    df = spark.createDataFrame([(None if i % 2 else "a", float(i)) for i in range(40)], "g string, x double")
    h = {(r["g"], r["bin"]): r["count"] for r in histogram(df, "x", 2, by=["g"]).collect()}
    assert h == {("a", 1): 10, ("a", 2): 10, (None, 1): 10, (None, 2): 10}
    assert {r["g"]: r["n"] for r in box_stats(df, "x", by=["g"]).collect()} == {"a": 20, None: 20}
    v = violin_density(df, "x", by=["g"], n_points=5).collect()
    assert sorted((str(r["g"]), r["point"]) for r in v) == sorted((g, p) for g in ("a", "None") for p in range(5))
    assert {r["g"] for r in summary_stats(df, ["x"], by=["g"]).collect()} == {"a", None}
    assert box_outliers(df.union(spark.createDataFrame([(None, 1e6)], df.schema)), "x", by=["g"]).first()["g"] is None


def test_brackets_hold_the_exact_values(spark, monkeypatch):
    from tallyspark.operators import quantiles as Q
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(size=20000), np.full(9000, 0.25), r.exponential(size=11000) * 1e6, [np.inf, -np.inf]])
    df = spark.createDataFrame(pd.DataFrame({"g": np.where(np.arange(len(x)) % 3 == 0, "a", "b"), "x": x})).repartition(7)
    probs = [0.0, 0.001, 0.25, 0.5, 0.731, 0.999, 1.0]

    def values():
        return {(t["g"], t["p"]): t["value"] for t in quantiles(df, ["x"], probs, by=["g"]).collect()}

    got = values()
    for g in "ab":
        mine = np.sort(x[(np.arange(len(x)) % 3 == 0) == (g == "a")])
        for p in probs:
            at = p * (len(mine) - 1)
            low, high = mine[int(np.floor(at))], mine[int(np.ceil(at))]
            assert got[g, p] == low if low == high else np.isclose(got[g, p], low + (high - low) * (at - np.floor(at)))
    monkeypatch.setattr(Q, "MOST_INSIDE", 10)              # brackets would hold too many rows: digit by digit
    assert values() == got


def test_kth_values_of_one_value(spark):
    long = long_values(spark.createDataFrame(pd.DataFrame({"x": [5.0] * 100})), ["x"])
    got = kth_values(long, ["column_name"], lambda n: n.select("column_name", F.lit(0).alias("_tid"), F.lit(50).cast("bigint").alias("_rank")))
    assert got.first()["_value"] == 5.0


def _brute_early_stop(losses, patience):
    best_l, best_r = float("inf"), None
    for r, l in losses:
        if l < best_l:
            best_l, best_r = l, r
        if r - best_r >= patience:
            return best_r, best_l, r
    return best_r, best_l, None


def test_early_stop_chunked_equals_loop(spark):
    rng = np.random.default_rng(3)
    rows = []
    for run in ("a", "b", "c"):
        rounds = np.sort(rng.choice(5000, 400, replace=False))
        loss = np.round(rng.random(400) + np.linspace(1, 0, 400), 2)
        rows += [(run, int(r), float(l)) for r, l in zip(rounds, loss)]
    rows.append(("flat", 0, 1.0))
    rows += [("flat", i, 1.0) for i in range(1, 60)]
    rows += [(None, i, float(i)) for i in range(45)]   # a run without a name stops too
    df = spark.createDataFrame(rows, "run_id string, round long, loss double")
    got = {r["run_id"]: r for r in early_stop(df, patience=40, chunk=16).collect()}
    for run in ("a", "b", "c", "flat", None):
        seq = sorted((r, l) for k, r, l in rows if k == run)
        br, bl, stop = _brute_early_stop(seq, 40)
        if stop is None:
            br, bl = min(seq, key=lambda t: (t[1], t[0]))
        g = got[run]
        assert (g["best_round"], g["best_loss"], g["stop_round"]) == (br, bl, stop), run
    assert got["flat"]["best_round"] == 0 and got["flat"]["stop_round"] == 40


def test_rank_within_spans_partitions(spark):
    from pyspark.sql import Window
    from tallyspark.operators.ranking import rank_within
    rng = np.random.default_rng(5)
    n = 12000
    pdf = pd.DataFrame({"m": np.where(np.arange(n) % 10 == 0, "b", "hot"), "v": np.arange(n),
                        "s": np.round(rng.random(n), 2)})
    df = spark.createDataFrame(pdf)
    got = rank_within(df, ["m"], [F.col("s").desc(), F.col("v").asc()], n_parts=7)
    w = Window.partitionBy("m").orderBy(F.col("s").desc(), F.col("v").asc())
    want = df.withColumn("position", F.row_number().over(w))
    a = sorted(tuple(r) for r in got.select("m", "v", "position").collect())
    b = sorted(tuple(r) for r in want.select("m", "v", "position").collect())
    assert a == b


def test_binned_density_keeps_its_error_bound(spark):
    r = np.random.default_rng(11)
    x = np.concatenate([r.normal(size=3000), r.normal(6, 0.3, size=2000), [1e5, -2e4]])
    got = violin_density(spark.createDataFrame(pd.DataFrame({"x": x})).repartition(5), "x", n_points=21).orderBy("point").collect()
    h = 1.06 * x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 21)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.allclose([t["grid_x"] for t in got], grid)
    assert np.abs(np.array([t["density"] for t in got]) - want).max() <= 1 / (8 * 64 ** 2) / (h * np.sqrt(2 * np.pi)) * (1 + 1e-9)


def test_density_sums_no_kernel_over_rows(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": np.random.default_rng(1).normal(size=100)}))
    plan = violin_density(df, "x")._jdf.queryExecution().optimizedPlan().toString()
    lines = [i for i, line in enumerate(plan.splitlines()) if "EXP(" in line.upper()]
    bins = [i for i, line in enumerate(plan.splitlines()) if "Aggregate [bin#" in line]
    assert lines and bins and max(lines) < min(bins)   # the kernel stands above the aggregate into bins


def test_correlations_over_several_blocks(spark):
    from tallyspark.operators.correlation import correlations
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 7)) @ r.normal(size=(7, 7)) + 1e6
    x[r.random(x.shape) < 0.2] = np.nan
    x[:, 5] = 3.7
    frame = pd.DataFrame(x, columns=[f"a {i}%" for i in range(7)])
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), ", ".join(f"`a {i}%` double" for i in range(7))).repartition(6)
    for block in (2, 7):
        got = {(t["f1"], t["f2"]): t["r"] for t in correlations(df, df.columns, block).collect()}
        assert len(got) == 49
        for a in frame:
            for b in frame:
                if a == b:
                    assert got[a, b] == 1.0
                elif "a 5%" in (a, b):
                    assert got[a, b] is None
                else:
                    assert abs(got[a, b] - frame[a].corr(frame[b])) < 1e-9


def test_correlations_of_few_rows_and_infinities(spark):
    from tallyspark.operators.correlation import correlations
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, float("inf"), 1.0), (3.0, 1.0, 2.0), (5.0, 0.5, None)], "a double, b double, c double")
    got = {(t["f1"], t["f2"]): t["r"] for t in correlations(df, ["a", "b", "c"]).collect()}
    assert np.isnan(got["a", "b"]) and np.isnan(got["c", "b"]) and abs(got["a", "c"] - 1) < 1e-12
    none = {(t["f1"], t["f2"]): t["r"] for t in correlations(df.limit(0), ["a", "b"]).collect()}
    assert none == {("a", "a"): 1.0, ("b", "b"): 1.0, ("a", "b"): None, ("b", "a"): None}


def test_correlation_plan_of_two_thousand_columns(spark):
    from tallyspark.operators.correlation import correlations
    r = np.random.default_rng(8)
    x = r.normal(size=(30, 2000))
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"c{i}" for i in range(2000)]))
    out = correlations(df, df.columns)
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 5_000_000
    some = {(t["f1"], t["f2"]): t["r"] for t in out.where("f1 = 'c3' AND f2 IN ('c7', 'c1999')").collect()}
    for j in (7, 1999):
        assert abs(some["c3", f"c{j}"] - np.corrcoef(x[:, 3], x[:, j])[0, 1]) < 1e-12
