"""Edge cases on hand-made tables."""

import math

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import metrics as M
from tallyspark.operators import prep as P
from tallyspark.operators import registry as RG
from tallyspark.operators import validate as V
from tallyspark.operators.profile import corr_matrix, histogram, pearson, summary_stats
from tallyspark.operators.training import minmax_scale


def test_null_profile_counts_nan_as_null(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "id long, `3P%` double")
    got = {r["column_name"]: r["null_count"] for r in P.null_profile(df).collect()}
    assert got == {"id": 0, "3P%": 2}


def test_mean_impute_and_nan(spark):
    df = P.numeric_to_double(spark.createDataFrame([(1, 2.0), (2, float("nan")), (3, None), (4, 4.0)],
                                                   "id long, `3P%` double"), exclude=["id"])
    out = {r["id"]: r["3P%"] for r in P.mean_impute(df, ["3P%"]).collect()}
    assert out == {1: 2.0, 2: 3.0, 3: 3.0, 4: 4.0}


def test_typed_features_rejects_null_target(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 2, None)], "Name string, GP int, TARGET_5Yrs int")
    typed = P.typed_features(df, "TARGET_5Yrs")
    assert typed.columns == ["GP", "TARGET_5Yrs"]
    assert dict(typed.dtypes)["GP"] == "double"
    with pytest.raises(Exception):
        typed.collect()
    for unread in (typed.select("GP"), typed.groupBy().avg("GP")):   # the check holds where the target isn't read
        with pytest.raises(Exception):
            unread.collect()
    with pytest.raises(Exception):
        typed.count()


def test_drop_variants(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert P.drop_if_present(df, "Name").columns == ["a", "b"]
    with pytest.raises(KeyError):
        P.drop_strict(df, "TARGET_5Yrs")
    with pytest.raises(ValueError):
        P.rename_positional(df, ["x"])


def test_metrics_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    r = M.binary_metrics(df, "y", "p").first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_objective_loss_names(spark):
    df = spark.createDataFrame([(0.25,)], "f1 double")
    assert df.select(M.objective_loss("f1_score").alias("l")).first()["l"] == 0.75
    with pytest.raises(ValueError):
        M.objective_loss("auc")


def test_half_even_rounding(spark):
    from tallyspark.functions.scalar import half_even_int
    df = spark.createDataFrame([(0.5,), (1.5,), (0.49,), (0.51,)], "p double")
    assert [r[0] for r in df.select(half_even_int("p")).collect()] == [0, 2, 0, 1]


def test_best_version_ties_and_nulls(spark):
    m = spark.createDataFrame([("m", 1, 0.5), ("m", 2, 0.7), ("m", 3, 0.7), ("m", 4, None),
                               ("n", 1, None)], "model_name string, model_version int, f1 double")
    got = {r["model_name"]: r["model_version"] for r in RG.best_version(m, "f1").collect()}
    assert got == {"m": 2}  # tie keeps the lowest version; all-null model has no best


def test_gap_free_versions(spark):
    v = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("b", 2), ("c", 1)],
                              "model_name string, version int")
    got = sorted(tuple(r) for r in RG.gap_free_versions(v).collect())
    assert got == [("a", 1), ("a", 2), ("c", 1)]


def test_register_and_stage(spark):
    v = spark.createDataFrame([("a", 1, "u1"), ("a", 2, "u2")], "model_name string, version int, uri string")
    assert RG.register_version(spark, v, "a", "u3").first()["version"] == 3
    assert RG.register_version(spark, v, "new", "u").first()["version"] == 1
    assert RG.promote(spark, "a", None) is None
    first = RG.promote(spark, "a", 1)
    assert first.columns == ["model_name", "version", "stage", "ts", "seq"] and first.first()["seq"] == 1
    assert RG.promote(spark, "a", 2, "Staging", first).first()["seq"] == 2


def test_negative_policies(spark):
    df = spark.createDataFrame([(1, 1.0), (2, -1.0)], "id long, x double")
    assert V.apply_negative_policy(df, "allow").count() == 2
    assert V.apply_negative_policy(df, "reject_rows", exclude=["id"]).count() == 1
    with pytest.raises(Exception):
        V.apply_negative_policy(df, "reject_file", exclude=["id"]).collect()
    rej = V.split_accepted(df, exclude=["id"])[1].first()
    assert rej["reason"] == "negative value in x"


def test_request_errors(spark):
    df = spark.createDataFrame([("1", "m"), ("x", "m"), (None, None), ("-2", "zz")], "gp string, model_name string")
    known = spark.createDataFrame([("m",)], "model_name string")
    out = V.request_errors(df, ["gp"], ["model_name"], known=known, known_field="model_name")
    errs = [sorted(r["errors"]) for r in out.orderBy(F.col("gp").asc_nulls_last()).collect()]
    assert errs == [["gp: negative", "model_name: unknown"], [], ["gp: not a number"],
                    ["gp: missing", "model_name: missing"]]


def test_minmax_constant_column(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id long, c double")
    assert [r["c"] for r in minmax_scale(df, ["c"]).collect()] == [0.0, 0.0]


def test_histogram_constant_and_max_bin(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    h = histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 0, 0, 0]
    df2 = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    assert [r["count"] for r in histogram(df2, "x", 5).orderBy("bin").collect()] == [1, 0, 0, 0, 1]


def test_pearson_refuses_text(spark):
    df = spark.createDataFrame([("a", 1.0)], "s string, x double")
    with pytest.raises(ValueError):
        pearson(df, "s", "x")


def test_corr_matrix_shape(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.5), (2.0, 4.1, 0.1), (3.0, 6.3, 0.9)], "a double, b double, c double")
    rows = corr_matrix(df, ["a", "b", "c"]).collect()
    assert len(rows) == 9
    d = {(r["f1"], r["f2"]): r["r"] for r in rows}
    assert d[("a", "a")] == 1.0 and math.isclose(d[("a", "b")], d[("b", "a")])


def test_summary_with_column_names_with_symbols(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0), (3.0, 5.0)], "`FG%` double, `3P Made` double")
    s = {r["column_name"]: r for r in summary_stats(df, ["FG%", "3P Made"]).collect()}
    assert s["FG%"]["p50"] == 2.0 and s["3P Made"]["count"] == 2 and s["3P Made"]["p25"] == 3.5


def test_shared_folder_is_demanded_on_a_cluster():
    from tallyspark.session import private_folder
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            private_folder(master)
    assert private_folder("local[4]")


def test_order_training_has_one_join(spark):
    from tallyspark.plans.ml_queries import order_training
    plan = order_training(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("orders.parquet") + plan.count("Relation [o_") <= 2 and plan.count("Join Inner, (o_custkey") == 1
    assert "o_orderkey" not in "".join(x for x in plan.splitlines() if "Join Inner, (o_orderkey" in x)
