"""Sources/sinks and MLlib invariants."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import training as TR
from tallyspark.sources import files as FS

SCHEMA = "Name string, GP int, `3P%` double, TARGET_5Yrs int"


def _csv(spark, tmp):
    rows = [("p1", 10, 30.0, 1), ("p2", 20, None, 0), ("p3", 30, 40.0, 1), ("p4", 40, 10.0, 0)] * 10
    path = os.path.join(tmp, "players")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.option("header", True).csv(path)
    return path


def test_typed_csv_and_fallback(spark):
    tmp = tempfile.mkdtemp(prefix="ts-io-")
    path = _csv(spark, tmp)
    df = FS.read_first_available([os.path.join(tmp, "missing"), path],
                                 lambda u: FS.read_typed_csv(spark, u, SCHEMA, "TARGET_5Yrs"))
    assert df.columns == ["GP", "3P%", "TARGET_5Yrs"]
    assert dict(df.dtypes) == {"GP": "double", "3P%": "double", "TARGET_5Yrs": "int"}
    assert df.count() == 40
    with pytest.raises(FileNotFoundError):
        FS.read_first_available([os.path.join(tmp, "nope")], lambda u: spark.read.parquet(u))


def test_prediction_sink_unique_and_events(spark):
    tmp = tempfile.mkdtemp(prefix="ts-sink-")
    df = spark.createDataFrame([(1.0, 0.7)], "GP double, predictions double")
    a, b = FS.write_predictions(df, tmp), FS.write_predictions(df, tmp)
    assert a != b and spark.read.option("header", True).csv(a).count() == 1
    ev = FS.prediction_events(df.withColumn("pred", F.lit(1)), "pred", ["GP"])
    log = FS.append_events(ev, os.path.join(tmp, "log"))
    FS.append_events(ev, log)
    assert FS.read_events(spark, log, n=None).count() == 2
    assert FS.read_events(spark, log).schema["player"].dataType.simpleString() == "struct<GP:double>"


def _train_table(spark):
    from tallyspark.plans.ml_queries import order_training
    return order_training(spark, "/root/testdata/sf0.001")


def test_tree_importances_sum_to_one(spark):
    from tallyspark.plans.ml_queries import ORDER_FEATURES
    imp = TR.tree_importance(_train_table(spark), ORDER_FEATURES, "label", kind="rf", num_trees=5, max_depth=3)
    vals = [r["importance"] for r in imp.collect()]
    assert abs(sum(vals) - 1.0) < 1e-9 and vals == sorted(vals)


def test_gbt_loss_halving_and_scores(spark):
    from tallyspark.operators.metrics import log_loss
    from tallyspark.plans.ml_queries import ORDER_FEATURES
    df = _train_table(spark)
    model = TR.train_final(df, ORDER_FEATURES, "label", {"max_depth": 2, "learning_rate": 0.3}, rounds=5)
    losses = TR.round_losses(model, df)
    pred = TR.predict(model, df)
    assert pred.filter((F.col("prob") < 0) | (F.col("prob") > 1)).count() == 0
    direct = log_loss(pred, "label", "prob").first()["logloss"]
    assert abs(losses[-1] - direct) < 1e-6
    assert losses[-1] <= losses[0]


def test_trial_draws_in_range(spark):
    from tallyspark.plans.features import draw_params
    t = draw_params(spark.range(200).withColumnRenamed("id", "t"), "t").toPandas()
    assert t.learning_rate.between(0.0497, 1.0).all() and t.max_depth.between(4, 300).all()
    t2 = draw_params(spark.range(200).withColumnRenamed("id", "t"), "t").toPandas()
    assert t.equals(t2)


def test_early_stopping_stops_and_keeps_first_trees(spark):
    from tallyspark.plans.ml_queries import ORDER_FEATURES
    df = _train_table(spark).withColumn("v", F.col("o_orderkey") % 3)
    train, valid = df.where("v > 0"), df.where("v = 0")
    params = {"max_depth": 4, "learning_rate": 0.5}
    model, curve = TR.train_with_early_stop(train, valid, ORDER_FEATURES, "label", params, rounds=200, patience=5)
    rows = curve.orderBy("round").collect()
    best, stop = rows[0]["best_round"], rows[0]["stop_round"]
    assert stop == best + 5 and rows[-1]["round"] == stop   # the curve ends there
    assert min(range(len(rows)), key=lambda i: rows[i]["logloss"]) == best
    same = TR.train_final(train, ORDER_FEATURES, "label", params, rounds=best + 1)
    a = {r["o_orderkey"]: r["prob"] for r in TR.predict(model, valid).collect()}
    b = {r["o_orderkey"]: r["prob"] for r in TR.predict(same, valid).collect()}
    assert model.stages[-1].getNumTrees == best + 1 and a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_models_are_saved_found_and_loaded(spark):
    from tallyspark.operators.models import ModelRegistry
    from tallyspark.plans.ml_queries import ORDER_FEATURES
    df = _train_table(spark)
    reg = ModelRegistry(spark, tempfile.mkdtemp(prefix="ts-reg-"))
    models = [TR.fit_logistic(df, ORDER_FEATURES, "label", reg=x) for x in (0.0, 1.0)]
    reg.add_runs([("r1", "orders", {"reg": "0"}, {"f1": 0.5}, {}), ("r2", "orders", {"reg": "1"}, {"f1": 0.4}, {})])
    assert [reg.save(m, "orders", f"r{i + 1}") for i, m in enumerate(models)] == [1, 2]
    reg.promote("orders", 2)
    reg.promote("orders", 1, "Staging")
    reg.promote("orders", None)
    from tallyspark.operators.registry import list_experiments
    assert [tuple(r) for r in list_experiments(reg.runs()).collect()] == [("orders", 2)]

    def probs(m):
        return sorted((r["o_orderkey"], round(r["prob"], 12)) for r in TR.predict(m, df).collect())

    want = [probs(m) for m in models]
    assert want[0] != want[1]
    assert probs(reg.load("orders", stage="Production")) == want[1] and probs(reg.load("orders", stage="Staging")) == want[0]
    assert probs(reg.load("orders", version=1)) == want[0] and probs(reg.load("orders", run_id="r2")) == want[1]
    with pytest.raises(LookupError):
        reg.load("orders", stage="Archived")


def test_stream_batch_tried_again_leaves_no_duplicates(spark):
    from tallyspark.streaming import scoring as ST
    tmp = tempfile.mkdtemp(prefix="ts-stream-")
    src = os.path.join(tmp, "in")
    spark.range(1000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN array('bad') ELSE array() END AS errors").write.parquet(src)
    acc, rej, ckpt = (os.path.join(tmp, x) for x in ("acc", "rej", "ckpt"))
    stream = spark.readStream.schema("id bigint, errors array<string>").parquet(src)
    blocked = os.path.join(tmp, "blocked")
    open(blocked, "w").close()   # a file where the rejected table should be: its write fails after the accepted one's
    q = ST.score_stream(stream, lambda b: b, acc, blocked + "/x", ckpt)
    with pytest.raises(Exception):
        q.awaitTermination()
    assert spark.read.parquet(acc).count() == 900
    ST.score_stream(stream, lambda b: b, acc, rej, ckpt).awaitTermination()
    assert spark.read.parquet(acc).count() == 900 and spark.read.parquet(rej).count() == 100


def test_request_check_survives_any_input(spark):
    from tallyspark.plans.features import requests
    from tallyspark.plans.queries import _checked
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    kinds = {e.split(": ")[1] for r in _checked(requests(ev), ev.selectExpr("event_type AS model_name")).collect() for e in r["errors"]}
    assert kinds == {"missing", "not a number", "negative", "unknown"}
