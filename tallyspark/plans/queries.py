"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads whole driver tables; doubles are rounded to ``ROUND``
places (and -0.0 folded to 0.0) so that results compare exactly with the SQL
oracle in :mod:`tallyspark.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.scalar import outcome_message
from tallyspark.operators import metrics as M
from tallyspark.operators import prep as P
from tallyspark.operators import split as S
from tallyspark.plans.features import (
    ROUND, SPLIT_SEED, TEST_FRAC, imputed_order_features, order_features, scored_orders,
)
from tallyspark.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def r(c, digits: int = ROUND) -> Column:
    """Round and fold -0.0 into 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


RATES = ("accuracy", "precision", "recall", "f1")


def _rounded_rates(df: DataFrame) -> DataFrame:
    for m in RATES:
        df = df.withColumn(m, r(m))
    return df


# ---------------------------------------------------------------- P1-P7, A1, A2

@register("typed_projection")
def typed_projection(spark, d):
    o = table(spark, d, "orders").withColumn(
        "label", F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)))
    return P.typed_features(o, target="label", key="o_orderkey",
                            drop=("Name", "o_orderstatus", "o_orderdate"))


# Display names of the customer table, in column order.
CUSTOMER_DISPLAY = ["Customer Key", "Customer Name", "Nation Key", "Account Balance",
                    "Market Segment"]


@register("display_rename")
def display_rename(spark, d):
    return P.rename_positional(table(spark, d, "customer"), CUSTOMER_DISPLAY)


@register("drop_if_present")
def drop_if_present(spark, d):
    return P.drop_if_present(table(spark, d, "customer"), "Name", "c_name")


@register("null_profile")
def null_profile(spark, d):
    return P.null_profile(order_features(spark, d))


@register("mean_impute")
def mean_impute(spark, d):
    f = P.mean_impute(order_features(spark, d), ["price"], suffix="_imputed")
    return f.select("o_orderkey", r("price_imputed").alias("price_imputed"))


# ---------------------------------------------------------------- SP1-SP3

@register("stratified_split")
def stratified_split(spark, d):
    f = order_features(spark, d).select("o_orderkey", "label")
    return S.stratified_split(f, "label", "o_orderkey", TEST_FRAC, seed=SPLIT_SEED)


@register("second_split")
def second_split(spark, d):
    f = order_features(spark, d).select("o_orderkey", "label")
    return S.train_valid_test(f, "label", "o_orderkey", TEST_FRAC, TEST_FRAC, seed=SPLIT_SEED)


@register("kfold")
def kfold(spark, d):
    f = order_features(spark, d).select("o_orderkey")
    return S.kfold(f, "o_orderkey", k=5, seed=SPLIT_SEED)


@register("label_split")
def label_split(spark, d):
    lab = table(spark, d, "labels").select("doc_id", "quality")
    return S.stratified_split(lab, "quality", "doc_id", TEST_FRAC, seed=SPLIT_SEED)


# ---------------------------------------------------------------- ML10/11, A16-A18

@register("score_fixed")
def score_fixed(spark, d):
    s = scored_orders(spark, d)
    return s.select("o_orderkey", r("prob").alias("prob"), "prediction",
                    outcome_message("prediction").alias("message"))


@register("metrics_by_split")
def metrics_by_split(spark, d):
    s = S.stratified_split(scored_orders(spark, d), "label", "o_orderkey", TEST_FRAC, seed=SPLIT_SEED)
    return _rounded_rates(M.binary_metrics(s, "label", "prediction", by=["split"]))


@register("fold_metrics")
def fold_metrics(spark, d):
    s = S.kfold(scored_orders(spark, d), "o_orderkey", k=5, seed=SPLIT_SEED)
    return _rounded_rates(M.binary_metrics(s, "label", "prediction", by=["fold"]))


@register("fold_mean")
def fold_mean(spark, d):
    s = S.kfold(scored_orders(spark, d), "o_orderkey", k=5, seed=SPLIT_SEED)
    per_fold = M.binary_metrics(s, "label", "prediction", by=["fold"])
    out = M.mean_fold_metrics(per_fold)
    for m in RATES:
        out = out.withColumn(f"mean_{m}", r(f"mean_{m}"))
    return out


@register("logloss")
def logloss(spark, d):
    s = S.stratified_split(scored_orders(spark, d), "label", "o_orderkey", TEST_FRAC, seed=SPLIT_SEED)
    return M.log_loss(s, "label", "prob", by=["split"]).withColumn("logloss", r("logloss"))


# ---------------------------------------------------------------- A3, A6-A15

from tallyspark.operators import profile as PR  # noqa: E402

LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
STAT_ROUND = 4


@register("summary_stats")
def summary_stats(spark, d):
    s = PR.summary_stats(table(spark, d, "lineitem"), LINE_COLS)
    return s.select("column_name", "count", *[r(c, STAT_ROUND).alias(c) for c in
                                             ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register("class_distribution")
def class_distribution(spark, d):
    return PR.class_distribution(table(spark, d, "orders"), "o_orderstatus").withColumn("share", r("share"))


def _hist_out(h: DataFrame) -> DataFrame:
    return h.withColumn("lower", r("lower")).withColumn("upper", r("upper"))


@register("histogram")
def histogram(spark, d):
    return _hist_out(PR.histogram(table(spark, d, "lineitem"), "l_extendedprice", 20))


@register("histogram_by_class")
def histogram_by_class(spark, d):
    return _hist_out(PR.histogram(table(spark, d, "lineitem"), "l_extendedprice", 20, by=["l_returnflag"]))


BOX_COLS = ("q1", "median", "q3", "iqr", "lo_fence", "hi_fence", "whisker_low", "whisker_high")


@register("box_stats")
def box_stats(spark, d):
    b = PR.box_stats(table(spark, d, "lineitem"), "l_extendedprice")
    return b.select(*[r(c, STAT_ROUND).alias(c) for c in BOX_COLS], "n_outliers", "n")


@register("box_by_class")
def box_by_class(spark, d):
    b = PR.box_stats(table(spark, d, "events"), "value", by=["event_type"])
    return b.select("event_type", *[r(c, STAT_ROUND).alias(c) for c in BOX_COLS], "n_outliers", "n")


@register("box_outliers")
def box_outliers(spark, d):
    return PR.box_outliers(table(spark, d, "events"), "value", by=["event_type"], keep=["event_id"])


@register("violin_density")
def violin_density(spark, d):
    v = PR.violin_density(table(spark, d, "events"), "value", by=["event_type"], n_points=50)
    return v.select("event_type", "point", r("grid_x").alias("grid_x"), r("density", 8).alias("density"))


@register("marginal_hist")
def marginal_hist(spark, d):
    m = PR.marginal(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", "histogram", n_bins=10)
    return _hist_out(m)


@register("marginal_box")
def marginal_box(spark, d):
    b = PR.marginal(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", "box")
    return b.select("axis", *[r(c, STAT_ROUND).alias(c) for c in BOX_COLS], "n_outliers", "n")


@register("marginal_violin")
def marginal_violin(spark, d):
    v = PR.marginal(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", "violin", n_points=50)
    return v.select("axis", "point", r("grid_x", STAT_ROUND).alias("grid_x"), r("density", 8).alias("density"))


@register("pearson")
def pearson(spark, d):
    return PR.pearson(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice",
                      by=["l_returnflag"]).withColumn("r", r("r"))


@register("corr_matrix")
def corr_matrix(spark, d):
    return PR.corr_matrix(table(spark, d, "lineitem"), LINE_COLS).withColumn("r", r("r"))


@register("ols_trend")
def ols_trend(spark, d):
    o = PR.ols_trend(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", by=["l_returnflag"])
    return o.select("l_returnflag", r("slope", STAT_ROUND).alias("slope"),
                    r("intercept", STAT_ROUND).alias("intercept"), r("r2").alias("r2"), "n")


# ---------------------------------------------------------------- F1-F3, P8, P12

from tallyspark.operators import validate as V  # noqa: E402
from tallyspark.plans.features import (  # noqa: E402
    draw_params, registered_versions, requests, stage_events, version_metrics,
)


@register("negative_split")
def negative_split(spark, d):
    c = table(spark, d, "customer")
    return V.flag_negatives(c, exclude=["c_custkey"]).select("c_custkey", "status", "reason")


@register("negative_file_check")
def negative_file_check(spark, d):
    return V.negative_file_check(table(spark, d, "customer"), exclude=["c_custkey"])


# Request field -> model column mapping (P8) for event requests.
REQUEST_FIELDS = {"k": "K", "value": "VALUE", "user_id": "USER"}


def _checked(df: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Requests with their errors; faulty numbers are null, never an error of the job."""
    names = known.select(F.col("model_name").alias("event_type")) if known is not None else None
    out = V.request_errors(df, ["k", "value", "user_id"], ["event_type"], known=names, known_field="event_type")
    return out.withColumn("k", F.col("k").try_cast("double"))


@register("request_validation")
def request_validation(spark, d):
    checked = _checked(requests(table(spark, d, "events")), registered_versions(spark, d))
    mapped = P.map_columns(checked, REQUEST_FIELDS, keep=["event_id", "errors"])
    return mapped.select("event_id", F.col("K").alias("k"), "VALUE",
                         F.size("errors").alias("n_errors"),
                         F.concat_ws("; ", "errors").alias("errors_text"))


@register("preference_map")
def preference_map(spark, d):
    c = table(spark, d, "customer")
    pref = (F.when(F.col("c_acctbal") < 0, F.lit("cautious"))
             .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("risk taker"))
             .otherwise(F.lit("neutral")))
    c = c.select("c_custkey", pref.alias("preference"))
    return c.withColumn("metric", P.preference_to_metric("preference"))


# ---------------------------------------------------------------- M4, O4, A20

@register("trial_draws")
def trial_draws(spark, d):
    t = draw_params(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return t.select("o_orderkey", "max_depth",
                    *[r(c).alias(c) for c in ("learning_rate", "reg_alpha", "reg_lambda", "min_child_weight")])


@register("best_trial")
def best_trial(spark, d):
    from tallyspark.operators.ranking import argmin_by_group
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    t = draw_params(o, "o_orderkey").withColumn("f1", F.col("o_totalprice") / F.lit(500000.0))
    t = t.withColumn("loss", M.objective_loss("f1"))
    best = argmin_by_group(t, ["o_custkey"], "loss", "o_orderkey", ["learning_rate", "max_depth"])
    return best.select("o_custkey", "o_orderkey", r("loss").alias("loss"),
                       r("learning_rate").alias("learning_rate"), "max_depth")


# ---------------------------------------------------------------- O2, O3, O5, O6, R1-R4, F4, F5

from tallyspark.operators import registry as RG  # noqa: E402


@register("leaderboard")
def leaderboard(spark, d):
    lb = RG.leaderboard(version_metrics(spark, d), "f1")
    return lb.select("model_name", "model_version", "f1", "position")


@register("best_version")
def best_version(spark, d):
    return RG.best_version(version_metrics(spark, d), "f1")


@register("gap_free_versions")
def gap_free_versions(spark, d):
    return RG.gap_free_versions(registered_versions(spark, d))


@register("next_version")
def next_version(spark, d):
    return RG.next_versions(registered_versions(spark, d))


@register("list_models")
def list_models(spark, d):
    return RG.list_models(registered_versions(spark, d))


@register("model_versions")
def model_versions(spark, d):
    return RG.versions_of(registered_versions(spark, d), "purchase")


@register("current_stage")
def current_stage(spark, d):
    return RG.current_stage(stage_events(spark, d))


@register("stage_version")
def stage_version(spark, d):
    return RG.version_in_stage(RG.current_stage(stage_events(spark, d)), "Production")


@register("run_metrics")
def run_metrics(spark, d):
    vm = version_metrics(spark, d)
    runs = vm.select(
        F.concat_ws("-", "model_name", F.col("model_version").cast("string")).alias("run_id"),
        F.create_map(*[x for m in RATES for x in (F.lit(m), F.col(m))]).alias("metrics"))
    return RG.run_metrics_long(runs)


@register("early_stop")
def early_stop(spark, d):
    from tallyspark.operators.ranking import early_stop as es
    e = table(spark, d, "events").select(F.col("event_type").alias("run_id"),
                                         F.col("event_id").alias("round"), F.col("value").alias("loss"))
    return es(e, patience=40)


# ---------------------------------------------------------------- ML1

@register("minmax_scale")
def minmax_scale(spark, d):
    from tallyspark.operators.training import minmax_scale as mm
    p = mm(table(spark, d, "part"), ["p_size", "p_retailprice"], suffix="_scaled")
    return p.select("p_partkey", r("p_size_scaled").alias("p_size_scaled"),
                    r("p_retailprice_scaled").alias("p_retailprice_scaled"))


# ---------------------------------------------------------------- S6, S7, A19, ST1, ST2

from tallyspark.plans.features import score_events, write_prediction_log  # noqa: E402
from tallyspark.sources import files as FS  # noqa: E402
from tallyspark.streaming import scoring as ST  # noqa: E402


@register("prediction_log_daily")
def prediction_log_daily(spark, d):
    log = spark.read.parquet(write_prediction_log(spark, d))
    return (log.groupBy(F.to_date("timestamp").alias("day"), "prediction")
               .agg(F.count(F.lit(1)).alias("n_events"), F.avg("player.value").alias("avg_value"))
               .withColumn("avg_value", r("avg_value")))


@register("prediction_log_head")
def prediction_log_head(spark, d):
    head = FS.read_events(spark, write_prediction_log(spark, d), n=10, order=("timestamp", "player.event_id"))
    return head.select("prediction", F.col("player.user_id").alias("user_id"),
                       F.col("player.value").alias("value"))


@register("prediction_count")
def prediction_count(spark, d):
    log = spark.read.parquet(write_prediction_log(spark, d))
    return log.agg(F.count(F.lit(1)).alias("n"))


def _event_stream(spark, d):
    schema = table(spark, d, "events").schema
    # a file stream watches a folder; only the events file is picked up
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .parquet(d.rstrip("/")))


def _prepare(known: DataFrame):
    """A batch of requests as prediction events: checked, mapped to model columns, scored (P8, F3, ML10, S6)."""
    def run(batch: DataFrame) -> DataFrame:
        b = P.map_columns(score_events(_checked(requests(batch), known)), REQUEST_FIELDS,
                          keep=["event_id", "event_type", "prediction", "ts", "errors"])
        return b.select("event_id", "event_type", "prediction", outcome_message("prediction").alias("message"),
                        F.struct("K", "VALUE", "USER").alias("player"), F.col("ts").alias("timestamp"), "errors")
    return run


def _scored_stream(spark, d) -> tuple[str, str]:
    """Paths of the accepted and the rejected table of a run over all events."""
    from tallyspark.session import materialize, shared_path
    known = materialize(registered_versions(spark, d).select("model_name").distinct(), "known")
    acc, rej = shared_path(spark, "scored"), shared_path(spark, "rejected")
    ST.score_stream(_event_stream(spark, d), _prepare(known), acc, rej, shared_path(spark, "score-ckpt")).awaitTermination()
    return acc, rej


@register("stream_score")
def stream_score(spark, d):
    got = spark.read.parquet(_scored_stream(spark, d)[0])
    return got.select("event_id", "event_type", "prediction", "message", F.col("player.K").alias("k"), F.col("player.VALUE").alias("value"),
                      F.col("player.USER").alias("user_id"), F.to_date("timestamp").alias("day"))


@register("stream_rejected")
def stream_rejected(spark, d):
    got = spark.read.parquet(_scored_stream(spark, d)[1])
    return got.select("event_id", F.concat_ws("; ", "errors").alias("errors_text"))


@register("stream_json_requests")
def stream_json_requests(spark, d):
    """F3, P9, ST1 on raw JSON: lines become a text stream; both tables are read back by the manifest."""
    from tallyspark.operators import requests as RQ
    from tallyspark.plans.features import json_lines
    from tallyspark.session import materialize, shared_path
    src, acc, rej, log = (shared_path(spark, f"json-{x}") for x in ("lines", "accepted", "rejected", "manifest"))
    json_lines(table(spark, d, "events")).write.text(src)
    known = materialize(registered_versions(spark, d).select("model_name").distinct(), "known")

    def prepare(batch: DataFrame) -> DataFrame:
        parsed = RQ.parse_json_requests(batch, ["id", "k", "user_id", "model_name"])
        checked = RQ.json_request_errors(parsed, ["k", "user_id"], ["model_name"], known=lambda: known, known_field="model_name")
        scored = score_linear(RQ.mixed_to_float(checked, ["k", "user_id"]), {"k": 0.02}, -1.0)
        return scored.select("value", F.col("id").try_cast("bigint").alias("event_id"), "k", "k_text", "user_id", "model_name", "prediction", "errors")

    ST.score_stream(spark.readStream.text(src), prepare, acc, rej, shared_path(spark, "json-ckpt"), manifest_path=log).awaitTermination()
    good = ST.committed(spark, acc, log).withColumn("errors_text", F.lit(""))
    bad = ST.committed(spark, rej, log).select("*", F.concat_ws("; ", "errors").alias("errors_text"))
    # A malformed line has no number: it is found by its text.
    number = F.coalesce("event_id", F.regexp_extract("value", '"id": ([0-9]+)', 1).cast("bigint"))
    return good.unionByName(bad, allowMissingColumns=True).select(
        number.alias("event_id"), "k", "k_text", "user_id", "model_name",
        F.when(F.col("errors_text") == "", F.col("prediction")).alias("prediction"), "errors_text")


@register("stream_monitor")
def stream_monitor(spark, d):
    scored = score_events(_event_stream(spark, d))
    out = ST.run_to_table(spark, ST.monitor(scored, ts="ts", value="value"), "monitor")
    res = spark.read.parquet(out)
    return res.select(F.to_date(F.col("w.start")).alias("day"), "prediction", "n_events",
                      r("avg_value").alias("avg_value"))


# ---------------------------------------------------------------- S1-S5, P2, P3, P9, P10, P13-P15, A4, M2

from tallyspark.functions.scalar import truncate_int  # noqa: E402
from tallyspark.operators.scoring import score_linear, score_versions  # noqa: E402

PLAYER_SCHEMA = "Name string, o_orderkey bigint, price double, prio bigint, label int"


def _order_file(spark, d) -> str:
    """Order features with a name column as a headed CSV in the shared folder; prices below zero come in."""
    from tallyspark.session import shared_path
    o = order_features(spark, d).select(F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("Name"), "o_orderkey",
                                        (F.coalesce("price", F.lit(0.0)) - 20000.0).alias("price"), F.col("prio").cast("bigint").alias("prio"), "label")
    return FS.write_table(o, shared_path(spark, "orders-csv"), fmt="csv")


@register("csv_typed_scan")
def csv_typed_scan(spark, d):
    """The first location that exists, typed; the target's fall-back location is the written one."""
    path = _order_file(spark, d)
    return FS.read_first_available([path + "-missing", path],
                                   lambda uri: FS.read_typed_csv(spark, uri, PLAYER_SCHEMA, "label", key="o_orderkey"))


@register("batch_predict")
def batch_predict(spark, d):
    """S2 -> P1 -> P5 -> P2 -> F2 -> ML10 -> S5: a file of rows becomes a file of predictions, read back."""
    from tallyspark.session import shared_path
    rows = FS.read_csv(spark, _order_file(spark, d), PLAYER_SCHEMA)
    rows = P.drop_strict(P.numeric_to_double(P.drop_if_present(rows, "Name"), exclude=["o_orderkey", "label"]), "label")
    rows = V.apply_negative_policy(rows, "reject_rows", ["price", "prio"])
    scored = score_linear(rows.withColumn("price_scaled", F.col("price") / 500000.0), {"price_scaled": 2.0, "prio": 0.1}, -1.2,
                          prob="predictions", pred=None).drop("price_scaled")
    path = FS.write_predictions(scored, shared_path(spark, "predictions"))
    back = FS.read_csv(spark, path, "o_orderkey bigint, price double, prio double, predictions double")
    return back.select("o_orderkey", "price", "prio", r("predictions").alias("predictions"))


@register("scatter_records")
def scatter_records(spark, d):
    """Points of a plot with their record as text."""
    o = P.label_as_string(order_features(spark, d).where("price IS NOT NULL"), "label", "class")
    o = P.row_to_record(o, ["o_orderkey", "class"], as_json=True)
    pts = P.scatter_data(o.select("o_orderkey", "price", "prio", "class", "record"), "price", "prio", size="price", label="class")
    return pts.select("x", "y", truncate_int("size").alias("size"), "label")


@register("record_head")
def record_head(spark, d):
    """The features of the first rows by key as records, beside their target."""
    f = P.drop_strict(order_features(spark, d), "price")
    top = P.row_to_record(P.head(f, "o_orderkey", 20), ["o_orderkey", "prio"], as_json=True)
    _, target = P.split_features_target(top, "label")
    return top.select("o_orderkey", "record", *target.columns)


@register("table_shape")
def table_shape(spark, d):
    """A4 of features and target."""
    x, y = P.split_features_target(order_features(spark, d), "label")
    return P.shape(x).withColumn("part", F.lit("features")).unionByName(P.shape(y).withColumn("part", F.lit("target")))


# ---------------------------------------------------------------- ML12, ML13, J2, R1-R3, F4-F6

# Coefficients of the versions that promote_best registers: intercept, price_scaled, prio.
VERSION_COEFS = {1: (-1.2, 2.0, 0.1), 2: (-0.5, 1.0, 0.1), 3: (-2.0, 3.0, 0.3), 5: (9.0, 0.0, 0.0)}


@register("promote_best")
def promote_best(spark, d):
    """Versions given as coefficients are stored and registered, all are scored on the test part, and the best of the
    gap-free ones is promoted; the row of each version with its stage then comes from the registry."""
    from tallyspark.operators.models import ModelRegistry
    from tallyspark.session import materialize, shared_path
    reg = ModelRegistry(spark, shared_path(spark, "registry"))
    schema = "intercept double, w_price_scaled double, w_prio double"
    for v, w in VERSION_COEFS.items():
        uri = FS.write_table(spark.createDataFrame([w], schema), f"{reg.base}/coefficients/{v}")
        reg.add_runs([(f"run-{v}", "orders", {"intercept": str(w[0])}, {}, {})])
        # numbers are given here, so that one is missing
        spark.createDataFrame([("orders", v, uri, f"run-{v}")], RG.VERSIONS_SCHEMA).write.mode("append").parquet(f"{reg.base}/versions")
    rows = reg.versions().collect()   # the versions of this call
    coefs = None
    for x in rows:
        one = spark.read.schema(schema).parquet(x["uri"]).select(F.lit(x["model_name"]).alias("model_name"), F.lit(x["version"]).alias("version"), "*")
        coefs = one if coefs is None else coefs.unionByName(one)
    live = RG.gap_free_versions(reg.versions())
    test = S.stratified_split(imputed_order_features(spark, d), "label", "o_orderkey", TEST_FRAC, seed=SPLIT_SEED).where("split = 'test'")
    scored = score_versions(test, coefs, ["price_scaled", "prio"])
    mets = materialize(M.binary_metrics(scored, "label", "prediction", by=["model_name", "version"]), "metrics")
    best = RG.best_version(mets.join(live, ["model_name", "version"], "left_semi").withColumnRenamed("version", "model_version"), "f1").first()
    reg.promote("orders", best["model_version"] if best else None)
    stages = RG.current_stage(reg.stage_events())
    return _rounded_rates(mets.join(stages.select("model_name", "version", "stage"), ["model_name", "version"], "left")).select(
        "model_name", "version", "tp", "fp", "tn", "fn", *RATES, "stage")
