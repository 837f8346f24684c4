"""Feature tables derived from the driver tables, shared by several queries.

The driver tables hold no nulls, so the order feature table injects the
null pattern of the reference's one nullable feature in a fixed way (every
order whose key is a multiple of 10 has no price) to exercise profiling and
imputation. All rows are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators.prep import mean_impute
from tallyspark.operators.scoring import score_linear
from tallyspark.sources.tables import table

# The literal logistic model scored on order features.
ORDER_MODEL = {"intercept": -1.2, "price_scaled": 2.0, "prio": 0.1}
PRICE_SCALE = 500000.0
SPLIT_SEED = "42"
TEST_FRAC = 0.2
ROUND = 6


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, price [nullable], prio, label) from orders."""
    return _order_features(table(spark, sf_dir, "orders"))


def _order_features(o: DataFrame, *carry: str) -> DataFrame:
    return o.select(
        "o_orderkey", *carry,
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("price"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("prio"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)).alias("label"),
    )


def imputed_order_features(spark: SparkSession, sf_dir: str, *carry: str) -> DataFrame:
    """order_features (and ``carry`` columns of orders) with price mean-imputed (A2) and scaled."""
    f = mean_impute(_order_features(table(spark, sf_dir, "orders"), *carry), ["price"])
    return f.withColumn("price_scaled", F.col("price") / F.lit(PRICE_SCALE))


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imputed order features scored by the literal model: prob, prediction."""
    coefs = {k: v for k, v in ORDER_MODEL.items() if k != "intercept"}
    return score_linear(imputed_order_features(spark, sf_dir), coefs, ORDER_MODEL["intercept"])


# ---------------------------------------------------------------- derived registry tables

def version_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metrics row per (model, version): models are event types, versions
    user ids + 1; rates are ratios of event counts (exact in any engine)."""
    e = table(spark, sf_dir, "events")
    n = F.count(F.lit(1))
    hi = F.count_if(F.col("value") >= 100)
    return e.groupBy(F.col("event_type").alias("model_name"),
                     (F.col("user_id") + 1).cast("int").alias("model_version")).agg(
        n.alias("n"),
        (F.count_if(F.col("value") >= 50) / n).alias("accuracy"),
        (hi / n).alias("precision"),
        (F.count_if(F.col("value") >= 20) / n).alias("recall"),
        (2 * hi / (n + hi)).alias("f1"))


def registered_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model_name, version): versions that exist, with gaps."""
    e = table(spark, sf_dir, "events").filter(F.col("value") >= 100)
    return e.select(F.col("event_type").alias("model_name"),
                    (F.col("user_id") + 1).cast("int").alias("version")).distinct()


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model_name, version, stage, ts, seq): one stage change per event."""
    e = table(spark, sf_dir, "events")
    stage = (F.when(F.col("value") >= 100, F.lit("Production"))
              .when(F.col("value") >= 20, F.lit("Staging")).otherwise(F.lit("Archived")))
    return e.select(F.col("event_type").alias("model_name"),
                    (F.col("user_id") + 1).cast("int").alias("version"),
                    stage.alias("stage"), F.col("ts"), F.col("event_id").alias("seq"))


# Hyper-parameter search space (log-uniform bounds are exponents).
SEARCH_SPACE = {
    "max_depth": ("quniform", 4, 300, 1),
    "learning_rate": ("loguniform", -3, 0),
    "reg_alpha": ("loguniform", -5, -1),
    "reg_lambda": ("loguniform", -6, -1),
    "min_child_weight": ("loguniform", -1, 3),
}
# Our own limits, those of the learner: draws beyond are drawn anew inside (see trial_params).
MAX_TREE_DEPTH = 30


def draw_params(df: DataFrame, key: str, seed: str = SPLIT_SEED) -> DataFrame:
    """M4: one reproducible draw of every search parameter per row of ``df``."""
    from tallyspark.functions.hashing import uniform
    from tallyspark.functions.scalar import log_uniform, quniform
    out = df
    for name, spec in SEARCH_SPACE.items():
        u = uniform(f"{seed}:{name}", key)
        if spec[0] == "loguniform":
            out = out.withColumn(name, log_uniform(u, spec[1], spec[2]))
        else:
            out = out.withColumn(name, quniform(u, spec[1], spec[2], spec[3]).cast("int"))
    return out


def trial_params(df: DataFrame, key: str, seed: str = SPLIT_SEED) -> DataFrame:
    """M4 for the learner at hand: the same draws, with the depth drawn up to ``MAX_TREE_DEPTH``."""
    from tallyspark.functions.hashing import uniform
    from tallyspark.functions.scalar import quniform
    low = SEARCH_SPACE["max_depth"][1]
    depth = quniform(uniform(f"{seed}:max_depth", key), low, MAX_TREE_DEPTH, 1).cast("int")
    return draw_params(df, key, seed).withColumn("max_depth", depth)


# The literal logistic model applied to event values.
EVENT_MODEL = {"intercept": -1.0, "value": 0.01}


def score_events(df: DataFrame) -> DataFrame:
    """Events scored by the literal model: prob, prediction (M1)."""
    return score_linear(df, {"value": EVENT_MODEL["value"]}, EVENT_MODEL["intercept"])


def requests(events: DataFrame) -> DataFrame:
    """Scoring requests from events, as texts, with every kind of fault at fixed places: a missing field, a text in
    a number's place, a negative number and an unknown model."""
    n, k = F.col("event_id"), F.get_json_object("props", "$.k")
    return events.select(
        "event_id", "ts",
        F.when(n % 17 == 0, F.lit(None)).when(n % 19 == 0, F.lit("abc")).otherwise(k).alias("k"),
        F.when(n % 23 == 0, -F.col("value")).otherwise(F.col("value")).alias("value"), "user_id",
        F.when(n % 29 == 0, F.lit("no such model")).when(n % 31 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"))


def json_lines(events: DataFrame) -> DataFrame:
    """The same requests as raw JSON lines (``value``), a few cut off, without braces, or with an object or a list where a number belongs."""
    n = F.col("event_id")
    fields = [("k", F.get_json_object("props", "$.k")), ("user_id", F.col("user_id").cast("string"))]
    k = (F.when(n % 17 == 0, F.lit("null")).when(n % 19 == 0, F.lit('"abc"')).when(n % 37 == 0, F.lit('{"v": 1}')).when(n % 41 == 0, F.lit("[1, 2]"))
         .when(n % 23 == 0, F.concat(F.lit("-"), fields[0][1], F.lit(".5"))).otherwise(fields[0][1]))
    name = F.when(n % 29 == 0, F.lit("no such model")).otherwise(F.col("event_type"))
    body = F.concat(F.lit('"id": '), n.cast("string"), F.lit(', "k": '), k, F.lit(', "user_id": "'), fields[1][1], F.lit('"'),
                    F.when(n % 31 == 0, F.lit("")).otherwise(F.concat(F.lit(', "model_name": "'), name, F.lit('"'))))
    line = (F.when(n % 43 == 0, F.concat(F.lit("{"), body)).when(n % 47 == 0, body).when(n % 53 == 0, F.concat(F.lit("[{"), body, F.lit("}]")))
            .otherwise(F.concat(F.lit("{"), body, F.lit("}"))))
    return events.select(line.alias("value"))


def write_prediction_log(spark: SparkSession, sf_dir: str) -> str:
    """Score every event and append {prediction, player, timestamp} records
    to a fresh table in the shared folder; returns its path."""
    from tallyspark.session import shared_path
    from tallyspark.sources.files import append_events, prediction_events
    scored = score_events(table(spark, sf_dir, "events"))
    events = prediction_events(scored, "prediction", ["event_id", "user_id", "event_type", "value"], ts="ts")
    return append_events(events, shared_path(spark, "prediction-log"))
