"""Run, version and stage tables.

The registry is a set of append-only tables (``runs``, ``versions``,
``stage_events``); current state is always derived by aggregates, so readers
never need locks and history is kept. Top-1 choices use ``max_by`` /
``min_by`` aggregates (partial aggregation, no per-model sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.session import materialize

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("experiment", T.StringType(), True),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType()), True),
])
VERSIONS_SCHEMA = "model_name string, version int, uri string, run_id string"
STAGE_EVENTS_SCHEMA = "model_name string, version int, stage string, ts timestamp, seq bigint"


def runs_frame(spark: SparkSession, runs: list[tuple]) -> DataFrame:
    """Run records (run_id, experiment, params, metrics, tags) as a table."""
    return spark.createDataFrame(runs, RUNS_SCHEMA)


def append_runs(df: DataFrame, path: str) -> None:
    """Append run rows to the runs table (Parquet, append-only)."""
    df.write.mode("append").parquet(path)


def run_metrics_long(runs: DataFrame) -> DataFrame:
    """(run_id, metric, value) from the metrics map."""
    return runs.select("run_id", F.explode("metrics").alias("metric", "value"))


def next_versions(versions: DataFrame, model_col: str = "model_name", version_col: str = "version") -> DataFrame:
    """R2: next version number per model = max + 1 (1 for a new model)."""
    return versions.groupBy(model_col).agg(
        (F.coalesce(F.max(version_col), F.lit(0)) + 1).cast("int").alias("next_version"))


def register_version(spark: SparkSession, versions: DataFrame, model_name: str, uri: str,
                     run_id: str | None = None) -> DataFrame:
    """R2: the row to append for a new version of ``model_name`` (single writer)."""
    nxt = next_versions(versions.filter(F.col("model_name") == model_name))
    new = spark.createDataFrame([(model_name, uri, run_id)], "model_name string, uri string, run_id string")
    return (new.join(nxt, on="model_name", how="left")
               .select("model_name", F.coalesce("next_version", F.lit(1)).cast("int").alias("version"), "uri", "run_id"))


def current_stage(events: DataFrame, model_col: str = "model_name", version_col: str = "version",
                  stage_col: str = "stage", ts_col: str = "ts", seq_col: str = "seq") -> DataFrame:
    """Latest stage per (model, version) by (ts, seq)."""
    latest = F.max_by(F.struct(F.col(stage_col).alias("stage"), F.col(seq_col).alias("seq")),
                      F.struct(F.col(ts_col), F.col(seq_col)))
    return (events.groupBy(model_col, version_col).agg(latest.alias("_l"))
                  .select(model_col, version_col, F.col("_l.stage").alias("stage"),
                          F.col("_l.seq").alias("last_seq")))


def promote(spark: SparkSession, model_name: str, version: int | None, stage: str = "Production",
            events: DataFrame | None = None):
    """The stage event to append (``STAGE_EVENTS_SCHEMA``); None (a no-op) when there is no version.

    ``seq`` follows the highest one of ``events``, so it orders changes within the same instant.
    """
    if version is None:
        return None
    row = spark.createDataFrame([(model_name, int(version), stage)], "model_name string, version int, stage string")
    last = (events.agg(F.max("seq").alias("_last")) if events is not None
            else spark.createDataFrame([(None,)], "_last bigint"))
    return row.crossJoin(F.broadcast(last)).select(
        "model_name", "version", "stage", F.current_timestamp().alias("ts"), (F.coalesce("_last", F.lit(0)) + 1).cast("bigint").alias("seq"))


def list_experiments(runs: DataFrame) -> DataFrame:
    """Experiments with their number of runs."""
    return runs.groupBy("experiment").agg(F.count(F.lit(1)).alias("n_runs"))


def list_models(versions: DataFrame, model_col: str = "model_name", version_col: str = "version") -> DataFrame:
    """Models with their number of versions and latest version."""
    return versions.groupBy(model_col).agg(F.count(F.lit(1)).alias("n_versions"),
                                           F.max(version_col).alias("latest_version"))


def versions_of(versions: DataFrame, model_name: str, model_col: str = "model_name") -> DataFrame:
    """versions of one model."""
    return versions.filter(F.col(model_col) == model_name)


def version_in_stage(stages: DataFrame, stage: str = "Production", model_col: str = "model_name",
                     version_col: str = "version") -> DataFrame:
    """per model, the highest version whose current stage is ``stage``."""
    return (stages.filter(F.col("stage") == stage).groupBy(model_col)
                  .agg(F.max(version_col).alias(version_col)))


def version_lookup(versions: DataFrame, model_name: str, version: int) -> DataFrame:
    """one (model, version) row."""
    return versions.filter((F.col("model_name") == model_name) & (F.col("version") == version))


def versions_of_run(versions: DataFrame, run_id: str) -> DataFrame:
    """the versions registered from one run."""
    return versions.filter(F.col("run_id") == run_id)


def leaderboard(metrics: DataFrame, metric: str, model_col: str = "model_name",
                version_col: str = "model_version") -> DataFrame:
    """O2: versions ranked by ``metric`` descending (ties: lower version first).

    Positions come from a distributed two-pass rank, so a model with very many
    versions is spread over many tasks.
    """
    from tallyspark.operators.ranking import rank_within
    return rank_within(metrics, [model_col], [F.col(metric).desc_nulls_last(), F.col(version_col).asc()])


def best_version(metrics: DataFrame, metric: str, model_col: str = "model_name",
                 version_col: str = "model_version") -> DataFrame:
    """O3: highest ``metric`` per model, ties to the lowest version, nulls never win."""
    ok = metrics.filter(F.col(metric).isNotNull() & ~F.isnan(metric))
    order = F.struct(F.col(metric), (-F.col(version_col)).alias("_nv"))
    return ok.groupBy(model_col).agg(
        F.max_by(F.col(version_col), order).alias(version_col),
        F.max(metric).alias(metric))


def gap_free_versions(versions: DataFrame, model_col: str = "model_name",
                      version_col: str = "version") -> DataFrame:
    """Versions 1, 2, 3 ... up to the first missing number, per model.

    The first gap is the smallest candidate (1 or v + 1) not present: an
    anti-join and a min aggregate, no per-model ordering.
    """
    v = materialize(versions.select(model_col, F.col(version_col).cast("int").alias(version_col)).distinct(), "versions")
    cand = (v.select(model_col, (F.col(version_col) + 1).alias(version_col))
             .unionByName(v.select(model_col).distinct().withColumn(version_col, F.lit(1))))
    gaps = cand.join(v, on=[model_col, version_col], how="left_anti")
    first_gap = gaps.groupBy(model_col).agg(F.min(version_col).alias("_gap"))
    return (v.join(first_gap, on=model_col)
             .filter(F.col(version_col) < F.col("_gap")).drop("_gap"))
