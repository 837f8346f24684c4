"""Structured Streaming scoring (ST1) and monitoring (ST2).

The same column functions as the batch path are applied to a stream:
validate -> score -> message -> prediction event; ``foreachBatch`` writes the
accepted events and the rejected requests to two Parquet tables, each batch to a
folder of its own that is overwritten: a batch that is tried again after a
failure replaces what it wrote before, so no row is there twice. With a manifest,
a batch counts once its line stands there, and readers see whole batches of both
tables or none.
Monitoring is a watermarked event-time window aggregate in append mode:
windows are emitted once closed; rows later than the watermark are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyspark.session import shared_path


def score_stream(stream: DataFrame, prepare: Callable[[DataFrame], DataFrame],
                 accepted_path: str, rejected_path: str, checkpoint: str,
                 available_now: bool = True, manifest_path: str | None = None) -> StreamingQuery:
    """ST1: ``prepare`` maps a (micro-)batch to rows with ``errors`` (array)
    plus the output columns; rows without errors go to ``accepted_path``. Both
    tables have the batch's number as the partition column ``batch_id``.

    ``manifest_path``: a table (batch_id, n_accepted, n_rejected) with one line per
    batch, written after both tables; :func:`committed` reads by it. A batch that
    is tried again after its line was written is left as it is.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if manifest_path and not manifest(spark, manifest_path).where(F.col("batch_id") == batch_id).isEmpty():
            return
        out = prepare(batch).persist()
        try:
            ok = F.size("errors") == 0
            for path, rows in ((accepted_path, out.filter(ok).drop("errors")), (rejected_path, out.filter(~ok))):
                rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            if manifest_path:
                # One row, so one file, which appears in one step.
                (out.agg(F.count_if(ok).alias("n_accepted"), F.count_if(~ok).alias("n_rejected")).coalesce(1)
                    .write.mode("overwrite").parquet(f"{manifest_path}/batch_id={batch_id}"))
        finally:
            out.unpersist()

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """batch_id, n_accepted, n_rejected of the batches that are whole; no rows before the first."""
    schema = "n_accepted bigint, n_rejected bigint, batch_id bigint"
    path = spark._jvm.org.apache.hadoop.fs.Path(manifest_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", manifest_path).parquet(manifest_path)


def committed(spark: SparkSession, path: str, manifest_path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The rows of an accepted or rejected table whose batch stands in the manifest.

    A join on the partition column, so folders of other batches are pruned.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).join(manifest(spark, manifest_path).select("batch_id"), "batch_id", "left_semi")


def monitor(events: DataFrame, ts: str = "timestamp", by: tuple[str, ...] = ("prediction",),
            window: str = "1 day", delay: str = "1 hour", value: str | None = None) -> DataFrame:
    """ST2: per event-time window and group: event count (and mean value)."""
    t = F.col(ts).cast("timestamp")
    df = events.withColumn("_ts", t).withWatermark("_ts", delay)
    aggs = [F.count(F.lit(1)).alias("n_events")]
    if value:
        aggs.append(F.avg(value).alias("avg_value"))
    return df.groupBy(F.window("_ts", window).alias("w"), *by).agg(*aggs)


def run_to_table(spark: SparkSession, query_df: DataFrame, name: str, mode: str = "append") -> str:
    """Run a streaming aggregate to completion (available-now) into Parquet."""
    out = shared_path(spark, f"{name}-out")
    ckpt = shared_path(spark, f"{name}-ckpt")
    q = (query_df.writeStream.format("parquet").outputMode(mode)
         .option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out
