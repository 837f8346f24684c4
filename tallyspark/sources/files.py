"""File sources and sinks.

CSV is read with a declared schema (never inferred); the default table format
for written tables is Parquet. Fallback sources only skip a location that does
not exist; any other failure is raised.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.prep import typed_features


def read_csv(spark: SparkSession, uri: str, schema: T.StructType | str) -> DataFrame:
    """Headed CSV with a declared schema, no casts."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(uri)


def read_typed_csv(spark: SparkSession, uri: str, schema: T.StructType | str, target: str,
                   key: str | None = None, drop: Sequence[str] = ("Name",)) -> DataFrame:
    """Headed CSV, target to INT (nulls rejected), numeric features to
    DOUBLE, ``drop`` columns removed when present, target last."""
    return typed_features(read_csv(spark, uri, schema), target=target, key=key, drop=drop)


def _missing_path(ex: AnalysisException) -> bool:
    cond = getattr(ex, "getCondition", None) or getattr(ex, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(ex)


def read_first_available(uris: Sequence[str], reader: Callable[[str], DataFrame]) -> DataFrame:
    """S3: the first location whose read resolves; only a missing path falls
    through to the next one, other errors are raised."""
    last: Exception | None = None
    for uri in uris:
        try:
            df = reader(uri)
            df.schema  # noqa: B018 - forces resolution
            return df
        except AnalysisException as ex:
            if not _missing_path(ex):
                raise
            last = ex
    raise FileNotFoundError(f"none of the locations exist: {list(uris)}") from last


def write_table(df: DataFrame, uri: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a table (header row for CSV, no index column)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(uri)
    return uri


def write_predictions(df: DataFrame, base: str, fmt: str = "csv") -> str:
    """Batch predictions under a fresh unique name; fails if it exists."""
    path = f"{base.rstrip('/')}/predictions_{uuid.uuid4()}"
    w = df.write.mode("errorifexists")
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def prediction_events(df: DataFrame, prediction: str, features: Sequence[str],
                      ts: str | None = None) -> DataFrame:
    """S6 record shape: {prediction, player{features}, timestamp}.

    ``ts`` names an event-time column; without one the processing time is used.
    """
    stamp = F.col(ts).cast("timestamp") if ts else F.current_timestamp()
    return df.select(F.col(prediction).cast("int").alias("prediction"),
                     F.struct(*[F.col(f) for f in features]).alias("player"),
                     stamp.alias("timestamp"))


def append_events(events: DataFrame, path: str) -> str:
    """Append prediction events; creates the table when absent."""
    events.write.mode("append").parquet(path)
    return path


def read_events(spark: SparkSession, path: str, n: int | None = 10,
                order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Stored events, first ``n`` by ``order`` (a top-n, not a full sort); a stable answer needs a total order."""
    df = spark.read.parquet(path)
    return df.orderBy(*order).limit(n) if n else df


def records_to_table(spark: SparkSession, rows: Sequence[dict], schema: T.StructType | str) -> DataFrame:
    """List of records (metric dicts, one request) to a table."""
    return spark.createDataFrame(list(rows), schema)
