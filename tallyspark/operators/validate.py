"""Input validation (F1-F3): row-level reasons, table-level policy, request schema.

Every check is a column expression evaluated in the scan's stage; results are
an accepted table and a rejected table carrying reasons, never a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.prep import q

POLICIES = ("reject_file", "reject_rows", "allow")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def negative_reason(cols: Sequence[str]) -> Column:
    """NULL when no column is negative, else 'negative value in a,b'."""
    names = F.concat_ws(",", *[F.when(q(c) < 0, F.lit(c)) for c in cols])
    return F.when(names == "", F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("negative value in "), names))


def flag_negatives(df: DataFrame, cols: Sequence[str] | None = None,
                   exclude: Sequence[str] = ()) -> DataFrame:
    """add ``status`` (accepted/rejected) and ``reason`` per row."""
    cols = list(cols or numeric_columns(df, exclude))
    reason = negative_reason(cols)
    return (df.withColumn("reason", reason)
              .withColumn("status", F.when(F.col("reason").isNull(), F.lit("accepted"))
                          .otherwise(F.lit("rejected"))))


def split_accepted(df: DataFrame, cols: Sequence[str] | None = None,
                   exclude: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with reason)."""
    flagged = flag_negatives(df, cols, exclude)
    return (flagged.filter(F.col("status") == "accepted").drop("status", "reason"),
            flagged.filter(F.col("status") == "rejected").drop("status"))


def negative_file_check(df: DataFrame, cols: Sequence[str] | None = None,
                        exclude: Sequence[str] = ()) -> DataFrame:
    """one row (n_rows, n_negative_rows, file_rejected) in one aggregate."""
    cols = list(cols or numeric_columns(df, exclude))
    any_neg = F.lit(False)
    for c in cols:
        any_neg = any_neg | F.coalesce(q(c) < 0, F.lit(False))
    return (df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(any_neg).alias("n_negative_rows"))
              .withColumn("file_rejected", F.col("n_negative_rows") > 0))


def apply_negative_policy(df: DataFrame, policy: str = "reject_file",
                          cols: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """F2 policy: 'reject_file' fails the job if any value is negative (checked
    lazily by one aggregate joined back), 'reject_rows' drops such rows,
    'allow' keeps everything (the reference as coded)."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    if policy == "allow":
        return df
    cols = list(cols or numeric_columns(df, exclude))
    if policy == "reject_rows":
        return split_accepted(df, cols)[0]
    check = negative_file_check(df, cols).select(
        F.when(F.col("file_rejected"),
               F.raise_error(F.lit("Invalid entry, all values must be non-negative")))
         .otherwise(F.lit(True)).alias("_ok"))
    return df.crossJoin(F.broadcast(check)).filter(F.col("_ok")).drop("_ok")


def request_errors(df: DataFrame, numeric_fields: Sequence[str],
                   string_fields: Sequence[str] = (), known: DataFrame | None = None,
                   known_field: str | None = None) -> DataFrame:
    """``errors`` ARRAY<STRING> per request; numeric fields must be present,
    numbers and non-negative; string fields present; ``known_field`` must
    appear in ``known`` (e.g. registered model names, a small table)."""
    checks: list[Column] = []
    for f in numeric_fields:
        raw = q(f)
        num = raw.cast("string").try_cast("double")
        checks.append(F.when(raw.isNull(), F.lit(f"{f}: missing")))
        checks.append(F.when(raw.isNotNull() & num.isNull(), F.lit(f"{f}: not a number")))
        checks.append(F.when(num < 0, F.lit(f"{f}: negative")))
    for f in string_fields:
        checks.append(F.when(q(f).isNull(), F.lit(f"{f}: missing")))
    out = df
    if known is not None and known_field:
        names = known.select(F.col(known_field).alias("_known")).distinct()
        out = out.join(names, q(known_field) == F.col("_known"), "left")
        checks.append(F.when(q(known_field).isNotNull() & F.col("_known").isNull(),
                             F.lit(f"{known_field}: unknown")))
    errs = F.filter(F.array(*checks), lambda e: e.isNotNull())
    out = out.withColumn("errors", errs)
    return out.drop("_known") if known is not None and known_field else out
