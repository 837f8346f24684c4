"""Typed projection, renames, null profile and mean imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def q(name: str) -> Column:
    """Column by exact name, safe for names with spaces, dots or percent signs."""
    return F.col("`" + name.replace("`", "``") + "`")


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns when present, silently skip the rest."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def drop_strict(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns, raising when one is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def numeric_to_double(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Cast every numeric column (but ``exclude``) to DOUBLE in one projection.

    NaN becomes NULL so that SQL aggregates skip it the way pandas does.
    """
    out = []
    for f in df.schema.fields:
        c = q(f.name)
        if f.name not in exclude and isinstance(f.dataType, T.NumericType):
            d = c.cast("double")
            out.append(F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def typed_features(df: DataFrame, target: str, key: str | None = None,
                   drop: Sequence[str] = ("Name",)) -> DataFrame:
    """S1 post-read typing: drop ``drop`` if present (P1), numeric features to
    DOUBLE (P5), target to INT with NULL rejected (P6), target last (P4)."""
    df = drop_if_present(df, *drop)
    keep = [key] if key else []
    df = numeric_to_double(df, exclude=keep + [target])
    feats = [c for c in df.columns if c not in keep + [target]]
    tgt = q(target).cast("int")
    # As a filter the check also runs where the target isn't selected.
    bad = F.when(tgt.isNull(), F.raise_error(F.lit(f"null target in {target}")).isNull()).otherwise(F.lit(True))
    return df.filter(bad).select(*[q(c) for c in keep + feats], tgt.alias(target))


def split_features_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Feature projection and target projection of the same table."""
    return df.drop(target), df.select(q(target))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position; counts must match."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def map_columns(df: DataFrame, mapping: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Select ``src AS dst`` for every mapping entry (in mapping order)."""
    missing = [s for s in mapping if s not in df.columns]
    if missing:
        raise KeyError(f"request fields missing: {missing}")
    return df.select(*[q(k) for k in keep], *[q(s).alias(d) for s, d in mapping.items()])


def label_as_string(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """P10."""
    return df.withColumn(out or col, q(col).cast("string"))


# Preference names and the metric each one selects.
PREFERENCE_METRIC = {"cautious": "precision", "risk taker": "recall"}
DEFAULT_METRIC = "f1"


def preference_to_metric(pref) -> Column:
    """Cautious -> precision model, risk taker -> recall model, else f1 model."""
    c = F.col(pref) if isinstance(pref, str) else pref
    expr = None
    for k, v in PREFERENCE_METRIC.items():
        expr = (F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v)))
    return expr.otherwise(F.lit(DEFAULT_METRIC))


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` rows by key (a stable answer needs an order)."""
    return df.orderBy(q(key)).limit(n)


def row_to_record(df: DataFrame, cols: Sequence[str], out: str = "record", as_json: bool = False) -> DataFrame:
    """Pack columns into one nested record (or its JSON text)."""
    s = F.struct(*[q(c) for c in cols])
    return df.withColumn(out, F.to_json(s) if as_json else s)


def scatter_data(df: DataFrame, x: str, y: str, size: str | None = None,
                 label: str | None = None) -> DataFrame:
    """X, y, size, label columns for a scatter plot."""
    cols = [q(x).alias("x"), q(y).alias("y")]
    if size:
        cols.append(q(size).alias("size"))
    if label:
        cols.append(q(label).cast("string").alias("label"))
    return df.select(*cols)


def shape(df: DataFrame) -> DataFrame:
    """A4: one row (n_rows, n_cols), computed by Spark."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def dtypes_table(df: DataFrame) -> DataFrame:
    """A5: (column, type) rows built from the schema (metadata only)."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1: null count of every column in ONE aggregate pass, then unpivoted.

    NaN counts as null for floating columns (pandas ``isnull`` semantics).
    """
    cols = list(cols or df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def is_null(c: str) -> Column:
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            return q(c).isNull() | F.isnan(q(c))
        return q(c).isNull()

    wide = df.agg(*[F.count_if(is_null(c)).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
                      for i, c in enumerate(cols)])
    return wide.select(F.inline(pairs))


def mean_impute(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """A2: replace nulls by the column mean of non-null values (whole table).

    The means come from one aggregate (one row) cross-joined back by broadcast:
    the big table is scanned twice but never shuffled.
    """
    means = df.agg(*[F.avg(q(c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    joined = df.crossJoin(F.broadcast(means))
    for i, c in enumerate(cols):
        joined = joined.withColumn(c + suffix, F.coalesce(q(c), F.col(f"_m{i}")))
    return joined.drop(*[f"_m{i}" for i in range(len(cols))])
