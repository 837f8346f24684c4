"""Reproducible splits and folds (SP1-SP3).

Row order is ``(md5-hash of seed || key, key)``. A stratified split puts the
first ``round(n_class * test_frac)`` rows of every class into ``test``; k-fold
gives fold ``i`` the i-th run of rows in that order, the first ``n mod k`` folds
one row larger (the usual k-fold sizes). Both are decided by comparing each
row with a handful of boundary rows found by :mod:`orderstats`: the counting
passes shuffle counts only, and the rows themselves are scanned once and joined
with a table of one row per class. A null label is a class like others.
The same definition is a plain ``row_number()`` query in SQL, which is how it
is checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.hashing import hash52
from tallyspark.operators.joins import join_same
from tallyspark.operators.orderstats import BUCKET_BITS, at_or_before, select_ranks
from tallyspark.session import materialize


def _first_rows(base: DataFrame, label: str, key: str, h: str, frac: float, name: str,
                bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """(label, name_h, name_k): the last row of the first ``round(n * frac)`` rows of each class."""
    if not 0.0 <= frac <= 1.0:
        raise ValueError("the fraction must be within [0, 1]")

    def wanted(group_n: DataFrame) -> DataFrame:
        rank = F.round(F.col("_n") * F.lit(float(frac))).cast("bigint")
        return group_n.select(label, F.lit(0).alias("_tid"), rank.alias("_rank")).filter(F.col("_rank") > 0)

    th = select_ranks(base.select(label, h, key), [label], wanted, h=h, key=key, bucket_bits=bucket_bits)
    return materialize(th.select(label, F.col("_th").alias(f"{name}_h"), F.col("_tk").alias(f"{name}_k")), "thresholds")


def _within(h: str, key: str, name: str):
    return F.col(f"{name}_h").isNotNull() & at_or_before(h, key, f"{name}_h", f"{name}_k")


def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.2,
                     seed: str = "42", split_col: str = "split",
                     bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """SP1: add ``split`` = 'test' | 'train' with exact per-class test sizes."""
    base = df.withColumn("_h", hash52(seed, key))
    th = _first_rows(base, label, key, "_h", test_frac, "_t", bucket_bits)
    return (join_same(base, th, [label], "left")
            .withColumn(split_col, F.when(_within("_h", key, "_t"), F.lit("test")).otherwise(F.lit("train")))
            .drop("_h", "_t_h", "_t_k"))


def train_valid_test(df: DataFrame, label: str, key: str, test_frac: float = 0.2,
                     valid_frac: float = 0.2, seed: str = "42", split_col: str = "split") -> DataFrame:
    """SP1 then SP2 on the train part: ``split`` in test / valid / train.

    Both thresholds are found on (key, label); one scan then assigns all rows.
    """
    slim = df.select(label, key).withColumn("_h", hash52(seed, key))
    first = _first_rows(slim, label, key, "_h", test_frac, "_t")
    rest = (join_same(slim, first, [label], "left").filter(~_within("_h", key, "_t"))
            .select(label, key).withColumn("_h2", hash52(f"{seed}:valid", key)))
    second = _first_rows(rest, label, key, "_h2", valid_frac, "_v")
    base = df.withColumn("_h", hash52(seed, key)).withColumn("_h2", hash52(f"{seed}:valid", key))
    out = join_same(join_same(base, first, [label], "left"), second, [label], "left")
    part = (F.when(_within("_h", key, "_t"), F.lit("test")).when(_within("_h2", key, "_v"), F.lit("valid"))
             .otherwise(F.lit("train")))
    return out.select(*df.columns, part.alias(split_col))


def kfold(df: DataFrame, key: str, k: int = 5, seed: str = "42", fold_col: str = "fold",
          by: list[str] | None = None, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """SP3: shuffled k-fold with exact sizes; ``by`` gives one fold scheme per group."""
    if k < 2:
        raise ValueError("k must be at least 2")
    by = list(by or [])
    base = df.withColumn("_h", hash52(seed, key))
    grp = by or ["_g"]
    if not by:
        base = base.withColumn("_g", F.lit(0))

    def wanted(group_n: DataFrame) -> DataFrame:
        # start rank (1-based) of folds 1..k-1: first n mod k folds hold q + 1 rows
        q = F.floor(F.col("_n") / k)
        m = F.col("_n") % k
        ids = F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("_tid")
        starts = group_n.select(*grp, "_n", ids)
        start = (F.least(F.col("_tid"), F.col("_m")) * (F.col("_q") + 1)
                 + F.greatest(F.col("_tid") - F.col("_m"), F.lit(0)) * F.col("_q") + 1)
        return (starts.withColumn("_q", q).withColumn("_m", m)
                .select(*grp, "_tid", "_n", start.cast("bigint").alias("_rank"))
                .filter(F.col("_rank") <= F.col("_n")))

    th = select_ranks(base.select(*grp, "_h", key), grp, wanted, h="_h", key=key,
                      bucket_bits=bucket_bits)
    bounds = materialize(
        th.groupBy(*grp).agg(F.collect_list(F.struct(F.col("_th").alias("h"),
                                                     F.col("_tk").alias("k"))).alias("_bounds")), "bounds")
    joined = join_same(base, bounds, grp, "left")
    # fold = number of fold starts at or before the row
    passed = F.filter(F.col("_bounds"),
                      lambda b: (b["h"] < F.col("_h")) | ((b["h"] == F.col("_h")) & (b["k"] <= F.col(key))))
    fold = F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(F.size(passed)).cast("int")
    out = joined.withColumn(fold_col, fold).drop("_h", "_bounds")
    return out.drop("_g") if not by else out
