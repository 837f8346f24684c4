"""Exact order statistics without sorting a whole group in one task.

Given rows carrying a 52-bit hash ``h`` and a unique ``key``, and a small table
of wanted 1-based ranks per group, return the row sitting at each rank in the
order ``(h, key)``. Splits (SP1, SP2) and exact-size folds (SP3) only need
these few boundary rows, so no row is ever globally ranked:

1. count rows per (group, hash bucket) -- a map-side combined aggregate;
2. a running sum over that small table locates the bucket of each wanted rank
   and the rank inside it; a bucket of more than ``bucket_rows`` rows is divided
   by the next hash bits in the same way;
3. the rows of the boundary buckets are ranked by a window.

A group holding a third of all rows costs the same as any other: its rows are
spread over all buckets by the hash. Null groups are groups like others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import join_same
from tallyspark.session import materialize

HASH_BITS = 52
BUCKET_BITS = 12
# Rows of a boundary bucket that a window may rank; larger buckets are divided again.
BUCKET_ROWS = 100_000


def select_ranks(df: DataFrame, by: Sequence[str],
                 targets: Callable[[DataFrame], DataFrame],
                 h: str = "_h", key: str = "_k",
                 bucket_bits: int = BUCKET_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows at wanted ranks.

    ``df`` holds ``by`` columns plus ``h`` (BIGINT in [0, 2**52)) and a unique
    ``key``. ``targets`` receives a per-group count table ``(by..., _n)`` and
    returns ``(by..., _tid, _rank)`` with 1-based ranks. The result is
    ``(by..., _tid, _rank, _th, _tk)``: hash and key of the row at each rank.
    """
    by = list(by)
    slim = df.select(*by, F.col(h).alias("_h"), F.col(key).alias("_k"))
    bits = bucket_bits
    b = F.shiftright("_h", HASH_BITS - bits)
    counts = materialize(slim.groupBy(*by, b.alias("_b")).agg(F.count(F.lit(1)).alias("_c")), "bucket-counts")
    wanted = targets(counts.groupBy(*by).agg(F.sum("_c").alias("_n"))).select(*by, "_tid", "_rank")
    hits = _locate(counts, by, wanted.withColumn("_before", F.lit(0).cast("bigint")))
    while bits < HASH_BITS and not hits.where(F.col("_c") > bucket_rows).isEmpty():
        finer = min(HASH_BITS, bits + bucket_bits)
        inside = _inside(slim, by, hits, bits).withColumn("_b", F.shiftright("_h", HASH_BITS - finer))
        counts = materialize(inside.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c")), "bucket-counts")
        # A finer bucket starts after the rows before its parent.
        parent = hits.select(*by, F.col("_b").alias("_p"), "_before").distinct()
        counts = join_same(counts.withColumn("_p", F.shiftright("_b", finer - bits)), parent, [*by, "_p"])
        hits = _locate(counts.drop("_before"), [*by, "_p"], join_same(
            hits.select(*by, "_tid", "_rank", F.col("_b").alias("_p"), "_before"), counts.select(*by, "_p").distinct(), [*by, "_p"])).drop("_p")
        bits = finer
    inside = _inside(slim, by, hits, bits)
    w = Window.partitionBy(*by, "_b").orderBy("_h", "_k")
    ranked = inside.withColumn("_local", F.row_number().over(w).cast("bigint"))
    found = join_same(ranked, hits.withColumn("_local", F.col("_rank") - F.col("_before")).drop("_c"), [*by, "_b", "_local"])
    return found.select(*by, "_tid", "_rank", F.col("_h").alias("_th"), F.col("_k").alias("_tk"))


def _locate(counts: DataFrame, by: list[str], wanted: DataFrame) -> DataFrame:
    """(by..., _tid, _rank, _b, _c, _before): the bucket of each wanted rank, its rows and those before it."""
    w = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.select(*by, "_b", "_c", F.sum("_c").over(w).alias("_end"))
    local = F.col("_rank") - F.col("_before")
    return materialize(
        join_same(wanted, ends, by).where((local > F.col("_end") - F.col("_c")) & (local <= F.col("_end")))
        .select(*by, "_tid", "_rank", "_b", "_c", (F.col("_before") + F.col("_end") - F.col("_c")).alias("_before")), "ranks")


def _inside(slim: DataFrame, by: list[str], hits: DataFrame, bits: int) -> DataFrame:
    """Rows of the boundary buckets."""
    return join_same(slim.withColumn("_b", F.shiftright("_h", HASH_BITS - bits)), hits.select(*by, "_b").distinct(), [*by, "_b"], "left_semi")


def at_or_before(h_col: str, k_col: str, th: str, tk: str):
    """(h, key) <= (th, tk) in lexicographic order."""
    return (F.col(h_col) < F.col(th)) | ((F.col(h_col) == F.col(th)) & (F.col(k_col) <= F.col(tk)))
