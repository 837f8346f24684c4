"""Exact quantiles (linear interpolation) at any size.

``percentile`` keeps every distinct value of a group in one aggregation
buffer; here the value at a rank is found digit by digit. Each double has an
order-preserving integer (:func:`with_order_key`). A pass counts rows by the
integer's leading bits inside the buckets that hold a wanted rank -- a map-side
combined aggregate -- and a running sum over the counts locates the next
bucket. Three passes read all 64 bits, whatever the data: the last bucket is a
single value. No row is sorted or collected, a hot value is one count.
A few quantiles of each group are found in two scans, with a sketch that brackets them (:func:`bracketed_values`).

Infinities are values like others, NaN counts as null, and a null group is a
group like others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import join_same
from tallyspark.operators.prep import q
from tallyspark.session import materialize

# Low bits that each pass leaves out: 22, 21 and 21 bits are read.
PASSES = (42, 21, 0)
# Values that a sketch gives, its error as a share of the rows (one part in so many), rows that brackets may hold.
GRID, ACCURACY, MOST_INSIDE = 200, 10_000, 5_000_000


def with_order_key(df: DataFrame, x: str, out: str) -> DataFrame:
    """Adds a BIGINT that orders like the (non-null) DOUBLE ``x``: exponent and fraction bits, negated below zero.

    One projection for each step, so that no step is computed twice.
    """
    tiny, inf = 2.0 ** -1022, float("inf")
    own = [c for c in df.columns]
    a, e, f = F.col("_a"), F.col("_e"), F.col("_f")
    rows = df.select(*own, F.abs(F.col(x)).alias("_a"))
    rows = rows.select(*own, "_a", F.floor(F.log2(F.when((a >= tiny) & (a < inf), a).otherwise(1.0))).alias("_e"))
    rows = rows.select(*own, "_a", "_e", (a * F.pow(F.lit(2.0), -e)).alias("_f"))
    # log2 may round across a power of two; the fraction lies in [1, 2)
    bits = (F.when(f < 1, (e + 1022) * (1 << 52) + ((f * 2 - 1) * float(1 << 52)).cast("bigint"))
             .when(f >= 2, (e + 1024) * (1 << 52) + ((f / 2 - 1) * float(1 << 52)).cast("bigint"))
             .otherwise((e + 1023) * (1 << 52) + ((f - 1) * float(1 << 52)).cast("bigint")))
    size = (F.when(a == inf, F.lit(2047 << 52)).when(a < tiny, (a * (2.0 ** 1000) * (2.0 ** 74)).cast("bigint")).otherwise(bits))
    rows = rows.select(*own, size.cast("bigint").alias("_a"))
    return rows.select(*own, F.when(F.col(x) < 0, -a).otherwise(a).alias(out))


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                name: str = "column_name") -> DataFrame:
    """(by..., column_name, x): numeric columns unpivoted, nulls and NaN dropped."""
    arr = F.array(*[F.struct(F.lit(c).alias(name), q(c).cast("double").alias("x")) for c in cols])
    out = df.select(*[q(b) for b in by], F.inline(arr))
    return out.filter(F.col("x").isNotNull() & ~F.isnan("x"))


def kth_values(long: DataFrame, keys: Sequence[str], targets) -> DataFrame:
    """Value at each wanted 1-based rank.

    ``long``: (keys..., x); ``targets`` receives (keys..., _n) and returns
    (keys..., _tid, _rank, ...). Returns the targets with ``_value``.
    """
    keys = list(keys)
    rows = with_order_key(long.select(*keys, "x"), "x", "_key")
    wanted, prefix, shift = None, [], 64
    for out in PASSES:
        inside = rows
        if wanted is not None:
            inside = join_same(rows.withColumn("_p", F.shiftright("_key", shift)), wanted.select(*keys, "_p").distinct(),
                               [*keys, "_p"], "left_semi")
        counts = materialize(inside.withColumn("_b", F.shiftright("_key", out)).groupBy(*keys, *prefix, "_b")
                             .agg(F.count(F.lit(1)).alias("_c"), F.min("x").alias("_value")), "value-counts")
        if wanted is None:
            wanted = targets(counts.groupBy(*keys).agg(F.sum("_c").alias("_n"))).withColumn("_before", F.lit(0).cast("bigint"))
        w = Window.partitionBy(*keys, *prefix).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        ends = counts.withColumn("_end", F.sum("_c").over(w))
        local = F.col("_rank") - F.col("_before")
        wanted = (join_same(wanted, ends, [*keys, *prefix])
                  .where((local > F.col("_end") - F.col("_c")) & (local <= F.col("_end")))
                  .withColumn("_before", F.col("_before") + F.col("_end") - F.col("_c"))
                  .withColumn("_p", F.col("_b")).drop("_b", "_c", "_end"))
        # Written, so that the planner knows how small it is.
        wanted = materialize(wanted.drop("_value") if out else wanted, "ranks")
        prefix, shift = ["_p"], out
    return wanted.drop("_p", "_before")


def bracketed_values(long: DataFrame, keys: Sequence[str], targets) -> DataFrame:
    """As :func:`kth_values`, for a few ranks of each group, in two scans.

    The first scan makes one mergeable sketch of each group. Its error is bounded, so two of its ``GRID`` values
    enclose the value at a rank for certain; the second scan counts the rows under each bracket and the equal values
    inside. Groups whose brackets hold more than ``MOST_INSIDE`` rows go digit by digit.
    """
    keys = list(keys)
    rows = long.select(*keys, "x")
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    sketch = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("x", steps, ACCURACY).alias("_grid")), "sketches")
    largest = sketch.agg(F.max("_n")).first()[0]
    if largest is not None and largest * (1 / GRID + 8 / ACCURACY) > MOST_INSIDE:
        return kth_values(long, keys, targets)
    n, rank, slack = F.col("_all"), F.col("_rank"), 4 / ACCURACY
    low, high = F.floor(((rank - 1) / n - slack) * GRID).cast("int"), F.ceil((rank / n + slack) * GRID).cast("int")
    wanted = join_same(targets(sketch.select(*keys, "_n")), sketch.select(*keys, "_grid", F.col("_n").alias("_all")), keys)
    wanted = wanted.withColumn("_low", F.when(low >= 0, F.get("_grid", low)).otherwise(F.lit(float("-inf")))).withColumn(
        "_high", F.when(high <= GRID, F.get("_grid", high)).otherwise(F.lit(float("inf")))).drop("_grid", "_all")
    brackets = wanted.groupBy(*keys).agg(F.collect_set(F.struct("_low", "_high")).alias("_brackets"))
    near = join_same(rows, brackets, keys).select(*keys, "x", F.inline("_brackets")).where("x <= _high")
    counts = materialize(near.groupBy(*keys, "_low", "_high", F.when(F.col("x") >= F.col("_low"), F.col("x")).alias("_value"))
                         .agg(F.count(F.lit(1)).alias("_c")), "value-counts")
    ordered = Window.partitionBy(*keys, "_low", "_high").orderBy(F.col("_value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.withColumn("_end", F.sum("_c").over(ordered))
    found = join_same(wanted, ends, [*keys, "_low", "_high"]).where((rank > F.col("_end") - F.col("_c")) & (rank <= F.col("_end")))
    return found.drop("_low", "_high", "_c", "_end")


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              by: Sequence[str] = ()) -> DataFrame:
    """(by..., column_name, p, value): exact quantiles with linear interpolation
    between closest ranks (position p * (n - 1)), per group and column."""
    keys = list(by) + ["column_name"]
    ps = F.array(*[F.lit(float(p)) for p in probs])

    def targets(n: DataFrame) -> DataFrame:
        pos = n.select(*keys, "_n", F.explode(ps).alias("p")).withColumn("_pos", F.col("p") * (F.col("_n") - 1))
        first = F.floor("_pos") + 1
        ranks = F.array(first, F.least(first + 1, F.col("_n")))
        return pos.select(*keys, "p", (F.col("_pos") - F.floor("_pos")).alias("_frac"), F.posexplode(ranks).alias("_tid", "_rank"))

    vals = bracketed_values(long_values(df, cols, by), keys, targets)
    both = vals.groupBy(*keys, "p", "_frac").agg(F.max(F.when(F.col("_tid") == 0, F.col("_value"))).alias("_v0"),
                                                 F.max(F.when(F.col("_tid") == 1, F.col("_value"))).alias("_v1"))
    v0, v1, f = F.col("_v0"), F.col("_v1"), F.col("_frac")
    value = F.when((f == 0) | (v0 == v1), v0).otherwise(v0 + (v1 - v0) * f)
    return both.select(*keys, "p", value.alias("value"))
