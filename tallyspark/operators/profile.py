"""Exploratory statistics (A3, A6-A15): one aggregate pass per profile.

Plan shapes: all columns are profiled in one wide ``agg``, never one job per
column; per-group scalars (bounds, fences, bandwidths) are small tables that
are written once and joined back, null-safe, as their size in bytes allows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.correlation import correlations
from tallyspark.operators.prep import q
from tallyspark.operators.joins import join_same
from tallyspark.operators.quantiles import quantiles
from tallyspark.session import materialize

QUARTILES = (0.25, 0.5, 0.75)
BINS_PER_BANDWIDTH = 64


def summary_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A3: count, mean, sample std, min, 25/50/75 % (linear), max per column."""
    by, keys = list(by), [*by, "column_name"]
    aggs = []
    for i, c in enumerate(cols):
        x = _number(c)
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")).alias(f"_s{i}"))
    moments = df.groupBy(*[q(b) for b in by]).agg(*aggs).select(*by, F.inline(F.array(*[F.col(f"_s{i}") for i in range(len(cols))])))
    qs = (quantiles(df, cols, QUARTILES, by)
          .groupBy(*keys)
          .agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
                 for p, name in zip(QUARTILES, ("p25", "p50", "p75"))]))
    return join_same(moments, qs, keys, "left")


def _number(c: str):
    """The column as DOUBLE, NaN as null."""
    x = q(c).cast("double")
    return F.when(~F.isnan(x), x)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and class share."""
    counts = df.groupBy(q(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .withColumn("share", F.col("n") / F.col("_total")).drop("_total"))


def _bin_expr(x, lo, hi, n_bins: int):
    """1-based equal-width bin over [lo, hi]; the max lands in the last bin."""
    width = hi - lo
    raw = F.floor((x - lo) / F.when(width > 0, width) * n_bins) + 1
    return F.when(width > 0, F.least(raw, F.lit(n_bins))).otherwise(F.lit(1)).cast("int")


def histogram(df: DataFrame, col: str, n_bins: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Counts in ``n_bins`` equal-width bins over the overall [min, max]
    (edges shared by all classes), empty bins included."""
    by = list(by)
    x = q(col).cast("double")
    vals = df.select(*[q(b) for b in by], x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    bounds = F.broadcast(vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    binned = vals.crossJoin(bounds).withColumn("bin", _bin_expr(F.col("x"), F.col("lo"), F.col("hi"), n_bins))
    counts = materialize(binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count")), "bins")
    grid = bounds.select("lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(n_bins))).alias("bin"))
    if by:
        grid = counts.select(*by).distinct().crossJoin(F.broadcast(grid))   # n_bins rows
    width = (F.col("hi") - F.col("lo")) / n_bins
    grid = (grid.withColumn("lower", F.col("lo") + (F.col("bin") - 1) * width)
                .withColumn("upper", F.col("lo") + F.col("bin") * width)
                .drop("lo", "hi"))
    out = join_same(grid, counts, [*by, "bin"], "left")
    return out.withColumn("count", F.coalesce(F.col("count"), F.lit(0).cast("bigint")))


def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), whisker: float = 1.5) -> DataFrame:
    """Quartiles, fences, whiskers (extreme points inside the fences)
    and outlier counts per group."""
    by = list(by)
    qs = materialize(_fences(df, col, by, whisker), "fences")
    vals = df.select(*[q(b) for b in by], _number(col).alias("x")).filter(F.col("x").isNotNull())
    inside = F.col("x").between(F.col("lo_fence"), F.col("hi_fence"))
    agg = join_same(vals, qs, by).groupBy(*by).agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    return join_same(qs, agg, by)


def _fences(df: DataFrame, col: str, by: Sequence[str], whisker: float) -> DataFrame:
    """(by..., q1, median, q3, iqr, lo_fence, hi_fence)."""
    qs = (quantiles(df, [col], QUARTILES, by)
          .groupBy(*by).agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
                              for p, n in zip(QUARTILES, ("q1", "median", "q3"))]))
    return (qs.withColumn("iqr", F.when(F.col("q3") == F.col("q1"), 0.0).otherwise(F.col("q3") - F.col("q1")))
            .withColumn("lo_fence", F.col("q1") - whisker * F.col("iqr"))
            .withColumn("hi_fence", F.col("q3") + whisker * F.col("iqr")))


def box_outliers(df: DataFrame, col: str, by: Sequence[str] = (), keep: Sequence[str] = (),
                 whisker: float = 1.5) -> DataFrame:
    """The outlier rows themselves (outside the 1.5 IQR fences)."""
    by = list(by)
    fences = materialize(_fences(df, col, by, whisker).select(*by, "lo_fence", "hi_fence"), "fences")
    x = q(col).cast("double")
    return (join_same(df, fences, by).filter((x < F.col("lo_fence")) | (x > F.col("hi_fence")))
            .select(*[q(c) for c in list(keep) + by], x.alias(col)))


def violin_density(df: DataFrame, col: str, by: Sequence[str] = (), n_points: int = 50) -> DataFrame:
    """Gaussian kernel density on ``n_points`` grid points over each
    group's [min, max], bandwidth 1.06 * std * n^(-1/5).

    Rows are shared linearly between the two nearest of bins that are
    ``BINS_PER_BANDWIDTH`` to a bandwidth; kernels are summed over bins and points
    only. That moves a density by 1 / (8 * BINS_PER_BANDWIDTH^2) = 3.1e-5 of the
    kernel's height, 1 / (bandwidth * sqrt(2 pi)), at most. Only bins that hold
    rows exist, so far outliers cost nothing.
    """
    by = list(by)
    vals = df.select(*[q(b) for b in by], _number(col).alias("x")).filter(F.col("x").isNotNull())
    stats = vals.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                                  F.min("x").alias("lo"), F.max("x").alias("hi"))
    bw = F.lit(1.06) * F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    # a zero or undefined spread gets a small positive bandwidth
    stats = materialize(stats.withColumn("h", F.when(F.coalesce(bw, F.lit(0.0)) > 0, bw).otherwise(F.lit(1e-3))).drop("sd"), "spread")
    at = (F.col("x") - F.col("lo")) / (F.col("h") / BINS_PER_BANDWIDTH)
    bins = (join_same(vals, stats.select(*by, "lo", "h"), by).select(*by, F.floor(at).alias("bin"), (at - F.floor(at)).alias("part"))
            .groupBy(*by, "bin").agg(F.sum(1 - F.col("part")).alias("here"), F.sum("part").alias("next")))

    def kernel(bin_):
        z = (F.col("grid_x") - (F.col("lo") + bin_ * (F.col("h") / BINS_PER_BANDWIDTH))) / F.col("h")
        return F.exp(F.lit(-0.5) * z * z)

    x = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point") / (n_points - 1)
    points = (join_same(bins, stats, by).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(n_points - 1)))).withColumn("grid_x", x))
    weight = F.col("here") * kernel(F.col("bin")) + F.col("next") * kernel(F.col("bin") + 1)
    norm = F.first("n") * F.first("h") * F.lit(math.sqrt(2 * math.pi))
    return points.groupBy(*by, "point").agg(F.first("grid_x").alias("grid_x"), (F.sum(weight) / norm).alias("density"))


def marginal(df: DataFrame, x: str, y: str, kind: str = "histogram", **kw) -> DataFrame:
    """Marginal distribution data of the x and y columns of a scatter."""
    fns = {"histogram": histogram, "box": box_stats, "violin": violin_density}
    if kind not in fns:
        raise ValueError(f"kind must be one of {sorted(fns)}")
    parts = [fns[kind](df, c, **kw).withColumn("axis", F.lit(a)) for a, c in (("x", x), ("y", y))]
    return parts[0].unionByName(parts[1])


def _require_numeric(df: DataFrame, *cols: str) -> None:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    bad = [c for c in cols if not isinstance(kinds.get(c), T.NumericType)]
    if bad:
        raise ValueError(f"Both columns must be numeric: {bad}")


def pearson(df: DataFrame, c1: str, c2: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson r; non-numeric columns are refused."""
    _require_numeric(df, c1, c2)
    e = F.corr(q(c1).cast("double"), q(c2).cast("double")).alias("r")
    return df.groupBy(*by).agg(e) if by else df.agg(e)


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long-form (f1, f2, r), pairwise-complete, by blocked cross-products of the
    upper triangle, mirrored, with a unit diagonal."""
    _require_numeric(df, *cols)
    return correlations(df, cols)


def ols_trend(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line y = intercept + slope * x per group (or overall)."""
    xs, ys = q(x).cast("double"), q(y).cast("double")
    aggs = [F.regr_slope(ys, xs).alias("slope"), F.regr_intercept(ys, xs).alias("intercept"),
            F.regr_r2(ys, xs).alias("r2"), F.regr_count(ys, xs).alias("n")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
