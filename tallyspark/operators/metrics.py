"""Classification metrics and losses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("accuracy", "precision", "recall", "f1")


def _safe_ratio(num: Column, den: Column) -> Column:
    """num / den with 0 for a zero denominator (library default)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confusion_exprs(label: str, pred: str) -> list[Column]:
    y, p = F.col(label), F.col(pred)
    return [F.count_if((y == 1) & (p == 1)).alias("tp"),
            F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 0) & (p == 0)).alias("tn"),
            F.count_if((y == 1) & (p == 0)).alias("fn")]


def with_rates(counts: DataFrame) -> DataFrame:
    """accuracy, precision, recall, f1 from tp/fp/tn/fn columns; positive class 1."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return (counts
            .withColumn("accuracy", _safe_ratio(tp + tn, tp + fp + tn + fn))
            .withColumn("precision", _safe_ratio(tp, tp + fp))
            .withColumn("recall", _safe_ratio(tp, tp + fn))
            .withColumn("f1", _safe_ratio(2 * tp, 2 * tp + fp + fn)))


def binary_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts and rates per group, in one aggregate pass."""
    counts = df.groupBy(*by).agg(*confusion_exprs(label, pred)) if by else df.agg(*confusion_exprs(label, pred))
    return with_rates(counts)


def mean_fold_metrics(fold_metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean of per-fold rates (not pooled counts)."""
    aggs = [F.avg(m).alias(f"mean_{m}") for m in METRICS] + [F.count(F.lit(1)).alias("n_folds")]
    return fold_metrics.groupBy(*by).agg(*aggs) if by else fold_metrics.agg(*aggs)


def log_loss(df: DataFrame, label: str, prob: str, by: Sequence[str] = (), eps: float = 1e-15) -> DataFrame:
    """Mean binary cross-entropy with probabilities clipped to [eps, 1-eps]."""
    p = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    term = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    aggs = [F.avg(term).alias("logloss"), F.count(F.lit(1)).alias("n")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def objective_loss(metric: str) -> Column:
    """Search loss = 1 - chosen metric; 'f1_score' is an alias of 'f1'."""
    name = {"f1_score": "f1"}.get(metric, metric)
    if name not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS} or 'f1_score'")
    return F.lit(1.0) - F.col(name)
