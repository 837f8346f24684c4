"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even_int(c) -> Column:
    """M1: round half to even to an integer (0.5 -> 0, 1.5 -> 2)."""
    return F.bround(_c(c), 0).cast("int")


def truncate_int(c) -> Column:
    """M2: truncating cast toward zero (1.9 -> 1)."""
    return _c(c).cast("int")


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z)))


def log_uniform(u, low: float, high: float) -> Column:
    """M4: exp(low + (high - low) * u) for u uniform in [0, 1)."""
    return F.exp(F.lit(float(low)) + F.lit(float(high - low)) * _c(u))


def quniform(u, low: float, high: float, q: float = 1.0) -> Column:
    """M4: uniform in [low, high) quantized to multiples of q (half to even)."""
    raw = F.lit(float(low)) + F.lit(float(high - low)) * _c(u)
    return F.bround(raw / F.lit(float(q)), 0) * F.lit(float(q))


# Outcome messages of the scoring service.
GOOD_MESSAGE = "Good investment"
BAD_MESSAGE = "Bad investment"


def outcome_message(pred) -> Column:
    """1 -> good message, anything else -> bad message."""
    return F.when(_c(pred) == 1, F.lit(GOOD_MESSAGE)).otherwise(F.lit(BAD_MESSAGE))
