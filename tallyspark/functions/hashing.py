"""Deterministic per-row pseudo-random numbers from md5.

``hash52`` takes the first 13 hex digits (52 bits) of ``md5(salt || ':' || key)``; the
same value is computable in any SQL engine with md5, so splits and draws are
reproducible outside Spark. ``uniform`` maps it to [0, 1) exactly (2**52 is a
power of two, so the division is exact in double precision).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = float(1 << 52)


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash52(salt: str, key) -> Column:
    """BIGINT in [0, 2**52) from md5 of ``salt`` concatenated with the key text."""
    text = F.concat(F.lit(f"{salt}:"), _as_col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def uniform(salt: str, key) -> Column:
    """DOUBLE in [0, 1) derived from ``hash52``."""
    return hash52(salt, key) / F.lit(TWO_POW_52)
