"""Joins on equal keys where a null key equals a null key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on the columns ``on``, null-safe; one copy of them stays.

    Without keys both sides are one group, and ``right`` is a single row.
    """
    on = list(on)
    if not on:
        return left.crossJoin(F.broadcast(right)) if how in ("inner", "left") else left
    names = [f"_same_{c}" for c in on]
    other = right.select(*[F.col(c).alias(n) for c, n in zip(on, names)], *[c for c in right.columns if c not in on])
    cond = None
    for c, n in zip(on, names):
        e = F.col(c).eqNullSafe(F.col(n))
        cond = e if cond is None else cond & e
    return left.join(other, cond, how).drop(*names)
