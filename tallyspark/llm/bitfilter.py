"""Bloom filters of 64-bit hash columns, built by Spark's bitmap functions and probed by numpy in tasks.

A filter never exceeds ``max_mb`` whatever the input. A fuller one passes more
keys than it should, never fewer, so it may only come before an exact step.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32768
BITS_PER_KEY = 16
SHIFTS = (15, 30, 45)


def build(keys: DataFrame, column: str, max_mb: int = 32):
    """Spark broadcast of the bits of a bigint column of well mixed hashes (all rows of ``keys``)."""
    n = keys.count()
    blocks = min(max(1, -(-n * BITS_PER_KEY // BLOCK_BITS)), (max_mb << 20) // (BLOCK_BITS // 8))
    key = F.col(column)
    bits = F.explode(F.array(*[F.shiftrightunsigned(key, s).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for s in SHIFTS]))
    maps = (keys.select(F.pmod(key, F.lit(blocks)).cast("int").alias("block"), bits.alias("bit")).distinct()
            .groupBy("block").agg(F.expr("bitmap_construct_agg(bit)").alias("bitmap")))
    out = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
    for row in maps.toLocalIterator():   # at most max_mb
        out[row["block"]] = np.frombuffer(row["bitmap"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(out)


def probe(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key (uint64 or int64) may be in the filter."""
    signed, plain = keys.view(np.int64), keys.view(np.uint64)
    block = np.mod(signed, len(bits))
    ok = np.ones(len(keys), bool)
    for s in SHIFTS:
        bit = ((plain >> np.uint64(s)) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)
        ok &= (bits[block, bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
    return ok
