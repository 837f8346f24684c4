"""Exact dedup (operator 10, native): two passes over fixed-size digests with a Bloom filter.

Pass 1 reduces every whole text to a SHA-256 digest (white-space runs become one
space) and counts the Bloom slots of all digests; slots hit more than once form
the filter of *possibly repeated* digests. Pass 2 probes the filter: rows it
rules out are unique and go straight to the result, only the others shuffle and
are grouped by digest. The filter is blocked (all bits of a digest lie in one
4 KB block, found by one broadcast join) and never larger than ``max_filter_mb``
whatever the input; a fuller filter sends more unique rows through the shuffle
but can't change the result, since the digest decides.

Defined cases: null text counts as empty; of equal texts the row with the
smallest doc_id stays (null ids come last); rows that repeat both text and
doc_id all report that doc_id as ``keep_id``, and :func:`drop_copies` keeps one
of them; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import fresh, stored

BLOCK_BITS = 32768   # of one bitmap of Spark's bitmap functions
BITS_PER_ROW = 16
PROBES = 3
SALTS = 64


def text_key(text: Column) -> Column:
    """SHA-256 of the text with each run of white space as one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("long")


def bits_of(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BLOCK_BITS)).cast("int") for k in range(PROBES)]


def repeat_filter(keys: DataFrame, column: str, max_filter_mb: int = 64, least: int = 2) -> tuple[DataFrame, int]:
    """(block, bitmap) of the slots that at least ``least`` rows hit; the number of blocks.

    At most ``max_filter_mb`` whatever the input, so it may be broadcast.
    """
    n = keys.count()
    blocks = min(max(1, -(-n * BITS_PER_ROW // BLOCK_BITS)), (max_filter_mb << 20) // (BLOCK_BITS // 8))
    key = F.col(column)
    slots = keys.select(block_of(key, blocks).alias("block"), F.explode(F.array(*bits_of(key))).alias("bit"))
    hit = slots.groupBy("block", "bit").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= least)
    maps = hit.groupBy("block").agg(F.expr("bitmap_construct_agg(bit)").alias("bitmap"))
    return maps, blocks


def possibly_repeated(df: DataFrame, column: str, maps: DataFrame, blocks: int, flag: str) -> DataFrame:
    """Adds ``flag``: whether the filter holds all bits of the row's key."""
    block, bitmap = fresh(df, "__block"), fresh(df, "__bitmap")
    key = F.col(column)

    def set_at(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, bit % 8) == 1

    held = F.lit(True)
    for bit in bits_of(key):
        held = held & set_at(bit)
    small = F.broadcast(maps.select(F.col("block").alias(block), F.col("bitmap").alias(bitmap)))
    return (df.withColumn(block, block_of(key, blocks)).join(small, block, "left")
            .withColumn(flag, F.col(bitmap).isNotNull() & F.coalesce(held, F.lit(False)))
            .drop(block, bitmap))


def exact_dedup(docs: DataFrame, max_filter_mb: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    digests = stored(docs.select("doc_id", text_key(F.col("text")).alias("text_sha256")), "digests")
    maps, blocks = repeat_filter(digests, "text_sha256", max_filter_mb)
    maps = stored(maps, "repeats")
    rows = possibly_repeated(digests, "text_sha256", maps, blocks, "maybe")
    unique = rows.where("NOT maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    salted = rows.where("maybe").select(
        "doc_id", "text_sha256", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    # A group's totals go back to each of its salts, so a group of any size is split over SALTS tasks.
    parts = salted.groupBy("text_sha256", "salt").agg(F.min("doc_id").alias("lo"), F.count(F.lit(1)).alias("c"))
    totals = (parts.groupBy("text_sha256")
              .agg(F.min("lo").alias("keep_id"), F.sum("c").alias("group_size"), F.collect_list("salt").alias("salts"))
              .select("text_sha256", "keep_id", "group_size", F.explode("salts").alias("salt")))
    grouped = salted.join(totals, ["text_sha256", "salt"]).select("doc_id", "keep_id", "group_size", "text_sha256")
    return unique.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, max_filter_mb: int = 64) -> DataFrame:
    """The input's rows and columns without copies of a kept text (one row of each group stays).

    Rows that the filter rules out aren't shuffled; the others meet the kept
    (doc_id, digest) pairs in a join, and fully repeated rows fall to one.
    """
    key, flag, i, sha = fresh(docs, "__key"), fresh(docs, "__maybe"), fresh(docs, "__keep"), fresh(docs, "__sha")
    cols = docs.columns
    decisions = stored(exact_dedup(docs, max_filter_mb), "decisions")
    keyed = docs.withColumn(key, text_key(F.col("text")))
    maps, blocks = repeat_filter(decisions, "text_sha256", max_filter_mb)
    rows = possibly_repeated(keyed, key, stored(maps, "repeats"), blocks, flag)
    keep = (decisions.where("kept").groupBy("doc_id", "text_sha256").agg(F.max("group_size").alias("group_size"))
            .select(F.col("doc_id").alias(i), F.col("text_sha256").alias(sha)))
    some = rows.where(F.col(flag)).alias("r")
    kept = (some.join(keep, (F.col(f"r.{key}") == F.col(sha)) & F.col("r.doc_id").eqNullSafe(F.col(i)), "left_semi")
            .dropDuplicates(["doc_id", key]))
    return rows.where(~F.col(flag)).select(*cols).unionByName(kept.select(*cols))
