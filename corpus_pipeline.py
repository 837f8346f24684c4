"""Corpus pipeline over ``documents``: five stages, each one of the operators of ``tallyspark.llm``.

Every stage takes the table that its predecessor wrote, applies its operator to
all rows and whole texts, and returns the rows that stay with the columns of
documents; the last one returns the encoded corpus. Each stage's result is
written to the folder that the cluster shares and read again, so a lost executor
costs no more than the stage that runs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm.bpe import bpe_digests
from tallyspark.llm.common import documents, stored
from tallyspark.llm.decontaminate import drop_contaminated
from tallyspark.llm.exact_dedup import drop_copies
from tallyspark.llm.langid import drop_undetermined
from tallyspark.llm.near_dedup import drop_near_copies
from tallyspark.sources.tables import table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, or whose language the model can't tell, go."""
    return drop_undetermined(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8 or more)."""
    return drop_near_copies(docs, words=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document that is left."""
    return bpe_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language ID", language), ("exact dedup", exact), ("near dedup", near), ("decontamination", decontaminated), ("BPE", encoded)]

#: No SQL expresses the trained classifier or the tokenizer; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "_"))
    return docs
