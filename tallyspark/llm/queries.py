"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import decontaminate as decontamination
from tallyspark.llm import filter_audit as audit
from tallyspark.llm import line_dedup as lines
from tallyspark.llm import near_dedup as near
from tallyspark.llm import prefix_trie as tries
from tallyspark.llm import suffix_dedup as suffixes
from tallyspark.llm import topk_search as search
from tallyspark.llm.bpe import bpe_digests
from tallyspark.llm.common import documents
from tallyspark.llm.context_mixing import lm_scores
from tallyspark.llm.exact_dedup import exact_dedup
from tallyspark.llm.langid import language_id
from tallyspark.llm.secrets import secret_scan
from tallyspark.llm.wordpiece import wordpiece_counts
from tallyspark.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
VOCABULARY = "byte_bpe_50k.tiktoken"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


@query
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_dedup(documents(spark, sf_dir), words=2, percent=80)


ORACLE["op3_minhash_near_dedup"] = near.ORACLE


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


ORACLE["op5_benchmark_decontamination"] = decontamination.ORACLE


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op6_suffix_dedup"] = suffixes.ORACLE


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece_counts(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(documents(spark, sf_dir))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.line_dedup(documents(spark, sf_dir), least_texts=5)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op9_line_dedup"] = lines.ORACLE


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


ORACLE["op10_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, t.text_sha256
FROM t JOIN g USING (text_sha256)
"""


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.conversation_trie(table(spark, sf_dir, "conversations"))


ORACLE["op11_prefix_trie"] = tries.ORACLE


@query
def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"))


ORACLE["op12_topk_search"] = search.ORACLE


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


ORACLE["op13_filter_audit"] = audit.ORACLE
