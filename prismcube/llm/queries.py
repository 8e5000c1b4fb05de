"""The registered query of each corpus operator: the whole table, production parameters, contract columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from prismcube.llm import byte_bpe, decontaminate, lexical, negatives, parity_join, pii, prefix_bpe, quality, secrets, suffix_dedup, url_filter, warc, word_bpe
from prismcube.llm.common import scratch, table

ORACLES: dict[str, str] = {"op10_warc": warc.ORACLE, "op12_lexical_search": lexical.ORACLE, "op13_hard_negatives": negatives.ORACLE}


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.found_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with one ledger: documents in two languages come first; then all are reported, and only blobs that are new are scanned."""
    docs, ledger = table(spark, sf_dir, "documents"), scratch(spark, "ledger")
    secrets.remember(docs.filter("lang IN ('de', 'en')"), ledger)
    return secrets.report(docs, ledger=ledger)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.joined(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filtered(table(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_pii, op3_byte_bpe, op4_suffix_dedup, op5_secrets, op6_jaccard_join, op7_quality, op8_url_filter, op9_token_counts, op10_warc, op11_bpe, op12_lexical_search, op13_hard_negatives)}
