"""The corpus pipeline: quality rules, near duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and
returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.llm import byte_bpe, decontaminate, parity_join, quality, secrets
from prismcube.llm.common import in_small_batches, saved, table


def good_ones(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the rules reject go."""
    return quality.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group of near duplicates stays, that of the least doc_id."""
    return parity_join.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that hold a benchmark item go."""
    return decontaminate.drop_found(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: secrets are masked in the text; all documents stay."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: doc_id, lang, source, n_tokens and the ids of each text, a null one as empty; repeated rows repeat."""
    coded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_text=False)
    return in_small_batches(coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids"))


STAGES = [("quality", good_ones), ("near duplicates", one_of_each), ("decontamination", uncontaminated), ("secrets", without_secrets), ("tokens", tokens)]
#: The verdicts of expectation-maximisation and the merges of tokens have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
