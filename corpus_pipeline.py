"""From raw documents to training tokens: each stage takes what the one before kept, as a table.

Quality rules reject; exact dedup keeps one row per text; near-dedup keeps one document per component (five-word shingles, Jaccard
similarity of 0.8 or more); mixing replicates documents to the sources' target weights; the last stage encodes to token ids.
Nulls, empty texts, repeated rows and empty tables are handled as each operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.llm import bpe, exact_dedup, mixing, near_dup, quality_rules
from finloom.llm.common import settle, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.reject(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.deduplicate(docs, width=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).drop("copy_no", "shuffle_key")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids and a digest of the text decoded from them."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = bpe.round_trip(docs.select("doc_id", "text", "lang", "source"), path, public_tokenizers.PATTERN)
    return rows.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mixed), ("byte-level BPE", encoded)]
#: The first, third and last stages can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
