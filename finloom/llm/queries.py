"""The registered queries of this subpackage, thin over the operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from finloom.llm import bpe, exact_dedup, fim, html_extract, licenses, merkle, mixing, near_dup, quality_classifier, quality_rules, suffix_dedup, token_counts, warc
from finloom.llm.common import new_folder, settle, table

#: Tokenizer versions and their rank files.
TOKENIZERS = {"byte_bpe_50k": "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after all documents are inserted, some revised and some deleted, with batches out of order and sent twice."""
    files = {name: public_tokenizers.path(f) for name, f in TOKENIZERS.items()}
    rollup = token_counts.TokenRollup(spark, new_folder(spark, "token-rollup"))
    return token_counts.history(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), rollup, files, public_tokenizers.PATTERN)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = licenses.known_digests(spark)
    return licenses.scan(table(spark, sf_dir, "documents"), known, len(licenses.KNOWN))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.verdicts(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.captures(warc.assemble(warc.read_archives(spark, path)))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.round_trip(docs, path, public_tokenizers.PATTERN))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~quality_classifier.held_out())
    model = quality_classifier.train(docs, labels)
    scored = quality_classifier.score(docs, model)
    return scored.select("doc_id", quality_classifier.held_out().alias("held_out"), "score", (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(table(spark, sf_dir, "documents")))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.deduplicate(table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    own = [op1_token_counts, op2_license_scan, op3_exact_dedup, op4_quality_rules, op5_warc, op6_mixing, op7_byte_bpe, op8_html_extraction, op9_quality_classifier, op10_near_dup]
    new = [op11_merkle_manifest, op12_fill_in_middle, op13_suffix_dedup]
    return {f.__name__: f for f in [*own, *new, pipeline]}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_license_scan": licenses.oracle_sql(),
        "op3_exact_dedup": exact_dedup.ORACLE_SQL,
        "op5_warc": warc.ORACLE_SQL,
        "op6_mixing": mixing.oracle_sql(),
        "op8_html_extraction": html_extract.ORACLE_SQL,
        "op11_merkle_manifest": merkle.oracle_sql(),
        "op12_fill_in_middle": fim.ORACLE_SQL,
        "op13_suffix_dedup": suffix_dedup.ORACLE_SQL,
    }


__all__ = ["oracle_sql", "queries", "settle"]
