"""The review queue and the stored facts: candidates and their decisions, labels that map to concepts, and writes that clean up after themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.functions import labels

#: What a fact is told by.
IDENTITY = ["company_id", "concept", "period_id", "basis", "continuity", "document_id"]
#: reviewers' ranks of an import's confidence.
CONFIDENCE = {"high": 3, "medium": 2, "low": 1, "none": 0}
TOKEN = r"[a-z]{3,}"


def lookup(rows: DataFrame, synonyms: DataFrame) -> DataFrame:
    """rows (label, statement, company_id) with concept: a company's own synonym before one for all (null company_id)."""
    keyed = rows.withColumn("_key", labels.normalize_label(F.col("label")))
    one = synonyms.groupBy("normalized", "statement", "company_id").agg(F.min("concept").alias("concept"))
    own = one.where("company_id is not null").select(F.col("normalized").alias("_key"), "statement", "company_id", F.col("concept").alias("_own"))
    every = one.where("company_id is null").select(F.col("normalized").alias("_key"), "statement", F.col("concept").alias("_every"))
    found = keyed.join(own, ["_key", "statement", "company_id"], "left").join(every, ["_key", "statement"], "left")
    return found.select(*rows.columns, F.coalesce("_own", "_every").alias("concept"))


def reviewable(label: Column) -> Column:
    """Whether a label that no synonym knows is worth a reviewer's time: it has letters, is no sentence, date or page mark."""
    words = F.size(F.filter(F.split(F.trim(label), r"\s+"), lambda w: w != ""))
    letters = F.length(F.regexp_replace(label, r"[^A-Za-z]", ""))
    return F.coalesce((letters >= 3) & words.between(1, 14) & ~F.lower(label).rlike(r"^(?:page|note|as at|for the|\d)|continued$|\.$"), F.lit(False))


def severity(size: Column, companies: Column) -> Column:
    """20, up to 50 for the size of the figure and up to 30 for how many companies print the label."""
    magnitude = F.least(F.lit(50), F.greatest(F.lit(0), (F.log10(F.abs(size) + F.lit(1.0)) * 5).cast("int")))
    return F.lit(20) + magnitude + F.least(F.lit(30), 3 * companies).cast("int")


def candidates(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Unmapped labels to decide: rows (document_id, company_id, statement, label, value, concept) without a concept, one per document,
    statement and normalised label, without those in decided (document_id, statement, normalized); with severity, largest first by rank."""
    open_rows = rows.where(F.col("concept").isNull() & reviewable(F.col("label"))).withColumn("normalized", labels.normalize_label(F.col("label"))).where("normalized <> ''")
    seen = open_rows.groupBy("statement", "normalized").agg(F.count_distinct("company_id").alias("companies"))
    each = open_rows.groupBy("document_id", "statement", "normalized").agg(F.min("label").alias("label"), F.max(F.abs("value")).alias("size"))
    fresh = each.join(decided.select("document_id", "statement", "normalized"), ["document_id", "statement", "normalized"], "left_anti")
    out = fresh.join(seen, ["statement", "normalized"]).withColumn("severity", severity(F.coalesce("size", F.lit(0.0)), F.col("companies")))
    return out.select("document_id", "statement", "normalized", "label", "size", "companies", "severity")


def resolve(items: DataFrame, decisions: DataFrame, concepts: DataFrame, synonyms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply decisions (item_id, action map | ignore | reject, concept, for_company) to items (item_id, statement, normalized, company_id).

    Returns items with resolution and error, and the synonyms with those that maps add; a concept of another statement is an error.
    The newest synonym of a label, statement and company takes the place of an older one.
    """
    rows = items.join(decisions, "item_id", "left").join(concepts.select("concept", F.col("statement").alias("of_statement")), "concept", "left")
    wrong = (F.col("action") == "map") & ~F.coalesce(F.col("of_statement") == F.col("statement"), F.lit(False))
    rows = rows.withColumns({"error": F.when(wrong, "concept is not of this statement"), "resolution": F.when(~F.coalesce(wrong, F.lit(False)), F.col("action"))})
    added = rows.where("resolution = 'map'").select("normalized", "statement", F.when(F.col("for_company"), F.col("company_id")).alias("company_id"), "concept")
    both = synonyms.select("normalized", "statement", "company_id", "concept", F.lit(0).alias("age")).unionByName(added.withColumn("age", F.lit(1)))
    kept = both.groupBy("normalized", "statement", "company_id").agg(F.max_by("concept", F.struct("age", "concept")).alias("concept"))
    return rows.select(*items.columns, "resolution", "error"), kept


def suggest(unknown: DataFrame, known: DataFrame, top: int = 3) -> DataFrame:
    """label, concept, jaccard, place: for each label the concepts (concept, label) whose words overlap most, ties by name.

    known is a vocabulary, whose size doesn't grow with the labels, so a label meets a bounded number of concepts.
    """
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(f"({TOKEN})"), F.lit(1)))
    left = unknown.select("label").distinct().withColumn("words", words(F.col("label")))
    right = known.select("concept", words(F.col("label")).alias("concept_words"))
    by_word = left.select("label", F.size("words").alias("n"), F.explode("words").alias("word"))
    to = right.select("concept", F.xxhash64("concept_words").alias("entry"), F.size("concept_words").alias("m"), F.explode("concept_words").alias("word"))
    shared = by_word.join(to, "word").groupBy("label", "concept", "entry", "n", "m").agg(F.count("*").alias("both"))
    best = shared.groupBy("label", "concept").agg(F.max(F.col("both") / (F.col("n") + F.col("m") - F.col("both"))).alias("jaccard"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("jaccard"), "concept"))
    return best.withColumn("place", place).where(F.col("place") <= top)


def upsert_facts(stored: DataFrame, written: DataFrame, documents: DataFrame) -> DataFrame:
    """The facts after documents (document_id) were read again as written: theirs are replaced, what isn't written again goes, all else stays.

    Of facts of one identity the one written last (highest fact_id) stays; review decisions on equal values are kept.
    """
    fresh = written.join(documents.select("document_id").distinct(), "document_id", "left_semi")
    fresh = fresh.groupBy(*IDENTITY).agg(F.max_by(F.struct("fact_id", "value", "confidence"), "fact_id").alias("f")).select(*IDENTITY, "f.*")
    old = stored.select(*(F.col(c).alias(f"_{c}") for c in IDENTITY), F.col("value").alias("_value"), F.col("review_status").alias("_status"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in IDENTITY]
    status = F.when(F.col("_value") == F.col("value"), F.col("_status"))
    merged = fresh.join(old, same, "left").select(*IDENTITY, "fact_id", "value", "confidence", F.coalesce(status, F.lit("PENDING")).alias("review_status"))
    kept = stored.join(documents.select("document_id").distinct(), "document_id", "left_anti").select(*merged.columns)
    return kept.unionByName(merged)


def merge_by_confidence(stored: DataFrame, found: DataFrame, least: str = "medium") -> DataFrame:
    """company addresses (stock_code, url) after an import (stock_code, url, confidence): the surest of those sure enough overwrites or adds."""
    rank = F.lit(0)
    for name, value in CONFIDENCE.items():
        rank = F.when(F.lower("confidence") == name, value).otherwise(rank)
    sure = found.withColumn("rank", rank).where(F.col("rank") >= CONFIDENCE[least]).where("stock_code is not null and url is not null")
    best = sure.groupBy("stock_code").agg(F.max_by("url", F.struct("rank", "url")).alias("new_url"))
    return stored.join(best, "stock_code", "full").select("stock_code", F.coalesce("new_url", "url").alias("url"))


def reconcile_year_end(statements: DataFrame, days: int = 730) -> DataFrame:
    """company_id, month, votes: the month in which annual statements (company_id, period_end) of the last days end, if two or more and most say so."""
    latest = F.max("period_end").over(Window.partitionBy("company_id"))
    recent = statements.withColumn("latest", latest).where(F.date_diff("latest", "period_end") <= days)
    votes = recent.groupBy("company_id", F.month("period_end").alias("month")).agg(F.count("*").alias("votes"))
    return votes.withColumn("all", F.sum("votes").over(Window.partitionBy("company_id"))).where("votes >= 2 and 2 * votes > all").drop("all")
