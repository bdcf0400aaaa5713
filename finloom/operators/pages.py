"""Words, pages and rows of statements: bands and columns, runs of pages, blocks that belong together, and counts over them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Points by which a word may miss its column, and pages' shares of figures.
BAND_TOLERANCE, NUMERIC_ROWS = 3.0, 8
#: What the head of a page says it is; the first that matches wins.
STATEMENTS = [
    ("EQ", r"changes\s+in\s+equity"),
    ("CF", r"cash\s+flows?"),
    ("BS", r"financial\s+position|balance\s+sheets?"),
    ("IS", r"profit\s+(?:or|and)\s+loss|comprehensive\s+income|income\s+statements?"),
]
EXCLUDED = r"^\s*(?:contents|table\s+of\s+contents|independent\s+auditors|notes\s+to\s+the)"
#: Movements of an equity statement by words of their label; the first that matches wins.
MOVEMENTS = [
    ("eq.dividends", r"\b(?:dividends?|distributions?)\b"),
    ("eq.share_buyback", r"\b(?:buy-?backs?|treasury|repurchased?|shares?\s+(?:bought\s+back|cancelled))\b"),
    ("eq.share_based_payments", r"\b(?:share-based|esos|employee\s+share|share\s+options?)\b"),
    ("eq.issuance_of_shares", r"\b(?:issuance|issue\s+of|issued|placement|rights\s+issue|conversion\s+of\s+warrants)\b"),
    ("eq.changes_in_nci", r"\b(?:non-controlling|minority|subsidiar(?:y|ies))\b"),
    ("eq.transfer_to_reserves", r"\btransfer(?:red)?\b"),
    ("eq.total_comprehensive_income", r"\btotal\s+comprehensive\b"),
    ("eq.other_comprehensive_income", r"\bother\s+comprehensive\b"),
    ("eq.profit_for_year", r"\b(?:profit|loss)\b.*\b(?:year|period)\b"),
]


def _first(text: Column, patterns: Iterable[tuple[str, str]]) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(list(patterns)):
        out = F.when(text.rlike(f"(?i){pattern}"), name).otherwise(out)
    return out


def movement_of(label: Column) -> Column:
    """The equity concept that a movement's label names, or null."""
    return _first(label, MOVEMENTS)


def page_class(text: Column) -> Column:
    """struct(statement, confidence, numeric_rows) of a page by the first third of its lines and its rows of figures."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    head = F.array_join(F.slice(lines, 1, F.greatest(F.lit(1), F.ceil(F.size(lines) * 0.35).cast("int"))), " ")
    numeric = F.size(F.filter(lines, lambda x: x.rlike(r"\d[\d,.]*\)?\s+\(?\d[\d,.]*\)?\s*$")))
    found = F.when(~head.rlike(f"(?i){EXCLUDED}"), _first(head, STATEMENTS))
    return F.struct(found.alias("statement"), F.when(found.isNotNull(), F.when(numeric >= NUMERIC_ROWS, 0.95).otherwise(0.25)).alias("confidence"), numeric.alias("numeric_rows"))


def carried_forward(pages: DataFrame) -> DataFrame:
    """pages (doc, page, statement, numeric_rows) with carried: the statement of the last page that has one, until a page without figures."""
    own = Window.partitionBy("doc").orderBy("page")
    stops = (F.col("statement").isNull() & (F.col("numeric_rows") == 0)).cast("int")
    rows = pages.withColumn("_run", F.sum(stops).over(own))
    return rows.withColumn("carried", F.last("statement", ignorenulls=True).over(Window.partitionBy("doc", "_run").orderBy("page"))).drop("_run")


def words_in_bands(words: DataFrame, bands: DataFrame, tolerance: float = BAND_TOLERANCE) -> DataFrame:
    """words (doc, page, word_id, x1) with the first band (doc, page, band, left_edge, right_edge) that holds their right edge."""
    near = words.join(bands, ["doc", "page"], "left")
    inside = F.col("x1").between(F.col("left_edge") - tolerance, F.col("right_edge") + tolerance)
    return near.groupBy("doc", "page", "word_id").agg(F.min(F.when(inside, F.col("band"))).alias("band"))


def paired_by_order(left: DataFrame, right: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The nth row of left with the nth row of right within keys, by order; what has no partner has nulls."""
    numbered = lambda df: df.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    other = numbered(right).select(*keys, "nth", *(F.col(c).alias(f"right_{c}") for c in right.columns if c not in keys))
    return numbered(left).join(other, [*keys, "nth"], "left")


def most_common(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """keys and the value that occurs most; of equals the one seen first by order."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    return counts.groupBy(*keys).agg(F.max_by(F.struct(value, "n"), F.struct("n", (-F.col("seen")).alias("first"))).alias("b")).select(*keys, "b.*")


def source_ranking(selected: DataFrame, documents: DataFrame) -> DataFrame:
    """company_id, fy, sources: the files that the year's figures come from, most figures first, as one text."""
    counts = selected.join(documents.select("document_id", "file_name"), "document_id").groupBy("company_id", "fy", "file_name").agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("rank"), "file_name", "n")))
    return counts.groupBy("company_id", "fy").agg(F.array_join(F.transform(ordered, lambda x: F.format_string("%s (%d)", x["file_name"], x["n"])), "; ").alias("sources"))


def block_totals(rows: DataFrame, additive: Iterable[str]) -> DataFrame:
    """document_id, block, concept, value: sums of additive concepts; others only where a block has them once."""
    grouped = rows.groupBy("document_id", "block", "concept").agg(F.sum("value").alias("value"), F.count("value").alias("n"))
    return grouped.where((F.col("n") == 1) | F.col("concept").isin(*additive)).drop("n")


def cash_boundaries(facts: DataFrame, fiscal_start: str = "period_start", fiscal_end: str = "period_end") -> DataFrame:
    """facts (concept, period_start, period_end) with instant: opening cash on the first day of the year, closing cash on its last."""
    return facts.withColumn("instant", F.when(F.col("concept") == "cf.cash_beginning", F.col(fiscal_start)).when(F.col("concept") == "cf.cash_end", F.col(fiscal_end)))


def best_pages(scores: DataFrame, top: int = 10) -> DataFrame:
    """scores (doc, statement, page, hits, numeric_share) with score and place: the best pages of each document and statement."""
    score = 10 * F.col("hits") + F.col("numeric_share")
    ranked = scores.withColumn("score", score).withColumn("place", F.row_number().over(Window.partitionBy("doc", "statement").orderBy(F.desc("score"), "page")))
    return ranked.where(F.col("place") <= top)


def best_documents(scored: DataFrame) -> DataFrame:
    """One document per company, statement and period end: the highest score, of equals the most pages, then the least id."""
    keys = ["company_id", "statement", "period_end"]
    best = F.max_by(F.struct("document_id", "score"), F.struct("score", "pages", (-F.col("document_id")).alias("neg")))
    return scored.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def progress(jobs: DataFrame, now: Column) -> DataFrame:
    """jobs (job_id, done, total, started, updated) with elapsed, eta (seconds) and stalled (no word for an hour)."""
    elapsed = F.unix_timestamp(now) - F.unix_timestamp("started")
    left = F.try_divide((F.col("total") - F.col("done")) * elapsed, F.when(F.col("done") > 0, F.col("done")))
    return jobs.withColumns({"elapsed": elapsed, "eta": left, "stalled": (F.col("done") < F.col("total")) & (F.unix_timestamp(now) - F.unix_timestamp("updated") > 3600)})


def stored_objects(documents: DataFrame, listing: DataFrame) -> DataFrame:
    """document_id, status of each document's file (storage_path, sha256) against what a store holds (key, sha256, size): an audit."""
    rows = documents.join(listing.select(F.col("key").alias("storage_path"), F.col("sha256").alias("held"), "size"), "storage_path", "left")
    status = F.when(F.col("storage_path").isNull(), "no_path").when(F.col("held").isNull(), "missing").when(F.col("held") != F.col("sha256"), "mismatch").when(F.col("size") == 0, "empty").otherwise("ok")
    return rows.select("document_id", status.alias("status"))
