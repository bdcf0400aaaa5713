"""Annual figures from facts: which of several reported values counts, wide rows by year, and neighbours of a year."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Facts below this confidence are no annual figures; derived ones have just this.
MIN_CONFIDENCE = 0.9
#: Days of a full year, at least and at most.
FULL_YEAR, LONG_YEAR = 330, 400


def column_of(concept: str) -> str:
    return concept.replace(".", "_")


def query(facts: DataFrame, company_ids: Iterable | None = None, concept: str | None = None, concepts: Iterable[str] | None = None, not_concept: str | None = None) -> DataFrame:
    """facts filtered by what is given; a concept that ends in a dot stands for all that begin with it."""
    if company_ids is not None:
        facts = facts.where(F.col("company_id").isin(*company_ids))
    if concept is not None:
        facts = facts.where(F.col("concept").startswith(concept) if concept.endswith(".") else F.col("concept") == concept)
    if concepts is not None:
        facts = facts.where(F.col("concept").isin(*concepts))
    return facts if not_concept is None else facts.where(F.col("concept") != not_concept)


def current_facts(facts: DataFrame, documents: DataFrame) -> DataFrame:
    """One fact per company, concept, period, basis and continuity: the last filed, then the latest hint, then the highest document."""
    key = ["company_id", "concept", "period_id", "basis", "continuity"]
    rows = facts.join(documents.select("document_id", "filed", "hint"), "document_id")
    best = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc_nulls_last("filed"), F.desc_nulls_last("hint"), F.desc("document_id")))
    return rows.withColumn("place", best).where("place = 1").drop("place")


def annual_selection(facts: DataFrame, periods: DataFrame, documents: DataFrame, company_ids: Iterable | None = None, concepts: Iterable[str] | None = None) -> DataFrame:
    """company_id, fy, concept, value, period_end, document_id: one value per company, year and concept.

    Of facts that are consolidated, total, sure enough, and of a fiscal year or an instant, the latest period end wins, then the
    last filed document, the latest hint and the highest document. One aggregation, with partial maxima.
    """
    rows = query(facts, company_ids, concepts=concepts).where(f"basis = 'CONSOLIDATED' and continuity = 'TOTAL' and confidence >= {MIN_CONFIDENCE}D")
    years = periods.where("period_type in ('FY', 'INSTANT')").select("period_id", F.col("fiscal_year").alias("fy"), "period_end")
    rows = rows.join(years, "period_id").join(documents.select("document_id", "filed", "hint"), "document_id")
    # Structs compare field by field, with null as the least, as the ranks want it.
    best = F.max_by(F.struct("value", "period_end", "document_id"), F.struct("period_end", "filed", "hint", "document_id"))
    return rows.groupBy("company_id", "fy", "concept").agg(best.alias("b")).select("company_id", "fy", "concept", "b.*")


def wide(selected: DataFrame, concepts: Iterable[str]) -> DataFrame:
    """company_id, fy, period_end (the latest of the year's) and a column per concept."""
    names = list(concepts)
    each = [F.max(F.when(F.col("concept") == c, F.col("value"))).alias(column_of(c)) for c in names]
    return selected.groupBy("company_id", "fy").agg(F.max("period_end").alias("period_end"), *each)


def unpivoted(frame: DataFrame, keys: list[str], columns: list[str], name: str = "concept", value: str = "value") -> DataFrame:
    """A row for each column that isn't null, in one pass."""
    return frame.unpivot([F.col(k) for k in keys], [F.col(c) for c in columns], name, value).where(F.col(value).isNotNull())


def beside_year_before(frame: DataFrame, columns: Iterable[str], years: int = 1, mark: str = "_b") -> DataFrame:
    """frame with those columns of the row so many fiscal years before, or null; one window per company, no join.

    Rows are looked up by their fiscal year, so gaps give null.
    """
    before = Window.partitionBy("company_id").orderBy("fy").rangeBetween(-years, -years)
    at = F.first(F.struct(*columns)).over(before)
    return frame.withColumn("_before", at).select(*frame.columns, *(F.col(f"_before.{c}").alias(f"{c}{mark}") for c in columns))


def short_year() -> Column:
    """Days since the year before ended (period_end, period_end_b), where they are too few for a full year."""
    days = F.date_diff("period_end", "period_end_b")
    return F.when(days < FULL_YEAR, days)


def coverage(selected: DataFrame, concepts: Iterable[str]) -> DataFrame:
    """company_id, first_fy, last_fy, statements (sorted list), missing_years and whether the statements cover is, bs and cf."""
    rows = query(selected, concepts=concepts)
    out = rows.groupBy("company_id").agg(F.min("fy").alias("first_fy"), F.max("fy").alias("last_fy"), F.array_sort(F.collect_set(F.substring_index("concept", ".", 1))).alias("statements"), F.collect_set("fy").alias("years"))
    missing = F.array_except(F.sequence("first_fy", "last_fy"), F.col("years"))
    complete = F.size(F.array_except(F.array(*map(F.lit, ("is", "bs", "cf"))), F.col("statements"))) == 0
    out = out.withColumns({"missing_years": F.array_join(missing.cast("array<string>"), ","), "complete": complete})
    return out.withColumn("statements", F.array_join("statements", ",")).select("company_id", "first_fy", "last_fy", "statements", "missing_years", "complete")


def fiscal_year_gaps(books: DataFrame, column: str) -> DataFrame:
    """company_id, gap_from, gap_to: runs of fiscal years without a figure between years that have one."""
    have = books.where(F.col(column).isNotNull()).select("company_id", "fy").distinct()
    following = F.lead("fy").over(Window.partitionBy("company_id").orderBy("fy"))
    return have.withColumn("following", following).where("following > fy + 1").select("company_id", (F.col("fy") + 1).alias("gap_from"), (F.col("following") - 1).alias("gap_to"))
