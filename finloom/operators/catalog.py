"""Registered queries over the annual books: each applies its operators to all companies, with a DuckDB twin written on its own.

The twins share the books' definition (plans/book.py) with the queries, as both engines must read the same figures; what is done
with them is written twice, in columns and windows here and in joins and aggregates there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.operators import annual, dividends, entities, peers, ratios, results, review, rules
from finloom.plans.book import CONCEPTS, WITH_BOOK, books, companies

DIGITS = 6


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded for comparison, without negative zeros."""
    return df.select(*((F.round(F.col(c), DIGITS) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _years_of_dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dividends.dividend_years(dividends.marked(books(spark, sf_dir), companies(spark, sf_dir)))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.with_prior(results.figures(_years_of_dividends(spark, sf_dir)))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peers.metrics(peers.snapshot(books(spark, sf_dir), companies(spark, sf_dir)))


def _closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").where("event_type = 'purchase' and user_id is not null")
    return events.groupBy(F.col("user_id").alias("company_id"), F.to_date("ts").alias("day")).agg(F.max("value").alias("close"))


def dupont3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ratios.dupont(books(spark, sf_dir)).select("company_id", "fy", "net_margin", "turnover", "multiplier", "roe"))


def dupont5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ratios.dupont(books(spark, sf_dir)).where("tax_burden is not null")
    return rounded(rows.select("company_id", "fy", "tax_burden", "interest_burden", "operating_margin", "turnover", "multiplier"))


def growth_cagr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ratios.growth(books(spark, sf_dir)))


def roe_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ratios.roe_trend(books(spark, sf_dir)))


def valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ratios.valuation(books(spark, sf_dir)))


def close_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.make_date(F.lit(2024), F.lit(1), (5 + F.col("company_id") % 26).cast("int"))
    return ratios.closes_asof(companies(spark, sf_dir).select("company_id", day.alias("target")), _closes(spark, sf_dir))


def price_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last close of each company, set against its latest year."""
    b = books(spark, sf_dir)
    last = b.groupBy("company_id").agg(F.max("fy").alias("fy"))
    prices = close_asof(spark, sf_dir).join(last, "company_id").select("company_id", "fy", "close")
    return rounded(ratios.price_ratios(b, prices))


def dividend_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_years_of_dividends(spark, sf_dir).select("company_id", "fy", *dividends.YEAR))


def dividend_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(dividends.dividend_history(_years_of_dividends(spark, sf_dir)))


def dividend_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(dividends.dividend_screen(dividends.dividend_history(_years_of_dividends(spark, sf_dir))).select("company_id", "streak", "median_payout"))


def peer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_metrics(spark, sf_dir))


def peer_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_metrics(spark, sf_dir).where("flagged").select("company_id", "sector", "metric", "value"))


def peer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(peers.statistics(_metrics(spark, sf_dir)))


def peer_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(peers.percentiles(_metrics(spark, sf_dir)))


def peer_fy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peers.year_mix(peers.snapshot(books(spark, sf_dir), companies(spark, sf_dir)))


def sector_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peers.sectors(companies(spark, sf_dir), books(spark, sf_dir))


def results_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(results.headline_rows(_pairs(spark, sf_dir)))


def results_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(results.observations(_pairs(spark, sf_dir)))


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(results.feed(_pairs(spark, sf_dir)).drop("patami_b"))


def feed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(results.month_digest(results.feed(_pairs(spark, sf_dir))))


def fy_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years for which a company's total assets aren't reported."""
    return annual.fiscal_year_gaps(books(spark, sf_dir), "bs_total_assets")


def feed_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The books' profits count as thousands, as their companies are small."""
    return rounded(results.movers(results.feed(_pairs(spark, sf_dir)), results.MOVER_BASE / 1000))


def sector_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(results.sector_context(_pairs(spark, sf_dir), companies(spark, sf_dir)))


def long_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(annual.unpivoted(books(spark, sf_dir), ["company_id", "fy"], CONCEPTS))


def rules_single_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rules.single_period(books(spark, sf_dir), ["company_id", "fy"]))


def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.validation_totals(rules.single_period(books(spark, sf_dir), ["company_id", "fy"]))


def derive_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rules.derived(books(spark, sf_dir), ["company_id", "fy"]))


def rules_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rules.magnitude(books(spark, sf_dir), "is_revenue"))


def five_year_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every year's revenue as a summary in thousands prints it: some with the sign or the scale wrong, some years before the first."""
    b = books(spark, sf_dir).select("company_id", "fy", F.col("is_revenue").alias("fact"))
    k = F.col("company_id") + F.col("fy")
    thousands = F.floor(F.col("fact") / 1000) * 1000.0
    shown = F.when(k % 29 == 0, -F.col("fact")).when(k % 31 == 0, F.col("fact") * 1000).when(k % 10 == 0, F.col("fact") * 1.03).when(k % 37 == 0, 0.0).otherwise(thousands)
    years = b.select("company_id", "fy", shown.alias("shown")).unionByName(b.groupBy("company_id").agg((F.min("fy") - 1).alias("fy"), F.lit(1.0).alias("shown")))
    rows = years.join(b, ["company_id", "fy"], "left").withColumn("c", rules.summary_check(F.col("shown"), F.col("fact"), F.lit(500.0)))
    return rounded(rows.select("company_id", "fy", "shown", "c.class", "c.deviation", "c.note"))


def benchmark_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals stand for an outside source, line totals for ours; all orders on either side."""
    base = sf_dir.rstrip("/")
    cents = F.floor(F.col("l_extendedprice") * 100).cast("long")
    ours = spark.read.parquet(f"{base}/lineitem.parquet").groupBy(F.col("l_orderkey").alias("k")).agg((F.sum(cents).cast("double") / 100).alias("value"))
    theirs = spark.read.parquet(f"{base}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("value"))
    return rounded(rules.against_source(ours, theirs, ["k"]))


def benchmark_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_compare(spark, sf_dir).groupBy("class").agg(F.count("*").alias("n"))


def hygiene_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of three kinds: no facts, implausible payouts, years without word of dividends."""
    b, c = books(spark, sf_dir), companies(spark, sf_dir)
    years = dividends.dividend_years(dividends.marked(b, c))
    facts = b.groupBy("company_id").agg(F.count("*").alias("facts"))
    kinds = F.array_compact(F.array(F.when(F.col("payout") > dividends.PAYOUT_FLAG, F.struct(F.lit("implausible_payout").alias("category"), F.lit(50).alias("weight"))), F.when(F.col("paid").isNull(), F.struct(F.lit("year_without_dividend_figure").alias("category"), F.lit(10).alias("weight")))))
    empty = c.join(facts, "company_id", "left_anti").select("company_id", F.lit("no_facts").alias("category"), F.lit(100).alias("weight"))
    return entities.impact(years.select("company_id", F.inline(kinds)).unionByName(empty), facts)


def annual_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand for documents, their lines for facts on a supplier's year; some are too unsure, or not consolidated."""
    base = sf_dir.rstrip("/")
    lines, orders = spark.read.parquet(f"{base}/lineitem.parquet"), spark.read.parquet(f"{base}/orders.parquet")
    period = F.year("l_shipdate") * 100 + F.month("l_shipdate")
    facts = lines.select(
        F.col("l_suppkey").alias("company_id"), F.concat(F.lit("is."), F.lower(F.concat("l_returnflag", "l_linestatus"))).alias("concept"), period.alias("period_id"), F.col("l_orderkey").alias("document_id"), F.when(F.col("l_linenumber") == 7, "COMPANY").otherwise("CONSOLIDATED").alias("basis"),
        F.lit("TOTAL").alias("continuity"), (1.0 - F.col("l_linenumber") * F.lit(0.02)).alias("confidence"), (F.col("l_quantity") * 1000 + F.col("l_linenumber")).cast("double").alias("value"),
    )
    key = ["company_id", "concept", "period_id", "document_id", "basis"]
    facts = facts.groupBy(*key, "continuity").agg(F.max(F.struct("confidence", "value")).alias("b")).select(*key, "continuity", "b.*")
    month = F.col("period_id") % 100
    periods = facts.select("period_id").distinct().select("period_id", F.when(month == 2, "Q1").when(month % 2 == 0, "INSTANT").otherwise("FY").alias("period_type"), (F.col("period_id") / 100).cast("int").alias("fiscal_year"), F.last_day(F.make_date((F.col("period_id") / 100).cast("int"), month.cast("int"), F.lit(1))).alias("period_end"))
    documents = orders.select(F.col("o_orderkey").alias("document_id"), F.when(F.col("o_orderkey") % 5 != 0, F.to_date("o_orderdate")).alias("filed"), F.when(F.col("o_orderkey") % 3 != 0, F.to_date("o_orderdate")).alias("hint"))
    return annual.annual_selection(facts, periods, documents)


def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = annual.unpivoted(books(spark, sf_dir), ["company_id", "fy"], CONCEPTS)
    return annual.coverage(rows.withColumn("concept", F.concat_ws(".", F.substring("concept", 1, 2), F.substring("concept", 4, 100))), [c.replace("_", ".", 1) for c in CONCEPTS])


def concept_suggest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names against a vocabulary: the names of part types."""
    part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet")
    known = part.select(F.col("p_type").alias("concept"), F.col("p_type").alias("label")).distinct()
    return rounded(review.suggest(part.select(F.col("p_name").alias("label")).where("label is not null"), known))


FRAMES = {
    f.__name__: f
    for f in (
        dupont3, dupont5, growth_cagr, roe_trend, valuation, close_asof, price_ratios, dividend_years, dividend_history, dividend_screen, peer_snapshot, peer_flags, peer_stats, peer_percentiles, peer_fy_mix, sector_list,
        results_rows, results_observations, feed_items, feed_months, fy_gaps, feed_movers, sector_context, long_export, rules_single_period, validation_summary, derive_facts, rules_magnitude, five_year_check, benchmark_compare,
        benchmark_counts, hygiene_impact, annual_selection, coverage_summary, concept_suggest,
    )
}
__all__ = ["FRAMES", "WITH_BOOK"]
