"""Peers: each company's latest year in twelve metrics, their statistics, and where a company stands among others."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finloom.operators import order_stats
from finloom.operators.annual import beside_year_before, short_year
from finloom.operators.ratios import cagr_at, divided, earnings, ebit, profit_and_equity, valued
from finloom.plans.stored import stored

#: Metrics with the range in which they are plausible, ends included (None: any).
METRICS = {
    "revenue": None,
    "patami": None,
    "roe": (-2.0, 2.0),
    "roa": (-1.0, 1.0),
    "net_margin": (-1.0, 1.0),
    "operating_margin": (-1.0, 1.0),
    "asset_turnover": (0.0, 10.0),
    "equity_multiplier": (0.0, 50.0),
    "revenue_cagr_3y": (-0.9, 3.0),
    "earnings_cagr_3y": (-0.9, 5.0),
    "net_debt_ebitda": (-20.0, 20.0),
    "fcf_margin": (-2.0, 2.0),
}
#: Owners' share of the profit outside this range makes what is built on it implausible.
OWNERS_SHARE = (0.2, 2.0)
BY_OWNERS = ["patami", "roa", "net_margin", "earnings_cagr_3y"]
CASH_AND_DEBT = ["net_debt_ebitda", "fcf_margin"]
#: What makes no sense for a profile.
INAPPLICABLE = {"bank": ["revenue", "net_margin", "operating_margin", "asset_turnover", "revenue_cagr_3y", *CASH_AND_DEBT], "insurance": CASH_AND_DEBT}


def year_metrics(books: DataFrame) -> DataFrame:
    """All years with their metrics, the days of a year that is too short, and whether there is a profit."""
    rows = cagr_at(cagr_at(valued(books), F.col("is_revenue"), "revenue_cagr_3y", 3), earnings(), "earnings_cagr_3y", 3)
    rows = beside_year_before(rows, ["period_end"])
    rows = rows.withColumns({"pair": profit_and_equity(), "positive": F.when(F.col("is_revenue") > 0, F.col("is_revenue")), "patami": earnings()})
    share = F.try_divide(F.col("is_pat_owners"), F.col("is_profit_for_period"))
    return rows.select(
        "company_id", "fy", "period_end", short_year().alias("short_days"), F.col("is_revenue").alias("revenue"), "patami", (F.col("pair.pat") / F.col("pair.equity")).alias("roe"),
        divided(F.col("patami"), F.col("bs_total_assets")).alias("roa"), (F.col("patami") / F.col("positive")).alias("net_margin"), (ebit() / F.col("positive")).alias("operating_margin"),
        divided(F.col("positive"), F.col("bs_total_assets")).alias("asset_turnover"), divided(F.col("bs_total_assets"), F.col("pair.equity")).alias("equity_multiplier"), "revenue_cagr_3y", "earnings_cagr_3y",
        divided(F.col("net_debt"), F.col("ebitda")).alias("net_debt_ebitda"), (F.col("fcfe") / F.col("positive")).alias("fcf_margin"),
        (~share.between(*OWNERS_SHARE)).alias("owners_odd"), F.col("bs_equity_owners").isNotNull().alias("by_owners_equity"),
    )


def snapshot(books: DataFrame, companies: DataFrame, fiscal_year: int | None = None) -> DataFrame:
    """One year per company: the one asked for, or the newest full year with a profit, else the newest; a row per company that has one."""
    years = year_metrics(books)
    if fiscal_year is not None:
        chosen = years.where(F.col("fy") == fiscal_year)
    else:
        rank = F.struct((F.col("patami").isNotNull() & F.col("short_days").isNull()).alias("full"), "fy")
        best = years.groupBy("company_id").agg(F.max_by(F.struct(*years.columns), rank).alias("y"))
        chosen = best.select("y.*")
    return chosen.join(companies.select("company_id", "sector", "profile"), "company_id")


def metrics(snap: DataFrame) -> DataFrame:
    """company_id, sector, profile, fy, metric, value, not_applicable, flagged: all metrics of a snapshot in one pass."""
    each = []
    for name, bounds in METRICS.items():
        barred = F.col("profile").isin([p for p, names in INAPPLICABLE.items() if name in names] or ["-"])
        value = F.when(~F.coalesce(barred, F.lit(False)), F.col(name))
        odd = F.lit(False) if bounds is None else F.coalesce(~value.between(*bounds), F.lit(False))
        if name in BY_OWNERS or name == "roe":
            doubtful = F.coalesce(F.col("owners_odd"), F.lit(False)) & value.isNotNull()
            odd = odd | (doubtful & F.col("by_owners_equity") if name == "roe" else doubtful)
        each.append(F.struct(F.lit(name).alias("metric"), value.alias("value"), F.coalesce(barred, F.lit(False)).alias("not_applicable"), odd.alias("flagged")))
    return snap.select("company_id", "sector", "profile", "fy", F.inline(F.array(*each)))


def statistics(rows: DataFrame, by: Iterable[str] = ("sector",)) -> DataFrame:
    """Per group and metric: n, n_flagged, q1, median_value, q3, low, high over values that aren't flagged."""
    keys = [*by, "metric"]
    held = stored(rows.select(*keys, "value", "flagged"), "peer-values")
    clean = F.when(~F.col("flagged"), F.col("value"))
    totals = held.groupBy(*keys).agg(F.count(clean).alias("n"), F.count_if("flagged").alias("n_flagged"), F.min(clean).alias("low"), F.max(clean).alias("high"))
    placed = order_stats.places(held.where("not flagged"), keys, "value")
    found = order_stats.quantiles(placed, keys, "value", {"q1": 0.25, "median_value": 0.5, "q3": 0.75}).drop("n")
    return order_stats.joined(totals, found, keys, "left").select(*keys, "n", "n_flagged", "q1", "median_value", "q3", "low", "high")


def percentiles(rows: DataFrame, by: Iterable[str] = ("sector",)) -> DataFrame:
    """company_id, group, metric, percentile: 100 (below + (equal - 1) / 2) / (n - 1), null for a group of one."""
    keys = [*by, "metric"]
    clean = stored(rows.where("value is not null and not flagged").select("company_id", *keys, "value"), "peer-values")
    placed = order_stats.places(clean, keys, "value")
    rank = F.when(F.col("n") > 1, 100 * (F.col("below") + 0.5 * (F.col("equal") - 1)) / (F.col("n") - 1))
    return order_stats.joined(clean, placed.select(*keys, "value", rank.alias("percentile")), [*keys, "value"]).select("company_id", *keys, "percentile")


def comparison(books: DataFrame, companies: DataFrame, sector: str | None = None, company_ids: Iterable | None = None, fiscal_year: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metrics, statistics and percentiles of the companies of a sector (any case) or of a list; with neither, of all."""
    chosen = companies
    if sector is not None:
        chosen = chosen.where(F.lower("sector") == sector.lower())
    if company_ids is not None:
        chosen = chosen.where(F.col("company_id").isin(*dict.fromkeys(company_ids)))
    rows = metrics(snapshot(books.join(chosen.select("company_id"), "company_id", "left_semi"), chosen, fiscal_year))
    return rows, statistics(rows, ()), percentiles(rows, ())


def year_mix(snap: DataFrame) -> DataFrame:
    """sector, fy, companies and the number of months in which their years end."""
    return snap.groupBy("sector", "fy").agg(F.count("*").alias("companies"), F.count_distinct(F.month("period_end")).alias("months"))


def sectors(companies: DataFrame, books: DataFrame) -> DataFrame:
    """sector, total and covered (companies with books)."""
    have = books.select("company_id").distinct().withColumn("covered", F.lit(1))
    return companies.join(have, "company_id", "left").groupBy("sector").agg(F.count("*").alias("total"), F.count("covered").alias("covered"))
