"""Ratios, growth, valuation and prices over annual books (company_id, fy, period_end, a column per concept)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.operators.annual import unpivoted


def divided(a: Column, b: Column, positive: bool = True) -> Column:
    """a / b, null where b is zero, or (if positive) negative."""
    return F.when(b > 0 if positive else b != 0, a / b)


def earnings() -> Column:
    return F.coalesce("is_pat_owners", "is_profit_for_period")


def profit_and_equity() -> Column:
    """struct(pat, equity): the owners' profit with the owners' equity, else the whole profit with the whole equity; equity is positive."""
    pair = lambda p, e: F.when(F.col(p).isNotNull() & (F.col(e) > 0), F.struct(F.col(p).alias("pat"), F.col(e).alias("equity")))
    return F.coalesce(pair("is_pat_owners", "bs_equity_owners"), pair("is_profit_for_period", "bs_total_equity"))


def ebit() -> Column:
    """Profit before tax and finance costs, else the operating profit."""
    return F.coalesce(F.col("is_profit_before_tax") + F.abs("is_finance_costs"), F.col("is_operating_profit"))


def dupont(books: DataFrame) -> DataFrame:
    """Per year with profit, equity, revenue and assets: the three factors of ROE and, where they can be had, the five."""
    rows = books.withColumns({"pair": profit_and_equity(), "ebit": ebit(), "pbt": F.col("is_profit_before_tax")}).where("pair is not null and is_revenue > 0 and bs_total_assets > 0")
    pat, equity = F.col("pair.pat"), F.col("pair.equity")
    five = (F.col("pbt") != 0) & (F.col("ebit") != 0)
    return rows.select(
        "company_id", "fy", (pat / F.col("is_revenue")).alias("net_margin"), (F.col("is_revenue") / F.col("bs_total_assets")).alias("turnover"), (F.col("bs_total_assets") / equity).alias("multiplier"), (pat / equity).alias("roe"),
        F.when(five, pat / F.col("pbt")).alias("tax_burden"), F.when(five, F.col("pbt") / F.col("ebit")).alias("interest_burden"), F.when(five, F.col("ebit") / F.col("is_revenue")).alias("operating_margin"),
    )


def _growth_rate(start: Column, end: Column, span: int) -> Column:
    return F.when((start > 0) & (end > 0), F.pow(end / start, F.lit(1.0 / span)) - 1)


def cagr_at(books: DataFrame, value: Column, name: str, span: int) -> DataFrame:
    """books with the compound growth of value over span years to each year; both ends must be there and positive."""
    before = F.first("_end").over(Window.partitionBy("company_id").orderBy("fy").rangeBetween(-span, -span))
    return books.withColumn("_end", value).withColumn(name, _growth_rate(before, F.col("_end"), span)).drop("_end")


def growth(books: DataFrame, spans: tuple[int, ...] = (3, 5)) -> DataFrame:
    """company_id, measure, span, rate: compound growth of revenue, earnings and assets to the last year that has the measure."""
    measures = {"revenue": F.col("is_revenue"), "earnings": earnings(), "assets": F.col("bs_total_assets")}
    rows = unpivoted(books.select("company_id", "fy", *(c.alias(m) for m, c in measures.items())), ["company_id", "fy"], list(measures), "measure", "end")
    own = Window.partitionBy("company_id", "measure")
    for span in spans:
        rows = rows.withColumn(f"s{span}", F.first("end").over(own.orderBy("fy").rangeBetween(-span, -span)))
    last = rows.withColumn("last", F.max("fy").over(own)).where("fy = last")
    rates = F.array(*(F.struct(F.lit(span).alias("span"), _growth_rate(F.col(f"s{span}"), F.col("end"), span).alias("rate")) for span in spans))
    return last.select("company_id", "measure", F.inline(rates))


def roe_trend(books: DataFrame) -> DataFrame:
    """company_id, fy, roe and its change from the row before."""
    pair = profit_and_equity()
    rows = books.select("company_id", "fy", (pair["pat"] / pair["equity"]).alias("roe"))
    return rows.withColumn("change_from_before", F.col("roe") - F.lag("roe").over(Window.partitionBy("company_id").orderBy("fy")))


def effective_tax_rate() -> Column:
    rate = F.try_divide(-F.col("is_tax_expense"), F.col("is_profit_before_tax"))
    return F.when(rate.between(0, 0.6), rate)


#: What valuation adds to books.
VALUES = ["ebit", "tax_rate", "dep_amort", "capex", "wc_change", "net_debt", "ebitda", "nopat", "fcfe", "fcff"]


def valued(books: DataFrame) -> DataFrame:
    """books with VALUES for each year."""
    by_cash = F.when(F.col("cf_profit_before_tax").isNotNull(), F.col("cf_operating_before_wc") - F.col("is_profit_before_tax"))
    depreciation = F.coalesce(F.when(by_cash >= 0, by_cash), F.abs("is_depreciation_amortisation"))
    items = F.col("cf_changes_in_receivables") + F.col("cf_changes_in_inventories") + F.col("cf_changes_in_payables")
    parts = F.coalesce("bs_lt_borrowings", F.lit(0.0)) + F.coalesce("bs_st_borrowings", F.lit(0.0))
    some = F.col("bs_lt_borrowings").isNotNull() | F.col("bs_st_borrowings").isNotNull()
    borrowings = F.coalesce("bs_borrowings_total", F.when(some, parts))
    rows = books.withColumns({
        "ebit": ebit(), "tax_rate": effective_tax_rate(), "dep_amort": depreciation, "capex": F.abs("cf_purchase_of_ppe"), "wc_change": F.coalesce(items, F.col("cf_working_capital_changes")),
        "net_debt": F.abs(borrowings) - F.col("bs_cash_and_equivalents"),
    })
    rows = rows.withColumns({"ebitda": F.col("ebit") + F.col("dep_amort"), "nopat": F.col("ebit") * (1 - F.col("tax_rate")), "fcfe": F.col("cf_net_operating") - F.col("capex")})
    return rows.withColumn("fcff", F.col("nopat") + F.col("dep_amort") - F.col("capex") - F.coalesce("wc_change", F.lit(0.0)))


def valuation(books: DataFrame) -> DataFrame:
    return valued(books).select("company_id", "fy", "period_end", *VALUES)


def shares_in_issue() -> Column:
    """Reported if positive, else owners' profit over earnings per share (sen), if that is positive."""
    implied = F.try_divide(F.col("is_pat_owners"), F.col("is_eps_basic") / 100)
    return F.coalesce(F.when(F.col("is_weighted_avg_shares") > 0, F.col("is_weighted_avg_shares")), F.when(implied > 0, implied))


def closes_asof(targets: DataFrame, closes: DataFrame, days: int = 10) -> DataFrame:
    """targets (company_id, target) with day and close of the last price on or before the target, at most so many days old.

    A price serves at most days + 1 targets: each is placed in blocks of that length, and a target looks in two of them, so the
    join is one of equal keys, however long the history.
    """
    block = lambda d: F.floor(F.unix_date(d) / (days + 1)).cast("int")
    wanted = targets.withColumn("block", F.explode(F.array(block(F.col("target")), block(F.col("target")) - 1)))
    found = wanted.join(closes.withColumn("block", block(F.col("day"))), ["company_id", "block"])
    found = found.where((F.col("day") <= F.col("target")) & (F.date_diff("target", "day") <= days))
    last = found.groupBy("company_id", "target").agg(F.max(F.struct("day", "close")).alias("last"))
    return targets.join(last, ["company_id", "target"], "left").select(*targets.columns, F.col("last.day").alias("day"), F.col("last.close").alias("close"))


def price_ratios(books: DataFrame, prices: DataFrame) -> DataFrame:
    """Per year with a close (company_id, fy, close): shares, market_cap, pe, pb, ev_ebitda, dividend_yield."""
    rows = valued(books).join(prices, ["company_id", "fy"]).where("close is not null")
    rows = rows.withColumns({"shares": shares_in_issue(), "equity": F.coalesce("bs_equity_owners", "bs_total_equity")}).withColumn("market_cap", F.col("close") * F.col("shares"))
    pb = F.coalesce(F.when(F.col("equity") > 0, F.col("market_cap") / F.col("equity")), F.try_divide(F.col("close"), F.when(F.col("bs_nta_per_share") > 0, F.col("bs_nta_per_share"))))
    return rows.select(
        "company_id", "fy", "close", "shares", "market_cap", F.try_divide(F.col("close"), F.col("is_eps_basic") / 100).alias("pe"), pb.alias("pb"),
        divided(F.col("market_cap") + F.coalesce("net_debt", F.lit(0.0)), F.col("ebitda")).alias("ev_ebitda"), divided(F.abs("cf_dividends_paid"), F.col("market_cap")).alias("dividend_yield"),
    )
