"""Results of a year against the year before: figures, headline rows, observations, the feed and its months, and sector context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.operators import order_stats
from finloom.operators.annual import FULL_YEAR, LONG_YEAR, beside_year_before
from finloom.operators.ratios import divided, earnings
from finloom.plans.stored import stored

#: The least profit of movers' base year, how many movers each way, and revenues that can't be.
MOVER_BASE, MOVERS, LEAST_REVENUE, MOST_REVENUE = 5e6, 5, 1e5, 5e11
FLAT = 0.05
#: Headline rows and how their change is told: as a share, or in percentage points.
ROWS = {
    "revenue": "money", "gross_profit": "money", "pbt": "money", "patami": "money", "eps_sen": "sen", "gross_margin": "pct", "pbt_margin": "pct", "net_margin": "pct", "roe": "pct", "tax_rate": "pct",
    "ocf": "money", "capex": "money", "fcf": "money", "net_debt": "money", "gearing": "pct", "dps_sen": "sen", "payout": "pct",
}


def figures(books: DataFrame) -> DataFrame:
    """company_id, fy, period_end and the figures of ROWS; dps_sen and payout are taken where books have them."""
    for name in ("dps_sen", "payout"):
        if name not in books.columns:
            books = books.withColumn(name, F.lit(None).cast("double"))
    lt, st = F.abs("bs_lt_borrowings"), F.abs("bs_st_borrowings")
    parts = F.when(lt.isNotNull() | st.isNotNull(), F.coalesce(lt, F.lit(0.0)) + F.coalesce(st, F.lit(0.0)))
    rows = books.select(
        "company_id", "fy", "period_end", F.col("is_revenue").alias("revenue"), F.col("is_gross_profit").alias("gross_profit"), F.col("is_profit_before_tax").alias("pbt"), F.abs("is_tax_expense").alias("tax"),
        earnings().alias("patami"), F.col("is_eps_basic").alias("eps_sen"), F.col("cf_net_operating").alias("ocf"), F.abs("cf_purchase_of_ppe").alias("capex"),
        F.coalesce("bs_equity_owners", "bs_total_equity").alias("equity"), (F.abs(F.coalesce("bs_borrowings_total", parts)) - F.col("bs_cash_and_equivalents")).alias("net_debt"), "dps_sen", "payout",
    )
    c = F.col
    return rows.withColumns({
        "gross_margin": divided(c("gross_profit"), c("revenue")), "pbt_margin": divided(c("pbt"), c("revenue")), "net_margin": divided(c("patami"), c("revenue")), "roe": divided(c("patami"), c("equity")),
        "tax_rate": divided(c("tax"), c("pbt")), "fcf": c("ocf") - c("capex"), "gearing": divided(c("net_debt"), c("equity")),
    })


def with_prior(years: DataFrame) -> DataFrame:
    """Each year beside its comparable year before (mark _b): a full year that ended 330 to 400 days earlier; full: whether it is one itself."""
    rows = beside_year_before(years, [*ROWS, "period_end"])
    days = F.date_diff("period_end", "period_end_b")
    full = F.coalesce(days >= FULL_YEAR, F.lit(True))
    # The year before is a full one if nothing stands before it, or that ended long enough before.
    row_before = F.first("period_end").over(Window.partitionBy("company_id").orderBy("fy").rangeBetween(-2, -2))
    before_full = F.coalesce(F.date_diff("period_end_b", row_before) >= FULL_YEAR, F.lit(True))
    comparable = before_full & days.between(FULL_YEAR, LONG_YEAR)
    rows = rows.withColumns({"full": full, "comparable": F.coalesce(comparable, F.lit(False))})
    return rows.withColumns({f"{m}_b": F.when(F.col("comparable"), F.col(f"{m}_b")) for m in ROWS})


def change_kind(now: Column, before: Column) -> Column:
    return (
        F.when(now.isNull() | before.isNull(), "none").when((before > 0) & (now > 0), "growth").when((before <= 0) & (now > 0), "turnaround")
        .when((before > 0) & (now <= 0), "to_loss").when(before == 0, "none").when(now > before, "loss_narrowed").otherwise("loss_widened")
    )


def growth_of(now: Column, before: Column) -> Column:
    return F.when((before > 0) & (now > 0), now / before - 1)


def tone() -> Column:
    """new, up, down or flat of a year beside its prior: by the kind of change of profit, else by growth of profit or revenue."""
    kind, revenue = change_kind(F.col("patami"), F.col("patami_b")), growth_of(F.col("revenue"), F.col("revenue_b"))
    growth = F.when(kind == "growth", growth_of(F.col("patami"), F.col("patami_b"))).otherwise(revenue)
    by_growth = F.when(growth >= FLAT, "up").when(growth <= -FLAT, "down").otherwise("flat")
    return F.when(~F.col("comparable"), "new").when(kind.isin("turnaround", "loss_narrowed"), "up").when(kind.isin("to_loss", "loss_widened"), "down").otherwise(by_growth)


def headline_rows(pairs: DataFrame) -> DataFrame:
    """company_id, fy, measure, current_value, value_before, change (a share, or points), kind: a row per measure, in one pass."""
    each = []
    for name, told in ROWS.items():
        now, before = F.col(name), F.col(f"{name}_b")
        points = (now - before) * 100
        change, kind = (points, F.when(points.isNotNull(), "pp").otherwise("none")) if told == "pct" else (growth_of(now, before), change_kind(now, before))
        each.append(F.struct(F.lit(name).alias("measure"), now.alias("current_value"), before.alias("value_before"), change.alias("change"), kind.alias("kind")))
    return pairs.select("company_id", "fy", F.inline(F.array(*each))).where("current_value is not null or value_before is not null")


def observations(pairs: DataFrame) -> DataFrame:
    """company_id, fy, observation, figure: what an analyst would look at, from one pass over years beside their prior."""
    revenues = F.when(F.col("revenue") != 0, F.struct("fy", "revenue"))
    four = Window.partitionBy("company_id").orderBy("fy").rowsBetween(-5, 0)
    pairs = pairs.withColumn("known", F.collect_list(revenues).over(four))
    c, n = F.col, F.size("known")
    first, last = F.get("known", n - 4), F.get("known", n - 1)
    steady = (n >= 4) & (first["revenue"] > 0) & (last["fy"] - first["fy"] == 3)
    average = F.when(steady & (last["revenue"] > 0), F.pow(last["revenue"] / first["revenue"], F.lit(1.0 / 3)) - 1)
    growth, profit = growth_of(c("revenue"), c("revenue_b")), growth_of(c("patami"), c("patami_b"))
    kind, margin = change_kind(c("patami"), c("patami_b")), c("net_margin") - c("net_margin_b")
    cash = F.when(c("patami") > 0, c("ocf") / c("patami"))
    gap = profit - growth
    geared = F.coalesce(c("gearing") > 1, F.lit(False))
    rising = (c("net_debt_b") > 0) & (c("net_debt") > 1.25 * c("net_debt_b")) & (c("net_debt") - c("net_debt_b") > 1e7)
    found = [
        ("weak_cash_conversion", cash < 0.5, cash),
        ("strong_cash_conversion", cash > 1.5, cash),
        ("negative_free_cash", (c("fcf") < 0) & (c("patami") > 0), c("fcf")),
        ("margin_expansion", margin * 100 >= 3, margin),
        ("margin_compression", margin * 100 <= -3, margin),
        ("profit_outpaces_revenue", gap >= 0.25, gap),
        ("profit_lags_revenue", gap <= -0.25, gap),
        ("back_in_profit", kind == "turnaround", c("patami")),
        ("swung_to_loss", kind == "to_loss", c("patami")),
        ("high_gearing", geared, c("gearing")),
        ("net_debt_rising", ~geared & rising, c("net_debt")),
        ("dividends_above_earnings", c("payout") > 1, c("payout")),
        ("unusual_tax_rate", (c("tax_rate") < 0.10) | (c("tax_rate") > 0.40), c("tax_rate")),
        ("growth_accelerating", growth - average >= 0.10, growth - average),
        ("growth_slowing", growth - average <= -0.10, growth - average),
    ]
    each = F.array_compact(F.array(*(F.when(when, F.struct(F.lit(name).alias("observation"), figure.alias("figure"))) for name, when, figure in found)))
    return pairs.select("company_id", "fy", F.inline(each))


def feed(pairs: DataFrame, today: Column | None = None, months: int | None = None) -> DataFrame:
    """company_id, fy, period_end, cohort (yyyymm), revenue, patami, kind, tone, growth, rev_growth, plausible: full years up to today.

    months: of the latest cohort and those before it.
    """
    rows = pairs.where("full")
    if today is not None:
        rows = rows.where(F.col("period_end") <= today)
    month = F.year("period_end") * 12 + F.month("period_end") - 1
    out = rows.select(
        "company_id", "fy", "period_end", (F.year("period_end") * 100 + F.month("period_end")).alias("cohort"), month.alias("month"), "revenue", "patami", "patami_b", change_kind(F.col("patami"), F.col("patami_b")).alias("kind"), tone().alias("tone"),
        growth_of(F.col("patami"), F.col("patami_b")).alias("growth"), growth_of(F.col("revenue"), F.col("revenue_b")).alias("rev_growth"),
        F.coalesce((F.col("revenue") >= LEAST_REVENUE) & (F.col("revenue") <= MOST_REVENUE), F.lit(False)).alias("plausible"),
    )
    if months is not None:
        latest = out.agg(F.max("month").alias("latest"))
        out = out.join(F.broadcast(latest), F.col("month") > F.col("latest") - months).drop("latest")
    return out.drop("month")


def month_digest(items: DataFrame) -> DataFrame:
    """Per cohort: n, up, down, flat, fresh, median_growth, median_rev_growth."""
    count = lambda t: F.count_if(F.col("tone") == t)
    held = stored(items.select("cohort", "tone", "growth", "rev_growth"), "feed-months")
    totals = held.groupBy("cohort").agg(F.count("*").alias("n"), count("up").alias("up"), count("down").alias("down"), count("flat").alias("flat"), count("new").alias("fresh"))
    each = F.inline(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in ("growth", "rev_growth"))))
    medians = order_stats.quantiles(order_stats.places(held.select("cohort", each), ["cohort", "measure"], "value"), ["cohort", "measure"], "value", {"median": 0.5})
    wide = medians.groupBy("cohort").agg(*(F.max(F.when(F.col("measure") == m, F.col("median"))).alias(f"median_{m}") for m in ("growth", "rev_growth")))
    return order_stats.joined(totals, wide, ["cohort"], "left")


def movers(items: DataFrame, base: float = MOVER_BASE) -> DataFrame:
    """cohort, company_id, growth, side: the five that grew and the five that fell most, of those with a base that counts.

    The best of parts of a cohort come first and are then ranked together, so no task ranks all companies of a cohort.
    """
    rows = items.where((F.col("patami_b") >= base) & F.col("growth").isNotNull() & F.col("plausible")).select("cohort", "company_id", "growth")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("company_id"), F.lit(64)))
    for keys in (["cohort", "part"], ["cohort"]):
        within = Window.partitionBy(*keys)
        rows = rows.withColumns({"up": F.row_number().over(within.orderBy(F.desc("growth"), "company_id")), "down": F.row_number().over(within.orderBy("growth", "company_id"))})
        rows = rows.where((F.col("up") <= MOVERS) & (F.col("growth") > 0) | (F.col("down") <= MOVERS) & (F.col("growth") < 0))
    return rows.select("cohort", "company_id", "growth", F.when(F.col("growth") > 0, "gainer").otherwise("decliner").alias("side"))


def sector_context(pairs: DataFrame, companies: DataFrame, least: int = 3) -> DataFrame:
    """company_id, fy, margin_median, margin_rank, growth_median, growth_rank among the sector's companies of the year.

    A median needs so many values; a company without a value has no rank. Places are counted over distinct values.
    """
    rows = pairs.where("full").select("company_id", "fy", F.col("net_margin").alias("margin"), growth_of(F.col("patami"), F.col("patami_b")).alias("growth")).join(companies.select("company_id", "sector"), "company_id")
    keys, measures = ["sector", "fy", "measure"], ["margin", "growth"]
    each = F.inline(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures)))
    long = stored(rows.select("company_id", "sector", "fy", each), "sector-values")
    placed = order_stats.places(long, keys, "value")
    medians = order_stats.quantiles(placed, keys, "value", {"median": 0.5}).where(F.col("n") >= least)
    ranks = placed.where(F.col("n") >= least).select(*keys, "value", (F.col("n") - F.col("below") - F.col("equal") + 1).alias("rank"))
    met = order_stats.joined(order_stats.joined(long, medians.drop("n"), keys, "left"), ranks, [*keys, "value"], "left")
    told = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{m}_{c}")
    return met.groupBy("company_id", "fy").agg(*(told(m, c) for m in measures for c in ("median", "rank")))
