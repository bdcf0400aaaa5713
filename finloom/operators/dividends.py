"""Dividends over annual books: each year's payout, streaks of paying years, and a screen over all companies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finloom.operators.ratios import shares_in_issue

#: A payout above this is implausible, share counts apart by more than this disagree, and a count that moves by more has jumped.
PAYOUT_FLAG, SHARES_MISMATCH, SHARE_JUMP = 3.0, 0.2, 1.3


#: What dividend_years adds to books.
YEAR = ["dividends", "basis", "shares", "dps_sen", "paid", "payout", "cover", "growth", "share_ratio", "flags"]


def marked(books: DataFrame, companies: DataFrame) -> DataFrame:
    """books with reit: by profile, by name, or as a company reports a distribution per unit in any year."""
    name = F.lower(F.col("name"))
    named = companies.select("company_id", ((F.col("profile") == "reit") | name.contains("real estate investment trust") | name.endswith(" reit")).alias("_named"))
    per_unit = F.max(F.col("is_dpu").isNotNull()).over(Window.partitionBy("company_id"))
    return books.join(named, "company_id", "left").withColumn("reit", F.coalesce("_named", F.lit(False)) | per_unit).drop("_named")


def dividend_years(rows: DataFrame) -> DataFrame:
    """Marked books with YEAR: dividends and their basis, shares, dps_sen, paid, payout, cover, growth, share_ratio and flags (comma list).

    Cash paid counts before the equity statement's figure; a trust's own distribution per unit before dividends over shares.
    """
    cash, equity, profit, eps = F.col("cf_dividends_paid"), F.col("eq_dividends"), F.col("is_pat_owners"), F.col("is_eps_basic")
    reported = F.when(F.col("is_weighted_avg_shares") > 0, F.col("is_weighted_avg_shares"))
    implied = F.try_divide(profit, eps / 100)
    implied = F.when(implied > 0, implied)
    rows = rows.withColumns({"dividends": F.coalesce(F.abs(cash), F.abs(equity)), "basis": F.when(cash.isNotNull(), "cash").when(equity.isNotNull(), "equity"), "shares": shares_in_issue(), "dpu": F.when(F.col("reit"), F.col("is_dpu"))})
    rows = rows.withColumn("dps_sen", F.coalesce("dpu", F.try_divide(F.col("dividends"), F.col("shares")) * 100))
    informed = F.col("dividends").isNotNull() | F.col("dps_sen").isNotNull()
    paid = F.when(informed, (F.coalesce("dividends", F.lit(0.0)) != 0) | (F.coalesce("dps_sen", F.lit(0.0)) != 0))
    both = F.col("dividends").isNotNull() & profit.isNotNull()
    payout = F.when(both, F.when(profit > 0, F.col("dividends") / profit)).otherwise(F.when(eps > 0, F.col("dpu") / eps))
    rows = rows.withColumns({"paid": paid, "payout": payout})
    own = Window.partitionBy("company_id").orderBy("fy")
    before = lambda c: F.lag(c).over(own)
    follows = before("fy") == F.col("fy") - 1
    growth = F.when(follows & (before("dps_sen") != 0), F.col("dps_sen") / before("dps_sen") - 1)
    ratio = F.when(follows & (before("shares") > 0), F.col("shares") / before("shares"))
    rows = rows.withColumns({"growth": growth, "share_ratio": ratio})
    flags = {
        "cash_inflow": cash > 0,
        "from_equity_statement": cash.isNull() & equity.isNotNull(),
        "shares_not_positive": F.col("is_weighted_avg_shares") <= 0,
        "shares_disagree": F.abs(implied - reported) / reported > SHARES_MISMATCH,
        "shares_implied": reported.isNull() & implied.isNotNull(),
        "paid_in_loss_year": both & (profit <= 0) & (F.col("dividends") > 0),
        "dps_above_eps": (eps > 0) & (F.col("dps_sen") > PAYOUT_FLAG * eps),
        "payout_implausible": F.col("payout") > PAYOUT_FLAG,
        "shares_jumped": (ratio > SHARE_JUMP) | (ratio < 1 / SHARE_JUMP),
        "growth_unusual": (growth < -0.9) | (growth > 10.0),
    }
    marks = F.array_compact(F.array(*(F.when(when, F.lit(name)) for name, when in flags.items())))
    return rows.withColumns({"cover": F.try_divide(F.lit(1.0), F.col("payout")), "flags": F.array_join(marks, ",")})


def dividend_history(years: DataFrame) -> DataFrame:
    """Per company: streak and the year it ends, longest_streak, median_payout over the streak, n_flags, last_dps_sen.

    The streak ends in the last year with any word of dividends and is 0 if nothing was paid then.
    """
    own = Window.partitionBy("company_id")
    rows = years.withColumns({"streak_end": F.max(F.when(F.col("paid").isNotNull(), F.col("fy"))).over(own), "run": F.when(F.col("paid"), F.col("fy") - F.row_number().over(Window.partitionBy("company_id", "paid").orderBy("fy")))})
    runs = rows.withColumns({"length": F.when(F.col("paid"), F.count("*").over(Window.partitionBy("company_id", "run"))), "run_end": F.when(F.col("paid"), F.max("fy").over(Window.partitionBy("company_id", "run")))})
    current = F.col("run_end") == F.col("streak_end")
    plausible = F.when(current & (F.col("payout") <= PAYOUT_FLAG), F.col("payout"))
    flags = F.when(F.col("flags") == "", 0).otherwise(F.size(F.split("flags", ",")))
    return runs.groupBy("company_id").agg(
        F.coalesce(F.max(F.when(current, F.col("length"))), F.lit(0)).alias("streak"), F.max("streak_end").alias("streak_end"), F.coalesce(F.max("length"), F.lit(0)).alias("longest_streak"),
        F.median(plausible).alias("median_payout"), F.sum(flags).alias("n_flags"), F.max_by(F.when(current, F.col("dps_sen")), F.when(current, F.col("fy"))).alias("last_dps_sen"),
    )


def dividend_screen(history: DataFrame, min_streak: int = 2, min_payout: float | None = None, max_payout: float | None = 1.0) -> DataFrame:
    """Companies whose streak and median payout keep within bounds; a bound that is given excludes those without a payout."""
    out = history.where(F.col("streak_end").isNotNull() & (F.col("streak") >= min_streak))
    if min_payout is not None:
        out = out.where(F.col("median_payout") >= min_payout)
    if max_payout is not None:
        out = out.where(F.col("median_payout") <= max_payout)
    return out
