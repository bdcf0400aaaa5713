"""Annual books over the supplied tables: one wide row per company and year with the concepts of four statements.

The one adapter between the supplied tables and the operators: these take any frame of this shape (company_id, fy, period_end and
a column per concept, named as the concept with _ for the dot, null where it isn't reported). Figures that must disagree now and
then (a subtotal, a sign, a share count) do so by rules of company and year, so that checks find something.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finloom.plans.facts import COMPANY, LINE

CENTS = """
cents as (
    select company_id, fy, fye, sum(sold) as revenue, sum(cost) as cost, sum(tax) as tax, sum(case when status = 'O' then price else 0 end) as open_price,
        sum(price) as assets, sum(case when flag = 'R' then price else 0 end) as liabilities, sum(case when flag = 'A' then price else 0 end) as a_price
    from line group by company_id, fy, fye
), parts as (
    select *, company_id + fy as k, revenue - cost as pbt, revenue - cost - tax as pat, assets - liabilities as equity, 1000000 + company_id * 1000 as shares,
        cast(floor(cost * 0.8) as bigint) as cos, cast(floor(assets * 0.6) as bigint) as nca, cast(floor(liabilities * 0.7) as bigint) as ncl,
        case when company_id % 3 = 0 then cast(floor((revenue - cost - tax) * 0.1) as bigint) end as nci_pat,
        case when company_id % 3 = 0 then cast(floor((assets - liabilities) * 0.1) as bigint) end as nci,
        cast(floor(liabilities * 0.2) as bigint) as lt_debt, cast(floor(liabilities * 0.13) as bigint) as st_debt
    from cents
)"""
#: Concept and its figure in hundredths, over parts.
MONEY = {
    "is_revenue": "revenue",
    "is_cost_of_sales": "case when company_id % 2 = 0 then -cos else cos end",
    "is_gross_profit": "revenue - cos + case when k % 11 = 0 then 500000 else 0 end",
    "is_operating_profit": "pbt + cast(floor(open_price * 0.02) as bigint)",
    "is_finance_costs": "case when k % 6 <> 0 then -cast(floor(open_price * 0.02) as bigint) end",
    "is_profit_before_tax": "case when k % 13 <> 0 then pbt end",
    "is_tax_expense": "-tax",
    "is_profit_for_period": "case when k % 16 <> 5 then pat end",
    "is_pat_owners": "case when k % 5 = 0 then null when k % 53 = 0 then pat * 3 else pat - coalesce(nci_pat, 0) end",
    "is_pat_nci": "nci_pat",
    "is_depreciation_amortisation": "case when company_id % 2 = 1 then -cast(floor(assets * 0.04) as bigint) end",
    "bs_total_assets": "case when k % 8 <> 3 then assets end",
    "bs_total_non_current_assets": "nca",
    "bs_total_current_assets": "assets - nca + case when k % 17 = 0 then 90000 else 0 end",
    "bs_total_liabilities": "liabilities",
    "bs_total_non_current_liabilities": "ncl",
    "bs_total_current_liabilities": "liabilities - ncl",
    "bs_total_equity": "case when k % 7 <> 1 then equity end",
    "bs_equity_owners": "case when k % 9 <> 0 then equity - coalesce(nci, 0) end",
    "bs_nci": "nci",
    "bs_total_equity_and_liabilities": "case when k % 2 = 0 then assets + case when k % 23 = 0 then 1000 else 0 end end",
    "bs_borrowings_total": "case when company_id % 3 <> 2 then -(lt_debt + st_debt) end",
    "bs_lt_borrowings": "case when company_id % 5 <> 0 then -lt_debt end",
    "bs_st_borrowings": "-st_debt",
    "bs_cash_and_equivalents": "cast(floor(a_price * 0.1) as bigint)",
    "cf_profit_before_tax": "pbt",
    "cf_operating_before_wc": "case when k % 7 <> 2 then pbt + cast(floor(assets * 0.03) as bigint) - case when k % 10 = 0 then assets else 0 end end",
    "cf_changes_in_inventories": "-cast(floor(assets * 0.01) as bigint)",
    "cf_changes_in_receivables": "cast(floor(assets * 0.005) as bigint)",
    "cf_changes_in_payables": "case when company_id % 2 = 0 then cast(floor(liabilities * 0.02) as bigint) end",
    "cf_working_capital_changes": "case when company_id % 3 <> 1 then cast(floor(assets * 0.007) as bigint) end",
    "cf_net_operating": "cast(floor((revenue - cost) * 0.8) as bigint)",
    "cf_purchase_of_ppe": "case when k % 12 <> 7 then -cast(floor(assets * 0.04) as bigint) end",
    "cf_net_investing": "-cast(floor(assets * 0.05) as bigint)",
    "cf_net_financing": "cast(floor(assets * 0.01) as bigint)",
    "cf_net_change_in_cash": "cast(floor((revenue - cost) * 0.8) as bigint) - cast(floor(assets * 0.05) as bigint) + cast(floor(assets * 0.01) as bigint) + case when k % 14 = 0 then 777 else 0 end",
    "cf_cash_beginning": "cast(floor(a_price * 0.1) as bigint) - 5000000",
    "cf_forex_effect": "case when k % 3 = 0 then 12345 end",
    "cf_cash_end": "cast(floor(a_price * 0.1) as bigint) - 5000000 + cast(floor((revenue - cost) * 0.8) as bigint) - cast(floor(assets * 0.05) as bigint) + cast(floor(assets * 0.01) as bigint) + case when k % 3 = 0 then 12345 else 0 end",
    "cf_dividends_paid": "case when k % 7 = 0 then null when (company_id * 3 + fy) % 5 = 0 then 0 when k % 19 = 0 then cast(floor(a_price * 0.025) as bigint) else -cast(floor(a_price * 0.025) as bigint) end",
    "eq_opening_balance": "equity - pat",
    "eq_closing_balance": "equity + case when k % 20 = 0 then 333333 else 0 end",
    "eq_dividends": "case when company_id % 2 = 0 then -cast(floor(a_price * 0.02) as bigint) end",
}
#: Concepts in units of their own.
PER_SHARE = {
    "is_eps_basic": "case when k % 18 = 4 then 0e0 else floor((pat - coalesce(nci_pat, 0)) * 1e2 / shares) / 1e2 end",
    "is_weighted_avg_shares": "case when company_id % 97 = 0 then -1e0 when company_id % 4 <> 1 then shares * case when company_id % 31 = 0 then 1e1 else 1e0 end * case when company_id % 6 = 0 and fy >= 1996 then 2e0 else 1e0 end end",
    "is_dpu": "case when company_id % 25 = 3 then floor(a_price * 3e0 / shares) / 1e2 end",
    "bs_nta_per_share": "equity * 1e0 / shares / 100",
}
CONCEPTS = [*MONEY, *PER_SHARE]
#: Every twelfth company's year of 1995 is an interim one that ends eight months early.
PERIOD_END = "case when company_id % 12 = 5 and fy = 1995 then last_day(make_date(cast(fy as int), cast(fye as int), 1) - interval 8 month) else last_day(make_date(cast(fy as int), cast(fye as int), 1)) end"
BOOK = (
    CENTS
    + f", book as (select company_id, fy, cast({PERIOD_END} as date) as period_end, "
    + ", ".join([*(f"cast({x} as double) / 100 as {c}" for c, x in MONEY.items()), *(f"cast({x} as double) as {c}" for c, x in PER_SHARE.items())])
    + " from parts)"
)
#: What the other engine reads.
WITH_BOOK = f"with {COMPANY}, {LINE}, {BOOK}"


def _views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """company_id, name, sector, fye, market, profile."""
    _views(spark, sf_dir, "supplier", "nation", "region")
    return spark.sql(f"with {COMPANY} select * from company")


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "supplier", "nation", "region", "lineitem")
    return spark.sql(f"{WITH_BOOK} select * from book")
