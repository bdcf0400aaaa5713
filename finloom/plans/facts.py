"""The fact model over the supplied tables, as common table expressions that Spark and DuckDB both read.

company: suppliers with sector, market, profile and the month their fiscal year ends. line: one row per line item with its
company and fiscal year (named for the calendar year in which it ends) and whole cents, so that sums are exact. reported: annual
facts by reporting document; the original leaves returned lines out, the restated one, filed a year later, has all.
"""

from __future__ import annotations

TABLES = "region nation customer supplier part orders lineitem events documents pages labels benchmark conversations".split()

COMPANY = """
company as (
    select s_suppkey as company_id, s_name as name, r_name as sector,
        case s_suppkey % 4 when 0 then 12 when 1 then 3 when 2 then 6 else 9 end as fye,
        case when s_suppkey % 10 = 0 then 'LEAP' when s_suppkey % 10 < 3 then 'ACE' else 'MAIN' end as market,
        case when s_nationkey <= 1 then 'bank' when s_nationkey = 2 then 'insurance' when s_nationkey = 3 then 'reit' else 'general' end as profile
    from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
)"""
LINE = """
line as (
    select l_suppkey as company_id, fye, year(l_shipdate) + case when month(l_shipdate) > fye then 1 else 0 end as fy,
        (month(l_shipdate) - fye + 23) % 12 as month_no, l_returnflag as flag, l_linestatus as status,
        cast(floor(l_extendedprice * 100) as bigint) as price, cast(floor(l_extendedprice * (1 - l_discount) * 100) as bigint) as sold,
        cast(floor(l_extendedprice * 85) as bigint) as cost, cast(floor(l_extendedprice * l_tax * 100) as bigint) as tax
    from lineitem join company on l_suppkey = company_id
)"""
#: One wide row per company and year; money in units, NULL where the company doesn't report the concept that year.
ANNUAL = """
cents as (
    select company_id, fy, fye, sum(sold) as revenue, sum(cost) as cost, sum(tax) as tax, sum(case when status = 'O' then price else 0 end) as open_price,
        sum(price) as assets, sum(case when flag = 'R' then price else 0 end) as liabilities, sum(case when flag = 'A' then price else 0 end) as a_price
    from line group by company_id, fy, fye
), annual as (
    select company_id, fy, last_day(make_date(cast(fy as int), cast(fye as int), 1)) as period_end,
        cast(revenue as double) / 100 as revenue, cast(revenue - cost as double) / 100 as pbt, cast(-tax as double) / 100 as tax_expense,
        cast(revenue - cost - tax as double) / 100 as pat, case when (company_id + fy) % 6 <> 0 then cast(-open_price as double) / 5000 end as finance_costs,
        cast(assets as double) / 100 as total_assets, cast(liabilities as double) / 100 as liabilities, cast(assets - liabilities as double) / 100 as equity,
        case when (company_id + fy) % 7 <> 0 then case when (company_id * 3 + fy) % 5 = 0 then cast(0 as double) else cast(-a_price as double) / 4000 end end as dividends,
        cast(revenue - cost as double) / 125 as op_cash, cast(-assets as double) / 2500 as capex, cast(a_price as double) / 1000 as cash, cast(-liabilities as double) / 300 as borrowings,
        cast(1000000 + company_id * 1000 as double) as shares
    from cents
)"""
BASE = f"with {COMPANY}, {LINE}, {ANNUAL}"
#: Facts keyed by the document that reports them. Every ninth document has no filing date.
REPORTED = """
docs as (
    select company_id, fy, fye, 'original' as kind, (company_id * 100 + fy % 100) * 2 as doc_id, case when (company_id + fy) % 9 = 0 then cast(null as date) else last_day(make_date(cast(fy + 1 as int), 4, 1)) end as filed from cents
    union all
    select company_id, fy, fye, 'restated', (company_id * 100 + fy % 100) * 2 + 1, case when (company_id + fy) % 9 = 4 then cast(null as date) else last_day(make_date(cast(fy + 2 as int), 4, 1)) end from cents
), by_doc as (
    select company_id, fy, sum(case when flag <> 'R' then sold else 0 end) as rev_o, sum(sold) as rev_r, sum(case when flag <> 'R' then price else 0 end) as ast_o, sum(price) as ast_r from line group by company_id, fy
), reported as (
    select d.company_id, d.fy, d.doc_id, d.filed, c.concept, last_day(make_date(cast(d.fy as int), cast(d.fye as int), 1)) as hint,
        cast(case when c.concept = 'is.revenue' then case when kind = 'original' then rev_o else rev_r end else case when kind = 'original' then ast_o else ast_r end end as double) / 100 as value
    from docs d join by_doc b on d.company_id = b.company_id and d.fy = b.fy join (select 'is.revenue' as concept union all select 'bs.total_assets') c on 1 = 1
)"""


def median(x: str, d: str, q: float = 0.5) -> str:
    """Exact quantile, inclusive method."""
    return f"percentile({x}, {q})" if d == "spark" else f"quantile_cont({x}, {q})"


def months_after(date: str, n: str) -> str:
    """The end of the month n months after a date's, by arithmetic that both engines share."""
    at = f"(year({date}) * 12 + month({date}) - 1 + {n})"
    return f"last_day(make_date(cast(floor({at} / 12) as int), cast({at} % 12 + 1 as int), 1))"
