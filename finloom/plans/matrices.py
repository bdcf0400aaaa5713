"""Printed statements of changes in equity over the supplied tables: one for each company and year with two years before it.

A statement shows two year blocks, the year before and its own. Of thirteen kinds, by company and year, eleven depart from the plain
form: a combined or missing opening row, undated balances, a broken chain, a second profit row, no heading, columns that don't add
up, an interim header, a date off the year's ends, lost column headings, a missing closing row, and a company's own statement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions.numbers import parse_number
from finloom.plans.book import WITH_BOOK, _views

MONTH_NAMES = "January February March April May June July August September October November December".split()
_MONTHS = "month_name as (select * from (values " + ", ".join(f"({i}, '{m}')" for i, m in enumerate(MONTH_NAMES, 1)) + ") as t(no, name))"


def _thousands(cents: str) -> str:
    return f"cast(floor({cents} / 1e5) as bigint)"


def _printed(x: str) -> str:
    return f"case when {x} < 0 then '(' || cast(-({x}) as varchar(20)) || ')' else cast({x} as varchar(20)) end"


#: v: the kind; e0 to e2: equity at the ends of three years, in thousands; p and d: profit and dividends of two years.
YEARS = f"""three as (
    select company_id, fy, fye, equity, pat, a_price, lag(fy, 2) over (partition by company_id order by fy) as fy_o, lag(equity, 2) over (partition by company_id order by fy) as equity_o,
        lag(equity) over (partition by company_id order by fy) as equity_p, lag(pat) over (partition by company_id order by fy) as pat_p, lag(a_price) over (partition by company_id order by fy) as a_price_p
    from parts
), years as (
    select company_id * 10000 + fy as doc_id, company_id, fy, fye, (company_id * 7 + fy) % 13 as v, company_id % 3 = 0 as group_has_nci,
        {_thousands("equity_o")} as e0, {_thousands("equity_p")} as e1, {_thousands("equity")} as e2, {_thousands("pat_p")} as p1, {_thousands("pat")} as p2,
        {_thousands("a_price_p * 0.02")} as d1, {_thousands("a_price * 0.02")} as d2
    from three where fy_o = fy - 2
)"""


def _end(year: str) -> str:
    """'31 December 1996', the last day of a fiscal year."""
    return f"cast(day(last_day(make_date(cast({year} as int), cast(fye as int), 1))) as varchar(2)) || ' ' || m.name || ' ' || cast({year} as varchar(4))"


def _start(year: str) -> str:
    """'1 January 1996', the first day of a fiscal year."""
    return f"'1 ' || s.name || ' ' || cast({year} - case when fye = 12 then 0 else 1 end as varchar(4))"


#: Row number, label, concept, figure of total equity, and for which kinds the row is printed.
ROWS = [
    (1, f"'At ' || {_start('(fy - 1)')}", "null", "e0", "v <> 4"),
    (2, "'Profit for the year'", "null", "p1", "v <> 4"),
    (3, "'Dividends paid to owners of the Company 23'", "null", "-d1", "v <> 4"),
    (4, "'Other comprehensive income for the year, net of tax'", "null", "e1 - e0 - p1 + d1", "v <> 4"),
    (5, f"case v when 2 then 'At ' || {_end('(fy - 1)')} || '/' || {_start('fy')} when 10 then 'At 15 ' || s.name || ' 1990' else 'At ' || {_end('(fy - 1)')} end", "null", "e1", "v <> 4"),
    (6, f"case when v = 4 then 'Balance at beginning of year' else 'Balance as at ' || {_start('fy')} end", "case when v = 4 then 'eq.opening_balance' end", "e1 + case when v = 5 then 7 else 0 end", "v not in (2, 3)"),
    (7, "'(Loss)/profit for the financial year'", "null", "p2", "true"),
    (8, "'Final dividend paid'", "null", "-d2", "true"),
    (9, "'Interim single-tier dividends'", "null", "-1", "true"),
    (10, "'Profit after tax'", "null", "11", "v = 6"),
    (11, "'Other comprehensive loss'", "null", "e2 - e1 - p2 + d2 + 1 - case when v = 6 then 11 else 0 end", "true"),
    (12, f"case when v = 4 then 'Balance at end of year' else 'At ' || {_end('fy')} end", "case when v = 4 then 'eq.closing_balance' end", "e2", "v <> 12"),
]
_CASES = {name: "case n.no " + " ".join(f"when {row[0]} then {row[i]}" for row in ROWS) + " end" for i, name in ((1, "label"), (2, "concept"), (3, "figure"), (4, "printed"))}
_CELLS = {"capital": "1000", "retained": "figure - 1000 - nci", "attributable": "figure - nci + case when v = 8 then 5 else 0 end", "others": "nci", "total": "figure"}
LINES = f"""numbered as (
    select doc_id, n.no as row_no, {_CASES["label"]} as label, cast({_CASES["concept"]} as varchar(30)) as concept, {_CASES["figure"]} as figure, {_CASES["printed"]} as printed, v, group_has_nci
    from years join month_name m on m.no = fye join month_name s on s.no = fye % 12 + 1 cross join (values {", ".join(f"({row[0]})" for row in ROWS)}) as n(no)
), lines as (
    select doc_id, row_no, label, concept, v, group_has_nci, {", ".join(f"{_printed(x)} as {c}" for c, x in _CELLS.items())}
    from (select *, case when group_has_nci then cast(floor(figure / 10.0) as bigint) else 0 end as nci from numbered where printed) w
)"""
HEADS = f"""heads as (
    select doc_id, company_id, cast(case when v % 2 = 0 then fye end as int) as fye, v, group_has_nci,
        case when v = 7 then 'NOTES TO THE ACCOUNTS' else 'STATEMENTS OF CHANGES IN EQUITY' end || chr(10) || case when v = 9 then 'For the three months ended ' else 'For the financial year ended ' end || {_end('fy')}
            || chr(10) || case when v = 0 then 'The Company' else 'Group' end || chr(10) || 'RM''000' as header
    from years join month_name m on m.no = fye
)"""
WITH_MATRICES = f"{WITH_BOOK}, {_MONTHS}, {YEARS}, {LINES}, {HEADS}"
NAMES = ["Share capital", "Retained earnings", "Total", "Non-controlling interests", "Total equity"]


def statement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, row_no, label, concept, figures: the printed cells as numbers, by column."""
    _views(spark, sf_dir, "supplier", "nation", "region", "lineitem")
    rows = spark.sql(f"{WITH_MATRICES} select * from lines")
    printed = F.when(F.col("group_has_nci"), F.array("capital", "retained", "attributable", "others", "total")).otherwise(F.array("capital", "retained", "total"))
    return rows.select("doc_id", "row_no", "label", "concept", F.transform(printed, lambda c: parse_number(c).cast("double")).alias("figures"))


def statement_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, company_id, fye, header, headers."""
    _views(spark, sf_dir, "supplier", "nation", "region", "lineitem")
    lost = lambda names: F.when(F.col("v") == 11, F.array(*(F.lit("RM") for _ in names))).otherwise(F.array(*map(F.lit, names)))
    headers = F.when(F.col("group_has_nci"), lost(NAMES)).otherwise(lost([NAMES[0], NAMES[1], NAMES[4]]))
    return spark.sql(f"{WITH_MATRICES} select * from heads").select("doc_id", "company_id", "fye", "header", headers.alias("headers"))
