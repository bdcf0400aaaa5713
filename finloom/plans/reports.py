"""Pages of annual reports as text over the supplied tables: one report for each company and year, of nine pages.

Contents, highlights, income statement, two pages of financial position, cash flows, changes in equity, notes and a list of
properties; by company and year the second page of financial position is missing, the cash flows run over two pages, or the notes
bear no heading of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finloom.plans.book import WITH_BOOK, _views
from finloom.plans.stored import stored

#: Page and its lines; {0} to {3} are figures of the year. A bar ends a line.
PAGES = [
    (1, "CONTENTS|Revenue 10 11 12|Statement of financial position 20 21 22"),
    (2, "FIVE-YEAR FINANCIAL HIGHLIGHTS|Revenue {0} {1} {2}|Profit before tax {1} {2} {3}|Total assets {2} {3} {0}|Earnings per share 1 2 3"),
    (3, "STATEMENTS OF PROFIT OR LOSS|For the year|Revenue {0} {1}|Cost of sales {1} {2}|Gross profit {2} {1}|Profit before tax {1} {0}|Tax expense {3} {2}|Basic earnings per share 1.25 2.50"),
    (4, "STATEMENTS OF FINANCIAL POSITION|As at year end|Property, plant and equipment {2} {3}|Inventories {1} {1}|Trade receivables {1} {2}|Total assets {2} {2}"),
    (5, "As at year end (cont'd)|Share capital {1} {1}|Total equity {2} {1}|Borrowings {1} {3}|Total liabilities {3} {3}|Total equity and liabilities {2} {2}"),
    (6, "STATEMENTS OF CASH FLOWS|For the year|Net cash from operating activities {1} {2}|Net cash used in investing activities {1} {1}|Dividends paid {2} {2}|Net cash from financing activities {3} {1}"),
    (7, "Cash flows carried on|Effects of rates {1} {1}|Cash and cash equivalents at end of the year {2} {3}|Financing activities {1} {1}"),
    (8, "STATEMENTS OF CHANGES IN EQUITY|Share capital Retained earnings Total equity|At beginning {1} {2} {3}|Total comprehensive income {1} {1} {1}|Dividends paid {3} {3} {3}|At end of the year {2} {2} {2}"),
    (9, "NOTES TO THE FINANCIAL STATEMENTS|Revenue {0} {1}|Cost of sales {1} {1}|Gross profit {1} {1}|Profit before tax {1} {1}|Tax expense {1} {2}|Earnings per share 3 4"),
]


def _text(lines: str) -> str:
    """SQL for a page's text: figures in place of the numbered marks."""
    out = "'" + lines.replace("'", "''") + "'"
    for n in range(4):
        out = f"replace({out}, '{{{n}}}', f{n})"
    return f"replace({out}, '|', chr(10))"


REPORTS = f"""yearly as (
    select company_id * 10000 + fy as doc, (company_id * 3 + fy) % 4 as v, cast(cast(floor(is_revenue) as bigint) as varchar(20)) as f0, cast(cast(floor(cf_net_operating) as bigint) as varchar(20)) as f1,
        cast(cast(floor(bs_total_liabilities) as bigint) as varchar(20)) as f2, cast(cast(floor(bs_cash_and_equivalents) as bigint) as varchar(20)) as f3
    from book
), report as (
    select doc, p.no as page, v, case p.no {" ".join(f"when {no} then {_text(lines)}" for no, lines in PAGES)} end as text from yearly cross join (values {", ".join(f"({no})" for no, _ in PAGES)}) as p(no)
), pages as (
    select doc, page, case when v = 3 and page = 9 then replace(text, 'NOTES TO THE FINANCIAL STATEMENTS', 'Analysis by segment') else text end as text from report where not (v = 1 and page = 5) and not (v = 2 and page = 7)
)"""
WITH_REPORTS = f"{WITH_BOOK}, {REPORTS}"


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, page, text."""
    _views(spark, sf_dir, "supplier", "nation", "region", "lineitem")
    return stored(spark.sql(f"{WITH_REPORTS} select doc, page, text from pages"), "report-pages")
