"""Statements of changes in equity on hand-made pages: blocks, chains, total columns and what is refused."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from finloom.functions import balances
from finloom.operators import equity

LINES = "doc_id long, row_no int, label string, concept string, figures array<double>"
HEADS = "doc_id long, company_id int, fye int, header string, headers array<string>"
HEADER = "CONSOLIDATED STATEMENT OF CHANGES IN EQUITY\nFOR THE FINANCIAL YEAR ENDED 31 DECEMBER 2024\nRM'000"
WIDE, PLAIN = ["Share capital", "Retained earnings", "Total", "Non-controlling interests", "Total equity"], ["Share capital", "Retained earnings", "Total equity"]


def wide(total):
    return [100.0, total - 110.0, total - 10.0, 10.0, float(total)]


def plain(total):
    return [100.0, total - 100.0, float(total)]


TWO_YEARS = [("At 1 January 2023", 500), ("Profit for the year", 80), ("Dividends to owners of the Company", -20), ("At 31 December 2023", 560), ("Net loss for the financial year", -60), ("Purchase of treasury shares", -5), ("Dividend paid 23", -10), ("Dividends paid to non-controlling interests", -2), ("At 31 December 2024", 483)]
CASES = {
    "two years": (TWO_YEARS, HEADER, WIDE, wide),
    "combined row": ([*TWO_YEARS[:3], ("At 31 December 2023/1 January 2024", 560), *TWO_YEARS[4:]], HEADER, WIDE, wide),
    "broken chain": ([*TWO_YEARS[:4], ("Balance as at 1 January 2024", 561), *TWO_YEARS[4:]], HEADER, WIDE, wide),
    "restated opening": ([("At 1 January 2023, as previously reported", 510), ("Prior year adjustment", -10), *TWO_YEARS], HEADER, WIDE, wide),
    "no closing": (TWO_YEARS[:-1], HEADER, WIDE, wide),
    "off the boundary": ([("At 1 February 2023", 500), *TWO_YEARS[1:]], HEADER, WIDE, wide),
    "second matrix": ([*TWO_YEARS, ("At 1 January 2023", 50), ("Profit for the year", 1), ("At 31 December 2023", 51)], HEADER, WIDE, wide),
    "two profits": ([("At 1 January 2024", 5), ("Profit for the year", 1), ("Loss for the year", -1), ("At 31 December 2024", 5)], HEADER, WIDE, wide),
    "lost headings": (TWO_YEARS, HEADER, ["RM", "RM", "RM"], plain),
    "lost headings that don't add up": (TWO_YEARS, HEADER, ["RM", "RM", "RM"], lambda t: [100.0, 7.0, float(t)]),
    "two totals": (TWO_YEARS, HEADER, ["Total equity", "Reserves", "Total equity"], plain),
    "total left of others": (TWO_YEARS, HEADER, ["Total equity", "Reserves", "Non-controlling interests"], plain),
    "wrong attributable": (TWO_YEARS, HEADER, WIDE, lambda t: [100.0, t - 110.0, t - 13.0, 10.0, float(t)]),
    "nobody's": (TWO_YEARS, HEADER.replace("CONSOLIDATED ", ""), PLAIN, plain),
    "company": (TWO_YEARS, HEADER.replace("CONSOLIDATED", "Alpha Group Berhad") + "\nThe Company", PLAIN, plain),
    "notes": (TWO_YEARS, HEADER.replace("CHANGES IN EQUITY", "CASH FLOWS"), WIDE, wide),
    "no unit": (TWO_YEARS, HEADER.replace("RM'000", ""), WIDE, wide),
    "interim": (TWO_YEARS, HEADER.replace("FINANCIAL YEAR", "SIX MONTHS"), WIDE, wide),
    "closes in a row": ([("At 31 December 2020", 1), ("At 31 December 2023", 560), *TWO_YEARS[4:]], HEADER, WIDE, wide),
    "three closes in a row": ([("At 31 December 2018", 1), ("At 31 December 2020", 1), ("At 31 December 2023", 560), *TWO_YEARS[4:]], HEADER, WIDE, wide),
    "undated": ([("Opening", 5, balances.OPENING), ("Profit for the year", 1), ("Closing", 6, balances.CLOSING)], HEADER, WIDE, wide),
    "no subtitle": (TWO_YEARS, HEADER.replace("ENDED 31 DECEMBER 2024", ""), WIDE, wide),
}


@pytest.fixture(scope="module")
def pages(spark):
    lines = [(n, i, row[0], row[2] if len(row) > 2 else None, figures(row[1])) for n, (rows, _, _, figures) in enumerate(CASES.values()) for i, row in enumerate(rows)]
    heads = [(n, 7, 12, header, headers) for n, (_, header, headers, _) in enumerate(CASES.values())]
    return spark.createDataFrame(lines, LINES), spark.createDataFrame([*heads, (99, 7, 12, HEADER, PLAIN)], HEADS)


def test_facts_of_blocks(pages):
    got = {}
    for r in equity.equity_facts(*pages).collect():
        got.setdefault(list(CASES)[r.doc_id], {})[(r.fiscal_year, r.concept.removeprefix("eq."))] = r.value / 1000
    first = {(2023, "opening_balance"): 500, (2023, "profit_for_year"): 80, (2023, "dividends"): -20, (2023, "closing_balance"): 560}
    second = {(2024, "opening_balance"): 560, (2024, "profit_for_year"): -60, (2024, "share_buyback"): -5, (2024, "dividends"): -12, (2024, "closing_balance"): 483}
    both = {**first, **second}
    assert got == {
        "two years": both, "combined row": both, "broken chain": first, "restated opening": both, "no closing": first, "second matrix": both, "lost headings": both, "company": both, "no subtitle": both,
        "two profits": {(2024, "opening_balance"): 5, (2024, "closing_balance"): 5}, "three closes in a row": second, "undated": {(2024, "opening_balance"): 5, (2024, "profit_for_year"): 1, (2024, "closing_balance"): 6},
    }


def test_periods_bases_and_columns(pages):
    rows = {(r.fiscal_year, r.concept): r for r in equity.equity_facts(*pages).where("doc_id = 0").collect()}
    opening, closing, profit = (rows[2023, f"eq.{c}"] for c in ("opening_balance", "closing_balance", "profit_for_year"))
    assert (opening.instant, closing.instant, profit.instant) == (dt.date(2023, 1, 1), dt.date(2023, 12, 31), None)
    assert (profit.period_start, profit.period_end, profit.basis, profit.col, rows[2024, "eq.dividends"].n_rows) == (dt.date(2023, 1, 1), dt.date(2023, 12, 31), "CONSOLIDATED", 4, 2)
    assert {r.basis for r in equity.equity_facts(*pages).where(F.col("doc_id") == list(CASES).index("company")).collect()} == {"COMPANY"}


def test_refusals_name_their_reason(pages):
    got = {list(CASES)[r.doc_id] if r.doc_id < 99 else "no lines": r.reason for r in equity.refusals(*pages).collect()}
    assert got == {
        "broken chain": "blocks do not chain", "off the boundary": "a balance is not dated on the ends of the fiscal year", "lost headings that don't add up": "no one column of total equity",
        "two totals": "several columns of total equity", "total left of others": "total equity stands left of others' share", "wrong attributable": "attributable and others' share are not the total",
        "nobody's": "names neither group nor company", "notes": "no heading of changes in equity", "no unit": "no unit", "interim": "not a year", "no lines": "no rows", "closes in a row": "no complete block of the statement's years",
    }


def test_labels(spark):
    labels = {
        "Profit for the year": "profit_for_year", "(Loss)/profit after tax": "profit_for_year", "Total comprehensive (loss)/income for the year": "total_comprehensive_income", "Total comprehensive loss": "total_comprehensive_income",
        "Other comprehensive income, net of tax": "other_comprehensive_income", "Issuance of new ordinary shares": "issuance_of_shares", "Issue of shares by a subsidiary": None, "Purchase of own shares": "share_buyback",
        "Treasury shares acquired": "share_buyback", "Share-based payment transactions": "share_based_payments", "Transfer to legal reserve": "transfer_to_reserves", "Transfers from reserves": "transfer_to_reserves",
        "Acquisition of additional interest in a subsidiary": "changes_in_nci", "Changes in ownership interests in subsidiaries": "changes_in_nci", "(a) Final dividend for 2023 (Note 9)": "dividends",
        "Dividend reinvestment plan": None, "Distribution to unitholders": "dividends", "Revaluation of land": None, "": None, None: None,
    }
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, x string")
    got = [r[0] for r in frame.orderBy("i").select(balances.movement_of(F.col("x"))).collect()]
    assert got == [None if v is None else f"eq.{v}" for v in labels.values()]
    ends = {"At 1 January 2024": True, "Balance as at 31.12.2023": True, "31 December 2023": True, "As at January 2023": True, "Net assets at end": True, "Total equity of the Group": True, "Profit for the year 2023": False, "Transfer at cost": False, None: False}
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(ends)], "i int, x string")
    assert [r[0] for r in frame.orderBy("i").select(balances.is_balance(F.col("x"))).collect()] == list(ends.values())


def test_tasks_grow_with_statements_and_rows_carry_no_header(spark, monkeypatch):
    pages = 2 * spark.sparkContext.defaultParallelism
    heads = spark.createDataFrame([(d, 7, 12, HEADER, WIDE) for d in range(pages)], HEADS)
    lines = spark.createDataFrame([(d, i, label, None, wide(total)) for d in range(pages) for i, (label, total) in enumerate(TWO_YEARS)], LINES)
    before = sorted(map(tuple, equity.equity_facts(lines, heads).collect()), key=str)
    monkeypatch.setattr(equity, "STATEMENTS_PER_TASK", 1)
    dealt = equity._dealt(lines, heads)
    assert [df.rdd.getNumPartitions() for df in dealt] == [pages, pages] and not {"header", "headers"} & set(dealt[1].columns)
    assert before and sorted(map(tuple, equity.equity_facts(lines, heads).collect()), key=str) == before
