"""Blocks of pages, columns and five-year summaries on hand-made words."""

import pytest
from pyspark.sql import functions as F

from finloom.operators import five_year, layout, page_tables

WORDS = "doc long, page int, word_id int, text string, x0 double, x1 double, y0 double, y1 double"


def laid(doc, page, lines, start=0):
    """Words of lines: (y, [(x0, text)]), five points a letter; figures are given by their right edge as (None, x1, text)."""
    out = []
    for y, parts in lines:
        for part in parts:
            texts = [part] if part[0] is None else [(x, w) for x, w in spread(*part)]
            for one in texts:
                x0, x1, text = (one[1] - 5.0 * len(one[2]), float(one[1]), one[2]) if one[0] is None else (float(one[0]), one[0] + 5.0 * len(one[1]), one[1])
                out.append((doc, page, start + len(out), text, x0, x1, float(y), y + 10.0))
    return out


def spread(x, text):
    for word in text.split():
        yield x, word
        x += 5 * len(word) + 3


def figures(*texts):
    return [(None, 260 + 70 * i, t) for i, t in enumerate(texts)]


PANELS = [(0, [(40, "Statement of cash flows for the whole of the year that ended in December and more words")])] + [(20 * i, [(40, "Operating item"), (None, 200, f"{i}1"), (400, "Investing item"), (None, 560, f"{i}2")]) for i in range(1, 6)]
PLAIN = [(20 * i, [(40, "Some label"), *figures(f"{i}1", f"{i}2")]) for i in range(1, 7)]
UNEVEN = [(20 * i, [(40, "Left label"), (None, 200, str(i))]) for i in range(1, 6)] + [(20 * i + 7, [(400, "Right label"), (None, 560, str(i))]) for i in range(1, 6)]
WIDE = [(20 * i, [(40, "Left label"), (None, 300, str(i)), (760, "Right label"), (None, 1000, str(i))]) for i in range(1, 4)]


@pytest.fixture(scope="module")
def placed(spark):
    rows = laid(1, 1, PANELS) + laid(2, 1, PLAIN) + laid(3, 1, UNEVEN) + laid(4, 2, WIDE) + laid(5, 1, [(0, [(40, "alone")])])
    words = spark.createDataFrame(rows, WORDS)
    pages = spark.createDataFrame([(1, 1, 600.0), (2, 1, 600.0), (3, 1, 600.0), (4, 1, 600.0), (4, 2, 1200.0), (5, 1, 600.0)], "doc long, page int, width double")
    return page_tables.blocks(words, pages).cache()


def said(placed, doc):
    out = {}
    for r in placed.where(F.col("doc") == doc).orderBy("x0", "word_id").collect():
        out.setdefault((r.half, r.block, r.row_no), []).append(r.text)
    return {k: " ".join(v) for k, v in out.items()}


def test_two_panels_below_a_title(placed):
    got = said(placed, 1)
    assert got[0, 0, 0].startswith("Statement of cash flows for the whole")
    assert got[0, 1, 0] == "Operating item 11" and got[0, 2, 4] == "Investing item 52" and len(got) == 11


def test_labels_and_figures_are_one_block(placed):
    assert said(placed, 2) == {(0, 0, i - 1): f"Some label {i}1 {i}2" for i in range(1, 7)}
    assert said(placed, 5) == {(0, 0, 0): "alone"}


def test_panels_that_do_not_stand_level(placed):
    got = said(placed, 3)
    assert {k[1] for k in got} <= {0, 1, 2} and sum(len(v.split()) for v in got.values()) == 30


def test_spreads_are_cut_in_the_middle(placed):
    got = said(placed, 4)
    assert got == {**{(1, 0, i - 1): f"Left label {i}" for i in range(1, 4)}, **{(2, 0, i - 1): f"Right label {i}" for i in range(1, 4)}}


SUMMARY = [
    (0, [(40, "Group Financial Highlights (RM million)")]), (20, [(40, "Year ended"), *figures("FY2024", "2023*", "2022", "2021", "2020")]), (40, [(40, "Turnover"), *figures("1.5", "2", "3", "(4)", "-")]),
    (60, [(40, "Profit attributable to")]), (80, [(40, "owners of the Company"), *figures("10", "20", "30", "40", "50")]), (100, [(40, "Earnings per share (sen)"), *figures("1.25", "2", "3", "4", "5")]),
    (120, [(40, "Net assets per share (sen)"), *figures("150", "200", "300", "400", "500")]), (140, [(40, "Total assets (RM'000)"), *figures("7", "8", "9", "10", "11")]), (160, [(40, "Number of employees"), *figures("7", "8", "9", "10", "11")]),
    (180, [(40, "Revenue"), *figures("9", "9", "9", "9", "9")]),
]


def test_summary_values(spark):
    words = spark.createDataFrame(laid(1, 1, SUMMARY), WORDS)
    pages = spark.createDataFrame([(1, 1, 700.0)], "doc long, page int, width double")
    rows = page_tables.cells(page_tables.blocks(words, pages), five_year.is_figure(F.col("text")))
    got = {(r.concept, r.fiscal_year): r.value for r in five_year.summary_values(rows).collect()}
    years = range(2024, 2019, -1)
    want = {("is.revenue", 2024): 1.5e6, ("is.revenue", 2023): 2e6, ("is.revenue", 2022): 3e6, ("is.revenue", 2021): -4e6, ("is.revenue", 2020): 9e6}
    want |= {("is.pat_owners", y): 1e7 * (i + 1) for i, y in enumerate(years)} | {("is.eps_basic", y): v for y, v in zip(years, (1.25, 2, 3, 4, 5))}
    want |= {("bs.nta_per_share", y): v for y, v in zip(years, (1.5, 2, 3, 4, 5))} | {("bs.total_assets", y): 1000.0 * v for y, v in zip(years, (7, 8, 9, 10, 11))}
    assert got == pytest.approx(want)


def test_year_headings(spark):
    texts = ["2021", "FY2021", "FYE 31.3.2025", "2021*", "2021 (Restated)", "2025/26", "1,999", "1899", "20215", "", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in frame.orderBy("i").select(five_year.year_of(F.col("t"))).collect()] == [2021, 2021, 2025, 2021, 2021, 2026, None, None, None, None, None]


def test_words_keep_their_columns_through_the_sweep(spark):
    """Rows are found with the words' columns at hand: one shuffle and no join."""
    words = spark.createDataFrame(laid(1, 1, PLAIN), WORDS).withColumn("half", F.lit(0))
    swept = layout.with_rows(words, page_tables.PAGE)
    plan = swept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
    assert sorted(swept.columns) == sorted([*words.columns, "row_no"])
    assert {(r.word_id, r.text, r.row_no) for r in swept.collect()} == {(r.word_id, r.text, int(r.y0 // 20) - 1) for r in words.collect()}
