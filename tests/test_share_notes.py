"""Notes on earnings per share: printed examples, roles of rows, and columns that meet by year or by a figure of their own."""

from finloom.operators import share_notes

LINES, COLUMNS = "doc int, row_no int, label string, cells array<string>", "doc int, col int, year int, basis string, header string, scale int"
FACE = "doc int, col int, year int, basis string, eps double, places int, patami double"
PROFIT, EPS = "Profit attributable to owners of the Company", ("Basic earnings per share (sen)", ["2.45", "1.45"])
YEARS = [(0, 2024, None), (1, 2023, None)]


def counts(spark, rows, header="RM'000", face=(), columns=YEARS):
    lines = spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], LINES)
    cols = spark.createDataFrame([(1, *c, header, 1) for c in columns], COLUMNS)
    return share_notes.share_counts(lines, cols, spark.createDataFrame(list(face), FACE)).orderBy("col").collect()


def test_units_and_arithmetic(spark):
    cur, prior = counts(spark, [(PROFIT, ["9,845", "5,820"]), ("Weighted average number of ordinary shares in issue ('000)", ["401,837", "401,379"]), EPS])
    assert (cur.year, cur.shares, cur.multiplier, cur.stated, cur.patami, cur.eps, cur.proved, prior.proved) == (2024, 401_837_000, 1000, True, 9_845_000, 2.45, True, True)
    cur, _ = counts(spark, [(PROFIT, ["9,845,000", "5,820,000"]), ("Weighted average number of ordinary", []), ("shares in issue", ["401,837,000", "401,379,000"]), EPS], "RM")
    assert (cur.shares, cur.multiplier, cur.stated, cur.proved) == (401_837_000, 1, False, True)
    rows = [(PROFIT, ["9,845", "5,820"]), ("Number of ordinary shares in issue at 1 January (million)", ["390.0", "390.0"]), ("Effect of shares issued (million)", ["11.8", "11.4"]), ("Weighted average number of ordinary shares (million)", ["401.8", "401.4"]), EPS]
    cur, _ = counts(spark, rows)
    assert (cur.shares, cur.multiplier, cur.proved) == (401_800_000, 1_000_000, True)
    # No profit in the note: the statement's; none at all: the first plausible count, unproved. In ringgit: times 100.
    bare = [("Weighted average number of shares", ["401,837", "401,379"]), ("Basic earnings per share (RM)", ["0.0245", "0.0145"])]
    cur, prior = counts(spark, bare, "", [(1, 0, 2024, None, 2.45, 2, 9_845_000.0)])
    assert (round(cur.eps, 6), cur.multiplier, cur.proved, prior.multiplier, prior.proved) == (2.45, 1000, True, 1000, False)
    assert counts(spark, [("Weighted average number of shares", ["401,837"]), ("Basic earnings per share", ["9,999"])]) == []
    assert counts(spark, [(PROFIT, ["1"]), EPS]) == [] and counts(spark, []) == []


def test_counts_that_look_like_years(spark):
    label = "Weighted average number of ordinary shares in issue ('000)"
    got = counts(spark, [(PROFIT, ["48.6", "28.8"]), (label, ["1985", "1985"]), EPS])
    assert [(r.shares, r.multiplier, r.proved) for r in got] == [(1_985_000.0, 1000, True), (1_985_000.0, 1000, True)]
    got = counts(spark, [(PROFIT, ["49", "29"]), (label, ["2024", "2023"]), ("Weighted average number of shares ('000)", ["1,999", "1,998"]), EPS])
    assert [r.shares for r in got] == [1_999_000.0, 1_998_000.0]


def test_millions_are_exact(spark):
    got = counts(spark, [("Weighted average number of ordinary shares (million)", ["1.027", "4.054"]), EPS])
    assert [r.shares for r in got] == [1_027_000.0, 4_054_000.0]


def test_roles(spark):
    rows = [
        ("Basic earnings per share", []), ("Profit after taxation", ["5"]), ("Profit from continuing operations attributable to owners", ["4"]),
        ("Number of ordinary shares in issue", []), ("At 1 January", ["7"]), ("Effect of new shares", ["1"]), ("Total", ["8"]),
        ("The calculation divides by the weighted average number of units.", []), ("Sundry", ["1"]), ("Diluted earnings per share (sen)", ["2"]), ("Basic and diluted EPS", ["2"]),
        ("2024", ["2024", "2023"]), ("Diluted weighted average number of shares", ["3"]), ("Revenue", []), ("Earnings per", []), ("share (sen)", ["-"]),
    ]
    got = share_notes.roles(spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], LINES)).orderBy("row_no").collect()
    want = [(1, "patami"), (2, None), (4, "shares"), (5, None), (6, "shares"), (8, None), (9, "eps_diluted"), (10, "eps"), (12, "shares_diluted"), (15, "eps")]
    assert [(r.row_no, r.role) for r in got] == want


NOTES = "doc int, col int, year int, basis string, eps double, places int, shares double, multiplier int, printed string, proved boolean"


def test_columns_meet(spark):
    share = (1e8, 1000, "100,000")
    notes = [
        (1, 0, 2024, None, 2.45, 2, *share, True), (1, 1, 2023, None, 1.47, 2, *share, True), (2, 0, 2024, "CONSOLIDATED", 2.4, 1, *share, False),
        (3, 0, None, None, 2.45, 2, *share, True), (3, 1, None, None, 1.45, 2, *share, False), (3, 2, None, None, 2.45, 2, *share, True),
        (4, 0, None, None, 1.0, 2, *share, True), (5, 0, 2024, None, 3.0, 2, *share, False), (5, 1, 2024, None, 4.0, 2, *share, True), (6, 0, 2024, "COMPANY", 9.0, 2, *share, True),
    ]
    face = [
        (1, 2, 2024, None, 2.45, 2, None), (1, 3, 2023, None, 1.45, 2, None), (2, 0, 2024, None, 2.43, 2, None), (3, 0, 2024, None, 2.45, 2, None), (3, 1, 2023, None, 1.45, 2, None),
        (4, 0, 2024, None, 1.0, 2, None), (4, 1, 2023, None, 1.0, 2, None), (5, 0, 2024, None, 3.5, 2, None), (5, 1, 2024, None, 4.0, 2, None), (6, 0, 2024, None, 8.0, 2, None), (6, 1, 2024, "COMPANY", None, None, None),
    ]
    got = share_notes.aligned(spark.createDataFrame(notes, NOTES), spark.createDataFrame(face, FACE)).orderBy("doc", "col").collect()
    want = [(1, 2, 0, 1.0), (1, 3, 1, 0.8), (2, 0, 0, 0.8), (3, 0, 0, 1.0), (3, 1, 1, 0.8), (5, 0, 0, 0.5), (5, 1, 1, 1.0), (6, 1, 0, 0.8)]
    assert [(r.doc, r.col, r.note_col, r.confidence) for r in got] == want
