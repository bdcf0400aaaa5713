"""Runs of pages on hand-made evidence and pages, against all runs."""

import random

from finloom.operators import page_runs

SAID = "doc int, page int, statement string, score double, starts boolean, leans boolean, ends boolean"


def all_runs(rows, longest):
    pages, best = {(d, s, p): (score, starts, leans, ends) for d, p, s, score, starts, leans, ends in rows}, {}
    for (d, s, p), (_, starts, *_) in pages.items():
        if not starts:
            continue
        total = 0.0
        for more in range(longest):
            here = pages.get((d, s, p + more))
            if here is None or (more and not here[2]):
                break
            total += here[0] + (page_runs.GOES_ON if more else 0)
            found = (-(total + (page_runs.ENDS if here[3] else 0)), p, p + more)
            best[d, s] = min(best.get((d, s), found), found)
    return sorted((d, s, first, last, -score) for (d, s), (score, first, last) in best.items())


def test_best_runs_equal_all_runs(spark):
    draw = random.Random(2)
    rows = [(d, p, s, float(draw.choice([0, 10, 10, 25])), draw.random() < 0.4, draw.random() < 0.6, draw.random() < 0.2) for d in range(30) for s in ("IS", "BS") for p in sorted(draw.sample(range(1, 15), 9))]
    got = page_runs.best_runs(spark.createDataFrame(rows, SAID)).collect()
    assert sorted(tuple(r) for r in got) == all_runs(rows, page_runs.LONGEST)
    assert page_runs.best_runs(spark.createDataFrame([], SAID)).collect() == []


PAGES = {
    1: "CONTENTS\nStatement of financial position 1 2 3 4 5 6 7",
    2: "STATEMENT OF FINANCIAL POSITION\nProperty, plant and equipment 1 2\nInventories 3 4\nTotal assets 5 6 7",
    3: "(cont'd)\nShare capital 1 2\nBorrowings 3 4\nTotal equity and liabilities 5 6 7",
    4: "STATEMENT OF CASH FLOWS\nOperating activities 1 2 3\nFinancing activities 4 5 6\nCash and cash equivalents at end of the year 7 8",
    5: "NOTES TO THE FINANCIAL STATEMENTS\nInventories 1 2 3 4 5 6\nShare capital 7\nTotal assets 8\nBorrowings 9\nTrade receivables 10",
    6: "STATEMENT OF FINANCIAL POSITION\nwords without figures\nInventories\nTotal assets",
}


def test_pages_of_a_report(spark):
    frame = spark.createDataFrame([(1, p, t) for p, t in PAGES.items()] + [(1, 7, None), (1, 8, "")], "doc int, page int, text string")
    got = {r.statement: (r.first_page, r.last_page) for r in page_runs.best_runs(page_runs.evidence(frame)).collect()}
    assert got == {"BS": (2, 3), "CF": (4, 4)}


def test_a_step_of_the_fold_is_worked_out_once(spark):
    """The best of the runs that end on a page stands once in the expression, not once for each use of it."""
    said = spark.createDataFrame([(1, 1, "IS", 5.0, True, True, False)], "doc long, page int, statement string, score double, starts boolean, leans boolean, ends boolean")
    assert page_runs.best_runs(said)._jdf.queryExecution().analyzed().toString().count("array_max(") == 1
