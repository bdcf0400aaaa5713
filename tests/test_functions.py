"""Column functions on hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from finloom.functions import labels, numbers, periods


def values(spark, inputs, kind, function):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("y")).first().y


def day(text):
    return F.lit(dt.date.fromisoformat(text)).cast("date")


NUMBERS = {
    "1,234": "1234", "(1,234.50)": "-1234.50", "12.3%": "12.3", "RM 1,234": "1234", "rm(5)": "-5", "4.25 sen": "4.25", "1,234 *": "1234", "1,234-": "-1234", "-7": "-7", "+7": "7", "56)": "-56", "(56": "-56",
    "  9 ": "9", "0": "0", "-": None, "--": None, "–": None, "—": None, "Nil": None, "N/A": None, "na": None, "": None, "   ": None, None: None, "Revenue": None, "Note 5": None, "abc": None, "1,2,3.4.5": None, "RM": None, "(-)": None,
}


def test_parse_number(spark):
    got = values(spark, list(NUMBERS), "string", numbers.parse_number)
    assert dict(zip(NUMBERS, got)) == {k: None if v is None else Decimal(v) for k, v in NUMBERS.items()}
    numeric = values(spark, ["-", "1,234", "Revenue", None, "nil", "(3)", "RM 5"], "string", numbers.looks_numeric)
    assert numeric == [True, True, False, True, True, True, True]


def test_scales_and_money(spark):
    texts = ["RM'000", "Unaudited (RM'000)", "RM million", "RM'000,000", "US$ billion", "USD'000", "SGD million", "in thousands", "Statement of Financial Position", "", "presented in terms of plans", None]
    got = values(spark, texts, "string", numbers.detect_scale)
    assert [(g.multiplier, g.currency) for g in got] == [(1000, "MYR"), (1000, "MYR"), (10**6, "MYR"), (10**6, "MYR"), (10**9, "USD"), (1000, "USD"), (10**6, "SGD"), (1000, "MYR"), (1, "MYR"), (1, "MYR"), (1, "MYR"), (1, "MYR")]
    assert one(spark, numbers.detect_scale(F.lit("Income Statement"), F.lit(None).cast("string"), F.lit("Unaudited, RM'000"))).multiplier == 1000
    assert values(spark, ["Basic earnings per share (sen)", "Sen", "Revenue", "presented", None], "string", numbers.mentions_per_share) == [True, True, False, False, False]
    assert one(spark, numbers.to_base_units(F.lit(4.25), F.lit(1000), F.lit(True))) == 4.25 and one(spark, numbers.to_base_units(F.lit(4.25), F.lit(1000), F.lit(False))) == 4250
    assert values(spark, [1.5e9, -2.25e6, 3400.0, 12.0, None], "double", numbers.money_text) == ["RM1.50b", "-RM2.3m", "RM3k", "RM12", "n/a"]
    assert values(spark, ["1.25", "3", "0.5%"], "string", numbers.decimals_printed) == [2, 0, 1]
    assert [round(x, 9) for x in values(spark, ["1.25", "3"], "string", numbers.half_unit)] == [0.005, 0.5]
    assert values(spark, [1000.0, 0.00101, 98.0, -1000.0, 3.0], "double", lambda x: numbers.scale_error(x, F.lit(1.0))) == [1000.0, 0.001, 100.0, None, None]


def test_fiscal_calendar(spark):
    ends = [("2024-03-31", 12, 1), ("2024-06-30", 12, 2), ("2024-12-31", 12, 4), ("2024-09-30", 6, 1), ("2025-06-30", 6, 4)]
    rows = spark.createDataFrame([(dt.date.fromisoformat(d), m, q) for d, m, q in ends], "d date, m int, q int")
    assert rows.where(periods.quarter_index(F.col("d"), F.col("m")) != F.col("q")).count() == 0
    fiscal = lambda d, m: one(spark, periods.fiscal_year_of(day(d), F.lit(m)))
    assert (fiscal("2024-09-30", 6), fiscal("2025-06-30", 6), fiscal("2024-09-30", 12)) == (2025, 2025, 2024)
    start = lambda y, m: one(spark, periods.fiscal_year_start(F.lit(y), F.lit(m)))
    assert (start(2025, 6), start(2024, 12), start(2024, 2)) == (dt.date(2024, 7, 1), dt.date(2024, 1, 1), dt.date(2023, 3, 1))
    bounds = lambda d, k, m: tuple(one(spark, periods.period_bounds(day(d), F.lit(k), F.lit(m))))
    assert bounds("2024-09-30", "Q3", 12) == (dt.date(2024, 7, 1), dt.date(2024, 9, 30), "Q3", 2024)
    assert bounds("2025-03-31", "YTD", 6)[0] == dt.date(2024, 7, 1) and bounds("2024-09-30", "INSTANT", 12)[0] is None and bounds("2024-06-30", "H1", 12)[0] == dt.date(2024, 1, 1)
    assert one(spark, periods.prior_period(day("2024-02-29"), F.lit("Q1"), F.lit(12))).period_end == dt.date(2023, 2, 28)
    assert one(spark, periods.same_month_day(F.lit(2023), F.lit(2), F.lit(29))) == dt.date(2023, 2, 28)
    with pytest.raises(Exception, match="fy_end_month"):
        one(spark, periods.quarter_index(day("2024-01-01"), F.lit(13)))
    some = spark.createDataFrame([(1, dt.date(2024, 6, 30)), (1, dt.date(2023, 6, 30)), (2, dt.date(2024, 6, 30)), (2, dt.date(2024, 3, 31))], "g int, d date")
    assert dict(some.groupBy("g").agg(periods.infer_fye(F.col("d"))).collect()) == {1: 6, 2: None}


def test_dates_and_durations_that_headers_state(spark):
    texts = ["for the financial year ended 31 December 2024", "as at September 30, 2024", "as at 31/12/2023 and ended 30.6.2023", "ended 31 February 2024", "ended 5 Foo 2024 ... ended 6 Sept 2024", "none", None]
    assert values(spark, texts, "string", lambda x: periods.stated_period_end(x, False)) == [dt.date(2024, 12, 31), dt.date(2024, 9, 30), dt.date(2023, 6, 30), None, dt.date(2024, 9, 6), None, None]
    assert values(spark, texts[2:3], "string", lambda x: periods.stated_period_end(x, True)) == [dt.date(2023, 12, 31)]
    assert values(spark, ["1.4.2025 to 31.3.2026", "31.02.2024", "x"], "string", periods.dotted_date) == [dt.date(2026, 3, 31), None, None]
    heads = ["Three Months Ended 31 March", "3 MONTHS ENDED 12 MONTHS ENDED", "financial year ended 2024", "Individual quarter Cumulative quarter", "Revenue"]
    assert values(spark, heads, "string", periods.stated_durations) == [[3], [3, 12], [], [], []]
    assert values(spark, heads, "string", periods.is_interim) == [True, True, False, True, False]
    assert values(spark, heads, "string", periods.statement_months) == [3, 3, 12, None, None]
    assert values(spark, heads, "string", lambda x: periods.column_durations(x, day("2024-09-30"), F.lit(12))) == [None, [3, 3, 12, 12], None, [3, 3, 9, 9], None]
    kinds = values(spark, [12, None, 3, 6, 9, 5], "int", lambda x: periods.duration_type(x, day("2024-09-30"), F.lit(12)))
    assert kinds == ["FY", None, "Q3", "H2", "YTD", None]


def test_labels(spark):
    texts = ["Revenue (Note 3)", "- Revenue - note 12", "(a) Révenue", "Net cash from/(used in) operating activities", "Net cash (used in)/from operating activities", "Profit for the year attributable to: Owners", "Tax  expense ...... 24", "5% bonds", None]
    assert values(spark, texts, "string", labels.normalize_label) == ["revenue", "revenue", "revenue", "net cash from operating activities", "net cash from operating activities", "profit owners", "tax expense", "5% bonds", None]
    assert values(spark, ["Jumlah aset", "Keuntungan bagi tahun", "Total assets", ""], "string", labels.looks_malay) == [True, True, False, False]


NAMES = {"S P Setia Berhad": "sp setia", "SP Setia Bhd.": "sp setia", "TIME dotCom Berhad": "time dotcom", "Top Glove Corporation Bhd.": "top glove corp", "Ajinomoto (Malaysia) Berhad": "ajinomoto", "Hong Leong Bank (M) Berhad": "hong leong bank", "IGB Real Estate Investment Trust": "igb reit", "A & B's Co": "a and bs co", "A.B.C. Foods Sdn Bhd": "abc foods", "Berhad": "berhad"}


def test_company_names(spark):
    assert dict(zip(NAMES, values(spark, list(NAMES), "string", labels.company_key))) == NAMES
    pairs = spark.createDataFrame([("sp setia", "sp setia"), ("time dotcom", "timedotcom"), ("malayan banking", "malayan cement")], "a string, b string")
    got = [r[0] for r in pairs.select(labels.key_similarity(F.col("a"), F.col("b"))).collect()]
    assert got[:2] == [1.0, 0.99] and 0.5 < got[2] < 0.93
    texts = ["ANNUAL REPORT 2024 S P SETIA BERHAD (19740100)", "the setia group of companies", "nothing"]
    assert values(spark, texts, "string", lambda x: labels.name_appears(F.lit("S P Setia Berhad"), x)) == [True, False, False]
    assert values(spark, ["199001000001 and 200001000002 200001000002", "200001000002 199001000001", "x"], "string", labels.registration_number) == ["200001000002", "200001000002", None]


JUNK = [
    ("Heineken_part2_test.pdf", 151, "Heineken", "", {"TEST_FILE"}), ("Yinson_test1.pdf", 32, "Yinson", "", {"TEST_FILE"}), ("PB_Stock-IBHD_EN_20210226.pdf", 4, "I-Berhad", "", {"BROKER_NOTE"}),
    ("RHB-MidS 2023.pdf", 9, "I-Berhad", "", {"BROKER_NOTE"}), ("15-IBHD-Initiating-Coverage_20171215.pdf", 16, "I", "", {"BROKER_NOTE"}), ("Harn-Len-Key-Statistic-2024-FINAL-1.pdf", 1, "H", "", {"KEY_STATISTICS"}),
    ("SUSTAINABILITY-STATEMENT-2024.pdf", 48, "X", "", {"SUSTAINABILITY_ONLY"}), ("amb-islamic-interim.pdf", 46, "AMMB", "", {"SUBSIDIARY_REPORT"}), ("FGV-13th-AGM_Presentation-Deck.pdf", 30, "FGV", "", {"PRESENTATION"}),
    ("KJTS-Group-Berhad-Prospectus.pdf", 300, "KJTS", "", {"CIRCULAR"}), ("ENG-KAH-AR2023-01.pdf", 108, "Eng Kah", "", set()), ("Sustainability-and-Annual-Report-2024.pdf", 250, "X", "", set()),
    ("BIMB-AR2024.pdf", 300, "Bank Islam", "", set()), ("report.pdf", 6, "I", "Maintain BUY with a target price of RM1.20. Research analyst certification", {"BROKER_NOTE"}), (None, None, None, None, set()),
    ("cover.pdf", 40, "X", "Sustainability Report 2024 of our group", {"SUSTAINABILITY_ONLY"}),
]


def test_junk_and_file_names(spark):
    rows = spark.createDataFrame([(i, *r[:4]) for i, r in enumerate(JUNK)], "i int, name string, pages int, company string, head string")
    got = rows.select("i", labels.junk_kinds(F.col("name"), F.col("pages"), F.col("company"), F.col("head")).alias("k")).orderBy("i").collect()
    assert [(r.i, {k.kind for k in r.k or []}) for r in got] == [(i, r[4]) for i, r in enumerate(JUNK)]
    hints = values(spark, ["1155_Q3_2023.pdf", "5100-annual-report-2022.pdf", "Annual_2023-11-28.pdf", "0012_AR2021.pdf", "x.pdf"], "string", labels.file_hints)
    assert [(h.code, h.doc_type, h.fiscal_year, h.quarter) for h in hints] == [("1155", "QUARTERLY", 2023, 3), ("5100", "ANNUAL", 2022, None), (None, "ANNUAL", 2023, None), ("0012", "ANNUAL", 2021, None), (None, "OTHER", None, None)]
    assert hints[2].day == dt.date(2023, 11, 28)


def test_fingerprints(spark):
    rows = spark.createDataFrame([("A b " * 200, 3), ("a, B. " * 200, 3), ("a b " * 200, 4), ("short", 3)], "t string, p int")
    got = [r[0] for r in rows.select(labels.fingerprint(F.col("t"), F.col("p"))).collect()]
    assert got[0] == got[1] != got[2] and got[3] is None
    assert [r[0] for r in rows.select(labels.is_scanned(F.col("t"), F.col("p"))).collect()] == [False, False, False, True]
