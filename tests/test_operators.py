"""Operators over books, facts and companies on hand-made rows, and the plans of registered queries."""

import datetime as dt
import difflib
import itertools

import pytest
from pyspark.sql import functions as F

from finloom import registry
from finloom.functions import labels
from finloom.operators import annual, catalog, dividends, entities, peers, ratios, results, review, rules
from finloom.plans.book import CONCEPTS

SF = "/root/testdata/sf0.001"


def book(spark, rows):
    """Books from (company_id, fy, {column: value}); years end in December unless said."""
    schema = "company_id long, fy int, period_end date, " + ", ".join(f"{c} double" for c in CONCEPTS)
    return spark.createDataFrame([(c, y, v.get("end", dt.date(y, 12, 31)), *(None if v.get(k) is None else float(v[k]) for k in CONCEPTS)) for c, y, v in rows], schema)


def test_annual_selection_ranks_and_filters(spark):
    facts = spark.createDataFrame(
        [
            (1, "is.revenue", 10, 1, "CONSOLIDATED", "TOTAL", 1.0, 100.0), (1, "is.revenue", 10, 2, "CONSOLIDATED", "TOTAL", 0.9, 110.0), (1, "is.revenue", 10, 3, "CONSOLIDATED", "TOTAL", 0.8, 999.0), (1, "is.revenue", 10, 4, "COMPANY", "TOTAL", 1.0, 998.0),
            (1, "is.revenue", 10, 5, "CONSOLIDATED", "CONTINUING", 1.0, 997.0), (1, "is.revenue", 11, 2, "CONSOLIDATED", "TOTAL", 1.0, 996.0), (1, "bs.total_assets", 12, 1, "CONSOLIDATED", "TOTAL", 1.0, 7.0), (1, "bs.total_assets", 13, 1, "CONSOLIDATED", "TOTAL", 1.0, 8.0), (2, "is.revenue", 10, 1, "CONSOLIDATED", "TOTAL", 1.0, 5.0),
        ],
        "company_id long, concept string, period_id long, document_id long, basis string, continuity string, confidence double, value double",
    )
    day = dt.date
    periods = spark.createDataFrame([(10, "FY", 2024, day(2024, 12, 31)), (11, "Q1", 2024, day(2024, 3, 31)), (12, "INSTANT", 2024, day(2024, 6, 30)), (13, "INSTANT", 2024, day(2024, 12, 31))], "period_id long, period_type string, fiscal_year int, period_end date")
    documents = spark.createDataFrame([(i, None if i == 1 else day(2025, 4, i), None) for i in range(1, 6)], "document_id long, filed date, hint date")
    got = annual.annual_selection(facts, periods, documents)
    assert {(r.company_id, r.concept): r.value for r in got.collect()} == {(1, "is.revenue"): 110.0, (1, "bs.total_assets"): 8.0, (2, "is.revenue"): 5.0}
    one = annual.annual_selection(facts, periods, documents, company_ids=[1], concepts=["is.revenue"]).collect()
    assert [(r.fy, r.period_end, r.document_id) for r in one] == [(2024, day(2024, 12, 31), 2)]
    row = annual.wide(got, ["is.revenue", "bs.total_assets", "cf.none"]).where("company_id = 1").first()
    assert (row.is_revenue, row.bs_total_assets, row.cf_none, row.period_end) == (110.0, 8.0, None, day(2024, 12, 31))
    assert annual.query(facts, concept="is.").count() == 7 and annual.query(facts, concept="is.", not_concept="is.revenue").count() == 0
    assert annual.current_facts(facts, documents).where("period_id = 10 and basis = 'CONSOLIDATED' and continuity = 'TOTAL' and company_id = 1").first().document_id == 3


def test_ratios_and_valuation(spark):
    rows = book(spark, [
        (1, 2020, {"is_revenue": 100, "is_pat_owners": 10, "bs_equity_owners": 50, "bs_total_assets": 200}), (1, 2023, {"is_revenue": 133.1, "is_pat_owners": 8, "bs_total_equity": 40, "is_profit_for_period": 12, "bs_total_assets": 100, "is_operating_profit": 15}),
        (2, 2023, {"is_profit_before_tax": 80, "is_finance_costs": -20, "is_tax_expense": -20, "cf_profit_before_tax": 80, "cf_operating_before_wc": 110, "cf_purchase_of_ppe": -40, "cf_working_capital_changes": 5, "cf_net_operating": 90, "bs_lt_borrowings": 60, "bs_cash_and_equivalents": 25}),
        (3, 2023, {"is_profit_before_tax": 80, "is_tax_expense": 20, "is_depreciation_amortisation": -7, "cf_profit_before_tax": 80, "cf_operating_before_wc": 70}),
    ])
    d = {(r.company_id, r.fy): r for r in ratios.dupont(rows).collect()}
    assert d[1, 2020].roe == pytest.approx(0.2) and d[1, 2020].net_margin * d[1, 2020].turnover * d[1, 2020].multiplier == pytest.approx(0.2)
    assert d[1, 2023].roe == pytest.approx(0.3) and d[1, 2023].tax_burden is None and (2, 2023) not in d
    g = {(r.company_id, r.measure, r.span): r.rate for r in ratios.growth(rows).collect()}
    assert g[1, "revenue", 3] == pytest.approx(0.1) and g[1, "revenue", 5] is None and g[1, "earnings", 3] == pytest.approx(0.8 ** (1 / 3) - 1)
    v = {r.company_id: r for r in ratios.valuation(rows).where("fy = 2023").collect()}
    assert (v[2].ebit, v[2].tax_rate, v[2].dep_amort, v[2].ebitda, v[2].nopat, v[2].fcff, v[2].fcfe, v[2].net_debt) == (100, 0.25, 30, 130, 75, 60, 50, 35)
    assert v[3].tax_rate is None and v[3].dep_amort == 7 and v[1].ebit == 15


def test_closes_asof(spark):
    day = dt.date
    closes = spark.createDataFrame([(1, day(2024, 1, 1), 2.0), (1, day(2024, 1, 20), 3.0), (2, day(2023, 12, 1), 9.0)], "company_id long, day date, close double")
    targets = spark.createDataFrame([(1, day(2024, 1, 11)), (1, day(2024, 1, 12)), (1, day(2024, 1, 20)), (2, day(2024, 1, 1))], "company_id long, target date")
    got = {(r.company_id, r.target): r.close for r in ratios.closes_asof(targets, closes).collect()}
    assert list(got.values()) and got == {(1, day(2024, 1, 11)): 2.0, (1, day(2024, 1, 12)): None, (1, day(2024, 1, 20)): 3.0, (2, day(2024, 1, 1)): None}


def test_dividends(spark):
    paid = lambda x, **more: {"cf_dividends_paid": x, "is_pat_owners": 100, "is_weighted_avg_shares": 1000, **more}
    rows = book(spark, [(1, 2018, paid(-40)), (1, 2019, paid(0)), (1, 2020, paid(-50)), (1, 2021, paid(50)), (1, 2022, paid(None, eq_dividends=-500)), (1, 2023, {"is_revenue": 1}), (2, 2022, {"is_dpu": 5, "is_eps_basic": 8}), (3, 2022, paid(-10, is_pat_owners=-5)), (4, 2023, {"is_revenue": 1})])
    companies = spark.createDataFrame([(1, "A Berhad", "general"), (3, "C", "general"), (5, "X REIT", None)], "company_id long, name string, profile string")
    years = dividends.dividend_years(dividends.marked(rows, companies))
    y = {(r.company_id, r.fy): r for r in years.collect()}
    assert y[1, 2018].payout == 0.4 and y[1, 2019].paid is False and y[1, 2020].dps_sen == 5 and y[1, 2021].growth == 0 and "cash_inflow" in y[1, 2021].flags
    assert y[1, 2022].basis == "equity" and {"from_equity_statement", "payout_implausible"} <= set(y[1, 2022].flags.split(",")) and y[1, 2023].paid is None
    assert y[2, 2022].dps_sen == 5 and y[2, 2022].payout == 0.625 and y[3, 2022].payout is None and "paid_in_loss_year" in y[3, 2022].flags
    h = {r.company_id: r for r in dividends.dividend_history(years).collect()}
    assert (h[1].streak, h[1].streak_end, h[1].longest_streak, h[1].median_payout, h[1].last_dps_sen) == (3, 2022, 3, 0.5, 50) and h[4].streak_end is None
    assert {r.company_id for r in dividends.dividend_screen(dividends.dividend_history(years), 1).collect()} == {1, 2}
    assert {r.company_id for r in dividends.dividend_screen(dividends.dividend_history(years), 1, max_payout=None).collect()} == {1, 2, 3}


def test_peers(spark):
    good = {"is_revenue": 100, "is_pat_owners": 10, "is_profit_for_period": 10, "bs_equity_owners": 50, "bs_total_assets": 100}
    rows = book(spark, [(1, 2023, good), (1, 2024, {**good, "end": dt.date(2024, 6, 30)}), (2, 2024, {**good, "is_pat_owners": 300, "is_profit_for_period": 300}), (3, 2024, {**good, "is_pat_owners": 1}), (4, 2024, good), (5, 2024, {**good, "is_pat_owners": 20, "is_profit_for_period": 20})])
    companies = spark.createDataFrame([(i, "X", "bank" if i == 4 else "general") for i in range(1, 7)], "company_id long, sector string, profile string")
    snap = peers.snapshot(rows, companies)
    assert {r.company_id: r.fy for r in snap.collect()} == {1: 2023, 2: 2024, 3: 2024, 4: 2024, 5: 2024}
    assert {r.company_id: r.fy for r in peers.snapshot(rows, companies, 2023).collect()} == {1: 2023}
    m = {(r.company_id, r.metric): r for r in peers.metrics(snap).collect()}
    assert m[2, "roe"].flagged and m[3, "net_margin"].flagged and m[3, "roe"].flagged and not m[1, "roe"].flagged
    assert m[4, "net_margin"].not_applicable and m[4, "net_margin"].value is None and m[4, "roe"].value == 0.2
    _, stats, places = peers.comparison(rows, companies, sector="x")
    s = {r.metric: r for r in stats.collect()}["roe"]
    assert (s.n, s.n_flagged, s.q1, s.median_value, s.q3) == (3, 2, 0.2, 0.2, pytest.approx(0.3))
    assert {r.company_id: r.percentile for r in places.where("metric = 'roe'").collect()} == {1: 25.0, 4: 25.0, 5: 100.0}
    assert peers.comparison(rows, companies, company_ids=[5, 5, 99])[2].where("metric = 'roe'").first().percentile is None


def test_results(spark):
    rows = book(spark, [(1, 2022, {"is_revenue": 200e6, "is_pat_owners": 10e6, "cf_net_operating": 10e6}), (1, 2023, {"is_revenue": 210e6, "is_pat_owners": 20e6, "cf_net_operating": 5e6}), (2, 2022, {"is_pat_owners": -5e6}), (2, 2023, {"is_pat_owners": 1e6}), (3, 2022, {"is_pat_owners": 5e6, "end": dt.date(2022, 6, 30)}), (3, 2023, {"is_pat_owners": 6e6})])
    pairs = results.with_prior(results.figures(rows))
    items = {(r.company_id, r.fy): r for r in results.feed(pairs).collect()}
    assert (items[1, 2023].kind, items[1, 2023].tone, items[1, 2022].tone, items[2, 2023].kind, items[2, 2023].tone, items[3, 2023].tone) == ("growth", "up", "new", "turnaround", "up", "new")
    seen = {(r.company_id, r.observation) for r in results.observations(pairs).where("fy = 2023").collect()}
    assert seen == {(1, "weak_cash_conversion"), (1, "margin_expansion"), (1, "profit_outpaces_revenue"), (2, "back_in_profit")}
    head = {r.measure: r for r in results.headline_rows(pairs).where("company_id = 1 and fy = 2023").collect()}
    assert head["revenue"].change == pytest.approx(0.05) and head["net_margin"].kind == "pp" and head["patami"].value_before == 10e6 and "equity" not in head
    assert [(r.company_id, r.side) for r in results.movers(results.feed(pairs)).collect()] == [(1, "gainer")]
    assert results.feed(pairs, F.lit(dt.date(2023, 1, 1))).count() == 3 and {r.cohort for r in results.feed(pairs, months=1).collect()} == {202312}


def test_rules_and_derivations(spark):
    base = {"bs_total_assets": 100, "bs_total_liabilities": 60, "bs_total_equity": 40}
    rows = book(spark, [
        (1, 2024, {**base, "is_revenue": 50, "is_cost_of_sales": -30, "is_gross_profit": 20, "is_pat_owners": 1000, "is_eps_basic": 10, "is_weighted_avg_shares": 10_000}), (2, 2024, {**base, "bs_total_equity": 38, "is_revenue": 50, "is_cost_of_sales": 30, "is_gross_profit": 25}),
        (3, 2024, {"bs_total_equity_and_liabilities": 100, "bs_total_liabilities": 60, "bs_nci": 4, "is_profit_before_tax": 10, "is_tax_expense": -3, "is_pat_nci": 1}),
    ])
    out = {(r.company_id, r.rule_key): r for r in rules.single_period(rows, ["company_id"]).collect()}
    assert out[1, "bs_balances"].passed and not out[2, "bs_balances"].passed and out[2, "bs_balances"].delta == 2
    assert out[1, "is_gross_profit"].passed and out[2, "is_gross_profit"].expected == 20 and out[1, "eps_consistency"].passed and (3, "bs_balances") not in out
    assert rules.single_period(rows, ["company_id"], 5.0).where("not passed").count() == 0
    made = {r.concept: (r.value, r.formula) for r in rules.derived(rows, ["company_id"]).where("company_id = 3").collect()}
    assert made == {"bs_total_assets": (100, "bs_total_equity_and_liabilities"), "bs_total_equity": (40, "bs_total_assets - bs_total_liabilities"), "is_profit_for_period": (7, "is_profit_before_tax + is_tax_expense"), "is_pat_owners": (6, "is_profit_for_period - is_pat_nci"), "bs_equity_owners": (36, "bs_total_equity - bs_nci")}
    moved = book(spark, [(1, 2022, {"is_revenue": 1}), (1, 2023, {"is_revenue": 1000}), (1, 2024, {"is_revenue": 100})])
    assert {r.severity for r in rules.magnitude(moved, "is_revenue").collect()} == {95, 40}


def test_reconciliations(spark):
    reported = spark.createDataFrame([(1, "c", "p", "b", d, f, v) for d, f, v in ((5, 1, 100_000.0), (5, 2, 1.0), (7, 3, 100_500.0), (9, 4, 130_000.0), (11, 5, 100_000.0))], "company_id long, concept string, period_end string, basis string, document_id long, fact_id long, value double")
    assert {r.document_id: r["class"] for r in rules.comparative(reported).collect()} == {7: "ROUNDING", 9: "RESTATEMENT", 11: "MATCH"}
    side = lambda *rows: spark.createDataFrame(list(rows), "concept string, fy int, value double")
    got = rules.against_source(side(("a", 1, 100.0), ("b", 1, 110.0), ("c", 1, 5.0), ("d", 1, 1000.0), ("e", 2, 3.0), ("f", 1, 0.0)), side(("a", 1, 101.0), ("b", 1, 100.0), ("g", 1, 5.0), ("d", 1, 1.0), ("f", 1, 0.0), ("c", 1, 20.0)), ["concept", "fy"])
    assert {r.concept: r["class"] for r in got.collect() if r.concept not in "eg"} == {"a": "MATCH", "b": "CLOSE", "c": "MISMATCH", "d": "SCALE_ERROR", "f": "MATCH"}
    one = lambda *rows: spark.createDataFrame(list(rows), "k int, value double")
    assert {r.k: r["class"] for r in rules.against_source(one((1, 5.0), (2, 6.0)), one((1, 5.0), (3, 7.0)), ["k"]).collect()} == {1: "MATCH", 2: "MISSING", 3: "MISSING"}
    check = lambda shown, fact: spark.range(1).select(rules.summary_check(F.lit(shown), F.lit(fact).cast("double"), F.lit(0.5)).alias("c")).first().c
    assert [(check(*x)["class"], check(*x).note) for x in ((10.0, 10.4), (0.0, 9.0), (10.0, -10.0), (10.0, 10000.0), (100.0, 104.0), (100.0, 200.0), (1.0, None))] == [
        ("MATCH", "printed rounding"), ("MISMATCH", "summary reports zero"), ("MISMATCH", "sign flipped"), ("SCALE_ERROR", "scale"), ("CLOSE", "deviation"), ("MISMATCH", "deviation"), ("ONLY_IN_SUMMARY", "no annual fact"),
    ]
    keyed = lambda rows: spark.createDataFrame(rows, "company_id long, fy int, value double")
    best = rules.best_unit(keyed([(1, y, 5.0 + y) for y in range(4)] + [(2, 1, 7.0)]), keyed([(1, y, (5.0 + y) * 1000) for y in range(4)] + [(2, 1, 7.0)]), ["company_id", "fy"])
    assert {r.company_id: r.unit for r in best.collect()} == {1: 1000, 2: None}


def test_duplicate_companies_equal_all_pairs(spark):
    names = ["SP Setia Berhad", "S P Setia Berhad", "Time Dotcom Berhad", "TIME dotCom Berhad", "Malayan Banking Berhad", "Malayan Cement Berhad", "Sunway Berhad", "Sunway Construction Group Berhad", "Perdana Holding", "Perdana Holdings", "Perdana Holdngs", None, "Berhad"]
    rows = spark.createDataFrame(list(enumerate(names)), "company_id long, name string")
    keys = {r.company_id: r.k for r in rows.select("company_id", labels.company_key(F.col("name")).alias("k")).collect() if r.k}
    want = {(a, b) for a, b in itertools.combinations(sorted(keys), 2) if keys[a].replace(" ", "") == keys[b].replace(" ", "") or keys[a][:3] == keys[b][:3] and abs(len(keys[a]) - len(keys[b])) <= 4 and difflib.SequenceMatcher(None, *sorted((keys[a], keys[b]), key=lambda k: (len(k), k))).ratio() >= 0.93}
    got = {(r.a, r.b) for r in entities.duplicate_companies(rows).collect()}
    assert got == want and {(0, 1), (2, 3), (8, 9)} <= got and (4, 5) not in got
    held = spark.createDataFrame([(0, 5, 100, True), (1, 0, 0, False)], "company_id long, docs int, facts int, listed boolean")
    (issue,) = entities.duplicate_issues(entities.duplicate_companies(rows).where("a = 0"), held).collect()
    assert (issue.holder, issue.other, issue.severity, issue.fix) == (0, 1, "low", "delete other")
    listing = spark.createDataFrame([("5100", "BP Plastics Holding Bhd."), ("5199", "Hibiscus Petroleum Berhad")], "stock_code string, name string")
    some = spark.createDataFrame([(1, "5100", "Hibiscus Petroleum Berhad"), (2, "5199", "Hibiscus Petroleum Bhd"), (3, "1", "X")], "company_id long, stock_code string, name string")
    assert {r.company_id: r.status for r in entities.listing_status(some, listing).collect()} == {1: "OTHER_ISSUER", 2: "OK", 3: "UNLISTED"}
    texts = spark.createDataFrame([(1, "no 199001000001"), (2, "199001000001"), (3, "199001000002")], "company_id long, text string")
    assert [(r.registration, r.companies) for r in entities.shared_registrations(texts).collect()] == [("199001000001", 2)]


def test_review_queue_and_upserts(spark):
    synonyms = spark.createDataFrame([("revenue", "IS", None, "is.revenue"), ("revenue", "IS", 2, "is.other_income")], "normalized string, statement string, company_id long, concept string")
    rows = spark.createDataFrame([(1, 1, "IS", "Revenue (Note 3)", 5.0), (2, 2, "IS", "Revenue", 6.0), (3, 3, "IS", "Odd item", 1e6), (4, 4, "IS", "Odd  item", 10.0), (5, 5, "IS", "12", 1.0)], "document_id long, company_id long, statement string, label string, value double")
    mapped = review.lookup(rows, synonyms)
    assert {r.document_id: r.concept for r in mapped.collect()} == {1: "is.revenue", 2: "is.other_income", 3: None, 4: None, 5: None}
    decided = spark.createDataFrame([(4, "IS", "odd item")], "document_id long, statement string, normalized string")
    (item,) = review.candidates(mapped, decided).collect()
    assert (item.document_id, item.normalized, item.companies, item.severity) == (3, "odd item", 2, 20 + 30 + 6)
    items = spark.createDataFrame([(1, "IS", "odd item", 3), (2, "BS", "odd item", 3), (3, "IS", "x", 3)], "item_id long, statement string, normalized string, company_id long")
    choices = spark.createDataFrame([(1, "map", "is.revenue", True), (2, "map", "is.revenue", False)], "item_id long, action string, concept string, for_company boolean")
    concepts = spark.createDataFrame([("is.revenue", "IS")], "concept string, statement string")
    done, known = review.resolve(items, choices, concepts, synonyms)
    assert {r.item_id: (r.resolution, r.error is None) for r in done.collect()} == {1: ("map", True), 2: (None, False), 3: (None, True)} and known.count() == 3
    fact = "company_id long, concept string, period_id long, basis string, continuity string, document_id long, fact_id long, value double, confidence double"
    new = spark.createDataFrame([(1, "a", 1, "C", "T", 9, 10, 5.0, 1.0), (1, "a", 1, "C", "T", 9, 11, 6.0, 1.0), (1, "b", 1, "C", "T", 9, 12, 7.0, 1.0), (1, "b", 1, "C", "T", 8, 13, 7.0, 1.0)], fact)
    old = spark.createDataFrame([(1, "b", 1, "C", "T", 9, 1, 7.0, 1.0, "APPROVED"), (1, "c", 1, "C", "T", 9, 2, 1.0, 1.0, "PENDING"), (1, "d", 1, "C", "T", 3, 3, 2.0, 1.0, "PENDING")], fact + ", review_status string")
    after = review.upsert_facts(old, new, spark.createDataFrame([(9,)], "document_id long"))
    assert {(r.concept, r.document_id): (r.value, r.review_status) for r in after.collect()} == {("a", 9): (6.0, "PENDING"), ("b", 9): (7.0, "APPROVED"), ("d", 3): (2.0, "PENDING")}
    urls = review.merge_by_confidence(spark.createDataFrame([("1", "old"), ("2", "old")], "stock_code string, url string"), spark.createDataFrame([("1", "new", "High"), ("1", "low", "low"), ("3", "add", "medium"), ("2", "bad", "low")], "stock_code string, url string, confidence string"))
    assert {r.stock_code: r.url for r in urls.collect()} == {"1": "new", "2": "old", "3": "add"}
    ends = spark.createDataFrame([(1, dt.date(y, m, 28)) for y, m in ((2024, 6), (2023, 6), (2022, 12), (2015, 12), (2014, 12))], "company_id long, period_end date")
    assert [(r.month, r.votes) for r in review.reconcile_year_end(ends).collect()] == [(6, 2)]


@pytest.mark.parametrize("name", sorted(catalog.FRAMES))
def test_plans_do_not_scan_lineitem_for_each_measure(spark, name):
    """Measures are told apart within a row, not by a scan each; a query reads the lines once for each frame that it joins."""
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") <= {"sector_context": 4, "five_year_check": 3, "hygiene_impact": 3}.get(name, 2)
