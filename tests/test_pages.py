"""Pages, blocks and streams of documents on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from finloom.operators import pages
from finloom.streaming import documents


def test_pages_and_movements(spark):
    figures = "\n".join(f"Row {i} 1,234 (5,678)" for i in range(12))
    texts = [f"Consolidated Statement of Financial Position\n{figures}", f"Statements of Cash Flows\nno figures", f"Contents\nStatement of changes in equity {figures}", figures, "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "page int, text string").select(F.lit(1).alias("doc"), "page", pages.page_class(F.col("text")).alias("c")).select("doc", "page", "c.*")
    got = {r.page: r for r in rows.collect()}
    assert (got[0].statement, got[0].confidence, got[1].statement, got[1].confidence, got[2].statement, got[3].statement) == ("BS", 0.95, "CF", 0.25, None, None)
    run = spark.createDataFrame([(1, 1, "BS", 9), (1, 2, None, 9), (1, 3, None, 0), (1, 4, None, 9), (1, 5, "IS", 0), (1, 6, None, 4)], "doc int, page int, statement string, numeric_rows int")
    assert [r.carried for r in pages.carried_forward(run).orderBy("page").collect()] == ["BS", "BS", None, None, "IS", "IS"]
    labels = ["Dividends paid to owners", "Issuance of shares under ESOS", "Profit for the financial year", "Total comprehensive income", "Purchase of treasury shares", "Other"]
    found = spark.createDataFrame([(x,) for x in labels], "x string").select(pages.movement_of(F.col("x")).alias("m")).collect()
    assert [r.m for r in found] == ["eq.dividends", "eq.share_based_payments", "eq.profit_for_year", "eq.total_comprehensive_income", "eq.share_buyback", None]


def test_bands_pairs_and_counts(spark):
    words = spark.createDataFrame([(1, 1, 1, 100.0), (1, 1, 2, 104.0), (1, 1, 3, 150.0), (1, 2, 4, 100.0)], "doc int, page int, word_id int, x1 double")
    bands = spark.createDataFrame([(1, 1, 0, 90.0, 101.0), (1, 1, 1, 99.0, 110.0)], "doc int, page int, band int, left_edge double, right_edge double")
    assert {r.word_id: r.band for r in pages.words_in_bands(words, bands).collect()} == {1: 0, 2: 0, 3: None, 4: None}
    left, right = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 11, "c")], "d int, y int, v string"), spark.createDataFrame([(1, 7, "x"), (1, 30, "z")], "d int, y int, v string")
    assert [(r.v, r.right_v) for r in pages.paired_by_order(left, right, ["d"], "y").orderBy("y").collect()] == [("a", "x"), ("b", "z"), ("c", None)]
    seen = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "a", 3), (1, "b", 4), (2, None, 1)], "k int, v string, i int")
    assert [(r.k, r.v, r.n) for r in pages.most_common(seen, ["k"], "v", "i").collect()] == [(1, "b", 2)]
    selected = spark.createDataFrame([(1, 2024, 7), (1, 2024, 8), (1, 2024, 8)], "company_id int, fy int, document_id int")
    files = spark.createDataFrame([(7, "a.pdf"), (8, "b.pdf")], "document_id int, file_name string")
    assert pages.source_ranking(selected, files).first().sources == "b.pdf (2); a.pdf (1)"
    block = spark.createDataFrame([(1, 1, "eq.dividends", 2.0), (1, 1, "eq.dividends", 3.0), (1, 1, "eq.opening_balance", 1.0), (1, 1, "eq.opening_balance", 9.0), (1, 1, "eq.closing_balance", 4.0)], "document_id int, block int, concept string, value double")
    assert {r.concept: r.value for r in pages.block_totals(block, ["eq.dividends"]).collect()} == {"eq.dividends": 5.0, "eq.closing_balance": 4.0}
    scored = spark.createDataFrame([(1, "IS", "p", 5, 2.0, 9), (1, "IS", "p", 4, 2.0, 9), (1, "IS", "p", 3, 2.0, 8)], "company_id int, statement string, period_end string, document_id int, score double, pages int")
    assert pages.best_documents(scored).first().document_id == 4
    stored = spark.createDataFrame([(1, "k1", "s1"), (2, "k2", "s2"), (3, "k3", "s3"), (4, None, "s4")], "document_id int, storage_path string, sha256 string")
    listing = spark.createDataFrame([("k1", "s1", 5), ("k2", "other", 5)], "key string, sha256 string, size long")
    assert {r.document_id: r.status for r in pages.stored_objects(stored, listing).collect()} == {1: "ok", 2: "mismatch", 3: "missing", 4: "no_path"}
    at = dt.datetime(2024, 1, 1)
    jobs = spark.createDataFrame([(1, 5, 10, at, at), (2, 0, 10, at, at + dt.timedelta(hours=2))], "job_id int, done int, total int, started timestamp, updated timestamp")
    got = {r.job_id: r for r in pages.progress(jobs, F.lit(at + dt.timedelta(hours=2))).collect()}
    assert (got[1].eta, got[1].stalled, got[2].eta, got[2].stalled) == (7200, True, None, False)


def test_streams_of_documents(spark, tmp_path):
    box = tmp_path / "box"
    box.mkdir()
    for name, data in (("a.pdf", b"one"), ("b.pdf", b"one"), ("c.pdf", b"two"), ("d.txt", b"three")):
        (box / name).write_bytes(data)
    query = documents.inbox_stream(spark, str(box)).writeStream.format("memory").queryName("inbox").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.length for r in spark.table("inbox").collect()) == [3, 3] and spark.table("inbox").select("sha256").distinct().count() == 2
    fact = "company_id long, concept string, period_id long, basis string, continuity string, document_id long, fact_id long, value double, confidence double"
    versions = {0: spark.createDataFrame([(1, "old", 1, "C", "T", 9, 1, 1.0, 1.0, "PENDING"), (1, "kept", 1, "C", "T", 8, 2, 2.0, 1.0, "PENDING")], fact + ", review_status string")}
    batch = documents.replacing(lambda: versions[max(versions)], lambda df, i: versions.update({i + 1: df}))
    again = spark.createDataFrame([(1, "new", 1, "C", "T", 9, 3, 3.0, 1.0)], fact)
    for i in (0, 1):  # the second time changes nothing more
        batch(again, i)
        assert sorted((r.concept, r.value) for r in versions[i + 1].collect()) == [("kept", 2.0), ("new", 3.0)]
    batch(spark.createDataFrame([(None, None, None, None, None, 8, None, None, None)], fact), 2)  # read again, nothing found
    assert [(r.concept, r.value) for r in versions[3].collect()] == [("new", 3.0)]
    day = lambda d: dt.datetime(2024, 1, d)
    spark.createDataFrame([(1, "c", "p", 1, day(1), 5.0), (1, "c", "p", 2, day(3), 6.0), (1, "c", "p", 3, day(2), 7.0)], "company_id int, concept string, period_end string, document_id int, filed timestamp, value double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("company_id int, concept string, period_end string, document_id int, filed timestamp, value double").parquet(str(tmp_path / "in"))
    query = documents.latest_filings(stream).writeStream.format("memory").queryName("latest").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.value, r.document_id) for r in spark.table("latest").collect()] == [(6.0, 2)]
