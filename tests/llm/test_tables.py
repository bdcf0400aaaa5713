"""Token rollups, WARC, mixing, and the pipeline."""

import hashlib
import math
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from finloom.llm import bpe, mixing, token_counts, warc
from finloom.llm.common import new_folder, settle

CHANGES = "source string, lang string, tokenizer string, op string, n_tokens long, old_tokens long"


def test_rollup_of_signed_batches(spark):
    rollup = token_counts.TokenRollup(spark, new_folder(spark, "t"))
    assert rollup.totals().count() == 0
    batch = lambda *rows: spark.createDataFrame(list(rows), CHANGES)
    one = batch(("a", "en", "v1", "insert", 10, None), ("a", "en", "v1", None, 5, None), (None, None, None, "insert", None, None), ("b", "en", "v1", "insert", 7, 0))
    assert rollup.commit("1", one) and not rollup.commit("1", one)
    assert rollup.commit("2/x", batch(("a", "en", "v1", "revise", 12, 10), ("b", "en", "v1", "delete", 7, None), ("a", "en", "v1", "odd", 99, 1)))
    assert rollup.commit("empty", batch(("a", "en", "v1", "insert", 1, None)).limit(0))
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    assert got == {("a", "en", "v1"): (2, 17), (None, None, None): (1, 0)}


def test_an_attempt_that_died_leaves_no_trace_and_one_of_two_writers_wins(spark):
    rollup, other = (token_counts.TokenRollup(spark, root) for root in [new_folder(spark, "t")] * 2)
    rows = spark.createDataFrame([("a", "en", "v1", "insert", 10, None)], CHANGES)
    token_counts.signed(rows).write.parquet(f"{rollup.root}/deltas/attempt=dead")
    assert rollup.totals().count() == 0 and rollup.commit("1", rows)
    # The other writer looked before the first one published.
    assert not other._store(token_counts.signed(rows), other._manifest("1"), [])
    assert [(r.n_docs, r.n_tokens) for r in other.totals().collect()] == [(1, 10)]


def test_rollup_moves_and_compaction(spark):
    rollup = token_counts.TokenRollup(spark, new_folder(spark, "t"))
    more = CHANGES + ", old_source string, old_lang string, note string"
    rollup.commit("1", spark.createDataFrame([("a", "en", "v1", "insert", 10, None)] * 3, CHANGES))
    rollup.commit("2", spark.createDataFrame([("b", None, "v1", "move", 12, 10, "a", "en", "x")], more))
    want = {("a", "en"): (2, 20), ("b", None): (1, 12)}
    got = lambda: {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    assert got() == want
    assert rollup.compact() and got() == want and len(rollup._live()) == 1 and not rollup.compact()
    assert not rollup.commit("2", spark.createDataFrame([("a", "en", "v1", "insert", 1, None)], CHANGES)) and got() == want
    assert rollup.commit("3", spark.createDataFrame([("a", "en", "v1", "delete", 10, None)], CHANGES)) and got() == {**want, ("a", "en"): (1, 10)}


def test_revisions_between_two_states(spark):
    schema = "doc_id int, source string, lang string, tokenizer string, n_tokens long"
    before = spark.createDataFrame([(1, "a", None, "v", 5), (2, "a", "en", "v", 6), (3, None, "en", "v", 7)], schema)
    after = spark.createDataFrame([(1, "a", None, "v", 9), (2, "b", "en", "v", 6), (4, "a", "en", "v", 1)], schema)
    changes = token_counts.as_revisions(before, after)
    assert sorted((r.doc_id, r.op) for r in changes.collect()) == [(1, "revise"), (2, "move"), (3, "delete"), (4, "insert")]
    rollup = token_counts.TokenRollup(spark, new_folder(spark, "t"))
    rollup.commit("before", token_counts.as_changes(before, "insert"))
    rollup.commit("change", changes)
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == {("a", None): (1, 9), ("b", "en"): (1, 6), ("a", "en"): (1, 1)}


def test_history_equals_counting_the_final_state(spark):
    """DuckDB counts the documents that are left, by a table of tokens of each text from the library's own encoder."""
    import duckdb

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    texts = ["Some  words here.", "two\n\n\nlines ", None, "", "x" * 200_000, "gone soon", " poor  and toxic ", "kept"]
    rows = [(i, t, "en" if i % 2 else None, "hot" if i % 3 else "s") for i, t in enumerate(texts)]
    labels = [(1, 0, 0), (5, 1, 1), (6, 0, 1), (6, 0, 1), (7, None, None), (None, 0, 1), (99, 0, 1)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, lang string, source string, tokenizer int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rollup = token_counts.TokenRollup(spark, new_folder(spark, "t"))
    got = token_counts.history(docs, marks, rollup, {"v": path}, public_tokenizers.PATTERN)
    final = {0: "Some words here.", 1: "two\n\n\nlines", 6: "poor and toxic"}
    coder = bpe._encoder(path, public_tokenizers.PATTERN)
    con = duckdb.connect()
    con.execute("create table d (doc_id int, lang varchar, source varchar, n bigint); create table l (doc_id int, quality int, toxic int)")
    con.executemany("insert into d values (?, ?, ?, ?)", [(i, lang, source, len(coder.encode(final.get(i, t) or ""))) for i, t, lang, source in rows])
    con.executemany("insert into l values (?, ?, ?)", labels)
    want = con.execute("select source, lang, 'v' as tokenizer, count(*), sum(n)::bigint from d where doc_id not in (select doc_id from l where toxic = 1 and doc_id is not null) group by all").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert token_counts.history(docs.limit(0), marks, token_counts.TokenRollup(spark, new_folder(spark, "t")), {"v": path}, public_tokenizers.PATTERN).count() == 0


HTML = "<p>ü\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nWARC/</p>"


def test_warc_round_trip(spark):
    rows = [(1, "http://a/x", HTML, 0), (2, "http://a/y", HTML, 0), (3, None, None, 0), (4, "u\nv", "", 0), (5, "http://b", "z" * 300_000, 0), (None, "http://c", HTML, 0), (1, "http://a/x", HTML, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, value int")
    path = new_folder(spark, "w")
    warc.write_archives(pages, path)
    records = warc.read_archives(spark, path)
    assert records.count() == records.select("record_id").distinct().count() == 3 * len(rows) and warc.orphans(records).count() == 0
    found = warc.captures(warc.assemble(records)).collect()
    assert len(found) == len(rows)
    got = {r.page_id: r for r in found}
    assert {k: (v.record_type, v.refers_to) for k, v in got.items()} == {1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None), None: ("revisit", 2)}
    assert all(v.payload_digest == warc.payload_digest((rows[k - 1][2] or "").encode()) and v.payload_bytes == len((rows[k - 1][2] or "").encode()) for k, v in got.items() if k)
    nested = {r.metadata.page_id: r for r in warc.assemble(records).collect()}
    assert bytes(nested[2].capture.payload).decode() == HTML and nested[1].request.target_uri == "http://a/x" and nested[5].n_requests == nested[5].n_metadata == 1


def test_warc_repeated_rows_are_captures_of_their_own_and_equal_the_sql(spark):
    import duckdb

    rows = [(7, "u", "same")] * 2500 + [(7, "v", "same"), (3, "w", "same"), (3, "w", "other"), (3, "w", "other")]
    path = new_folder(spark, "w")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5), path)
    records = warc.read_archives(spark, path)
    assert records.select("record_id").distinct().count() == 3 * len(rows)
    got = warc.captures(warc.assemble(records))
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", rows)
    want = con.execute(warc.ORACLE_SQL).fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def foreign(path):
    """An archive as other writers make it: a gzip member per record, links on either side and more than one of them."""
    import gzip

    def record(kind, block, *headers):
        lines = [f"WARC-Type: {kind}", *headers, f"Content-Length: {len(block)}"]
        return gzip.compress(("WARC/1.1\r\n" + "\r\n".join(lines)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    http = b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nbody"
    parts = [
        record("warcinfo", b"software: x\r\n", "WARC-Record-ID: <i>"),
        record("response", http, "WARC-Record-ID: <a>", "WARC-Concurrent-To: <q>", "warc-concurrent-to: <m>"),
        record("request", b"GET / HTTP/1.1\r\n\r\n", "WARC-Record-ID: <q>"),
        record("metadata", b"pageId: 4\r\n", "WARC-Record-ID: <m>"),
        record("revisit", http[:-4], "WARC-Record-ID: <b>", "WARC-Refers-To: <a>"),
        record("request", b"GET / HTTP/1.1\r\n\r\n", "WARC-Record-ID: <r>", "WARC-Concurrent-To: <a>", "WARC-Concurrent-To: <b>"),
        record("metadata", b"pageId: 9\r\n", "WARC-Record-ID: <n>", "WARC-Concurrent-To: <b>"),
        record("revisit", http[:-4], "WARC-Record-ID: <c>", "WARC-Refers-To: <gone>", "WARC-Payload-Digest: sha1:STATED"),
        record("metadata", b"x: y\r\n", "WARC-Record-ID: <o>", "WARC-Concurrent-To: <none>"),
        record("response", http, "WARC-Record-ID: <d>")[:-1],
    ]
    path.mkdir()
    (path / "x.warc.gz").write_bytes(b"".join(parts[:-1]))
    (path / "y.warc.gz").write_bytes(b"".join(parts[1:3]))


def test_warc_archives_of_other_writers(spark, tmp_path):
    foreign(tmp_path / "w")
    records = warc.read_archives(spark, str(tmp_path / "w"))
    rows = {r.capture.record_id: r for r in warc.assemble(records).collect()}
    assert {k: (r.n_requests, r.n_metadata) for k, r in rows.items()} == {"<a>": (2, 1), "<b>": (1, 1), "<c>": (0, 0)}
    assert rows["<a>"].request.record_id == "<q>" and bytes(rows["<a>"].capture.payload) == b"body"
    digest = warc.payload_digest(b"body")
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.captures(warc.assemble(records)).collect()}
    assert got == {(4, "response", None, 4, digest), (9, "revisit", 4, 4, digest), (None, "revisit", None, 4, "STATED")}
    assert {r.record_id for r in warc.orphans(records).collect()} == {"<o>"}


def test_warc_of_no_pages_and_of_long_ones(spark):
    empty, path = spark.createDataFrame([], "page_id long, url string, html string"), new_folder(spark, "w")
    warc.write_archives(empty, path)
    assert warc.captures(warc.assemble(warc.read_archives(spark, path))).count() == 0
    long = spark.range(1, 4).selectExpr("id as page_id", "'u' as url", "repeat(concat('x', id, char(13), char(10)), 2500000) as html")
    path = new_folder(spark, "w")
    warc.write_archives(long, path)
    rows = warc.captures(warc.assemble(warc.read_archives(spark, path))).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in rows) == [(i, 10_000_000) for i in (1, 2, 3)]


def test_warc_record_cut_short_keeps_what_there_is():
    whole = b"WARC/1.1\r\nA: b\r\nA: c\r\nContent-Length: 10\r\n\r\n01234"
    assert list(warc.parse(iter([whole]))) == [([("a", "b"), ("a", "c"), ("content-length", "10")], b"01234")]
    assert list(warc.parse(iter([b"WARC/1.1\r\nno end"]))) == []


def documents(spark, n=3000):
    return spark.createDataFrame([(i, f"t{i}", "en", "hot" if i % 3 else "cold", 2, 9) for i in range(n)], "doc_id long, text string, lang string, source string, n_chars long, rate int")


def test_mixing_reaches_the_targets_and_repeats_itself(spark):
    docs = documents(spark)
    got = mixing.mix(docs, {"hot": 0.5, "cold": 0.5}, epochs=2.0)
    counts = {r.source: r["count"] for r in got.groupBy("source").count().collect()}
    assert all(abs(v - 3000) < 250 for v in counts.values())
    key = lambda d: sorted((r.doc_id, r.copy_no, r.shuffle_key) for r in d.collect())
    assert key(got) == key(mixing.mix(docs.repartition(7), {"hot": 0.5, "cold": 0.5}, epochs=2.0))
    assert key(got) != key(mixing.mix(docs, {"hot": 0.5, "cold": 0.5}, epochs=2.0, seed=3))
    assert set(docs.columns) | {"copy_no", "shuffle_key"} == set(got.columns)


def test_poisson_counts_have_the_distribution(spark):
    reps = mixing.mix(documents(spark, 4000), {"hot": 1.0}, epochs=1.0).groupBy("doc_id").count().groupBy("count").count()
    hot = sum(bool(i % 3) for i in range(4000))
    for r in reps.collect():
        rate = 4000 / hot
        want = hot * math.exp(-rate) * rate ** r["count"] / math.factorial(r["count"])
        assert abs(r[1] - want) < 6 * math.sqrt(want) + 3


def test_mixing_edge_cases(spark):
    rows = [(None, None, None, None, None), (None, "x", "en", None, 1), (3, "", "en", "a", 0), (3, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix(docs, {None: 0.9, "a": 0.1}, epochs=400.0)
    assert {r.source for r in got.collect()} == {None, "a"}
    assert mixing.mix(docs, {"none": 1.0}).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    clash = spark.createDataFrame([(1, "a", 5, 6, "x" * 3_000_000)], "doc_id long, source string, `_mix_row` int, `a.b` int, copy_no string")
    assert mixing.mix(clash, epochs=3.0).columns == ["doc_id", "source", "_mix_row", "a.b", "copy_no", "shuffle_key"]


def test_poisson_inversion_equals_sums_by_hand():
    import numpy as np

    for rate in (0.001, 0.7, 3.0, 55.5, 400.0):
        for u in (1e-12, 0.01, 0.3, 0.5, 0.77, 0.999, 1 - 1e-9):
            k, p = 0, math.exp(-rate)
            total = p
            while total < u and k < 2000:
                k += 1
                p *= rate / k
                total += p
            assert abs(mixing.poisson(np.array([u]), np.array([rate]))[0] - k) <= (1 if u > 0.9999 else 0)


def test_poisson_large_rates_in_bounded_memory(spark):
    import numpy as np

    rate = 1e9
    low, c = mixing.cumulative(rate)
    assert c.nbytes < 10_000_000 and c[-1] == pytest.approx(1)
    u = (np.arange(1000) + 0.5) / 1000
    k = mixing.poisson(u, np.full(1000, rate))
    assert abs(k.mean() - rate) < 200 and abs(k.std() / math.sqrt(rate) - 1) < 0.01
    with pytest.raises(ValueError):
        mixing.poisson(u, np.full(1000, 1e12))
    docs = spark.createDataFrame([(i, "few" if i < 2 else "many") for i in range(4)], "doc_id long, source string")
    got = mixing.mix(docs, {"few": 1.0}, epochs=100_000.0).groupBy("doc_id").agg({"copy_no": "max", "shuffle_key": "count"}).collect()
    assert {r.doc_id for r in got} == {0, 1} and all(r[1] == r[2] and abs(r[1] - 200_000) < 3000 for r in got)


def plain_pipeline(rows, junk):
    """The pipeline in plain Python, given which rows the quality rules reject: (doc_id, token ids) of all rows that it returns."""
    from tests.llm.test_dedup import brute

    texts = {}
    for doc_id, text, _, source, _ in rows:
        if doc_id in junk:
            continue
        key = "".join(c for c in text if c not in " \t\n\r\x0b\x0c")
        best = texts.get(key)
        if best is None or (-len(text), doc_id) < (-len(best[1]), best[0]):
            texts[key] = (doc_id, text, source)
    left = sorted(texts.values())
    groups = brute([t for _, t, _ in left], 5, 80)
    left = [row for k, row in enumerate(left, 1) if groups[k][1] == k]
    counts = Counter(source for _, _, source in left)
    shares = {s: n**0.5 for s, n in counts.items()}
    out = []
    coder = token_counts.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for doc_id, text, source in left:
        rate = shares[source] / sum(shares.values()) * len(left) / counts[source]
        u = (int(hashlib.md5(f"17:{doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        k, p = 0, math.exp(-rate)
        total = p
        while total < u:
            k += 1
            p *= rate / k
            total += p
        out += [(doc_id, source, coder.encode_ordinary(text), hashlib.sha256(text.encode()).hexdigest())] * k
    return out


def test_pipeline_equals_plain_python_and_takes_odd_rows(spark, tmp_path):
    words = lambda k, n=40: " ".join(f"w{(k * 7919 + i * 31) % 997}" for i in range(n))
    texts = [words(k) for k in range(80)]
    texts += [words(1), words(2) + " more", words(3).replace(" ", "\n"), words(4) + "  ", words(5, 39) + " other", " ".join(random.Random(1).choices([f"w{i}" for i in range(997)], k=50_000))]
    junk = [None, "", "short one", "a b c d e f g h " * 50, " ".join(f"W{i}$$$ ###" for i in range(60))]
    rows = [(i, t, None if i % 5 == 0 else "en", ["hot", "hot", "x", None][i % 4], len(t or "")) for i, t in enumerate(texts + junk)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    docs.withColumn("norm", F.lit(1)).withColumn("token_ids", F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    want = plain_pipeline(rows, set(range(len(texts), len(rows))))
    assert len(want) > 40
    assert sorted((r.doc_id, str(r.source), r.token_ids, r.decoded_sha256) for r in got.collect()) == sorted((i, str(s), ids, d) for i, s, ids, d in want)
    assert settle(corpus_pipeline.near(spark, docs.limit(0), str(tmp_path)), "none").columns == docs.columns
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    spark.createDataFrame([(None, words(99), None, None, None), (None, words(98), None, None, None)], schema).write.parquet(str(tmp_path / "ids" / "documents.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path / "ids")).collect()} <= {None}
