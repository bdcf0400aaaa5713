"""BPE, quality rules, classifier, extraction, licences."""

import hashlib
import itertools
import math
import random
import time
import tracemalloc
import weakref
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from finloom.llm import bpe, licenses, quality_classifier, quality_rules, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", None, " ", "a", "Hello  world\n\n\n x", "naïve café — 日本語 🙂 don't", "\x1c\x85\xa0 1234567²", "a" * 3000, " " * 500 + "x", "\r\n\t\x0b", "\x00\x01"]


@pytest.fixture(scope="module")
def reference():
    return token_counts.encoding(PATH, public_tokenizers.PATTERN)


def test_bpe_equals_the_library_and_decodes(spark, reference):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)], "doc_id int, text string, decoded int")
    rows = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH)
    for r in rows.collect():
        assert r.token_ids == reference.encode_ordinary(ODD[r.doc_id] or "") and r.decoded == (ODD[r.doc_id] or "")
    d = {r.doc_id: r for r in bpe.digests(rows).collect()}
    assert d[4].ids_sha256 == hashlib.sha256(" ".join(map(str, reference.encode_ordinary(ODD[4]))).encode()).hexdigest()
    assert bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_bpe_round_trip_is_encode_and_decode_by_one_worker(spark, reference, capsys):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)], "doc_id int, text string, decoded int")
    rows = bpe.round_trip(docs, PATH, public_tokenizers.PATTERN)
    assert rows.columns == ["doc_id", "text", "decoded", "token_ids"]
    for r in rows.collect():
        assert r.token_ids == reference.encode_ordinary(ODD[r.doc_id] or "") and r.decoded == (ODD[r.doc_id] or "")
    bpe.digests(rows).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    assert bpe.round_trip(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_bpe_idle_workers_hold_no_tables(monkeypatch):
    monkeypatch.setattr(bpe, "IDLE_SECONDS", 0.1)
    texts = pa.array(["some words, and some more", None, "naïve 日本語"])
    first = bpe._ids(texts, PATH, public_tokenizers.PATTERN)
    held = weakref.ref(bpe._encoder(PATH, public_tokenizers.PATTERN))
    assert bpe._texts(first, PATH).to_pylist() == ["some words, and some more", "", "naïve 日本語"]
    assert held() is not None and bpe._token_bytes.cache_info().currsize
    ends = time.monotonic() + 20
    while time.monotonic() < ends and (held() is not None or bpe._token_bytes.cache_info().currsize):
        time.sleep(0.05)
    assert held() is None and not bpe._token_bytes.cache_info().currsize
    assert bpe._ids(texts, PATH, public_tokenizers.PATTERN).equals(first)


def test_bpe_states_are_few_bytes(reference):
    machine = bpe.Transducer(bpe.read_ranks(PATH))
    words = [random.Random(i).randbytes(6).hex() for i in range(300)]
    tracemalloc.start()
    got = [np.frombuffer(machine.encode_piece(w.encode()), np.int32).tolist() for w in words]
    machine.pairs, machine.halves = {}, {}
    size = tracemalloc.get_traced_memory()[0] / len(machine.moves.names)
    tracemalloc.stop()
    assert got == [reference.encode_ordinary(w) for w in words] and size < 550


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_bpe_any_text(text):
    coder = bpe._encoder(PATH, public_tokenizers.PATTERN)
    assert coder.encode(text).tolist() == token_counts.encoding(PATH, public_tokenizers.PATTERN).encode_ordinary(text)


def test_bpe_long_texts_are_cut_where_pieces_end(monkeypatch, reference):
    monkeypatch.setattr(bpe, "PART_CHARS", 7)
    text = "Those are words, don't you   see 12 34\n\n all  of them " * 20
    assert bpe._encoder(PATH, public_tokenizers.PATTERN).encode(text).tolist() == reference.encode_ordinary(text)


def test_bpe_bounded_memory_gives_the_same(monkeypatch, reference):
    monkeypatch.setattr(bpe, "MAX_STATES", 5)
    monkeypatch.setattr(bpe, "MAX_PIECES", 2)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 3)
    coder = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    text = "unbelievable antidisestablishmentarianism xylophonically zzzqj"
    assert coder.encode(text).tolist() == reference.encode_ordinary(text)


@given(st.text(max_size=40), st.lists(st.integers(0, 200), max_size=6))
def test_utf8_stream_equals_decoding_at_once(text, cuts):
    data, stream = text.encode("utf-8", "replace"), bpe.Utf8Stream()
    at = [0, *sorted(min(c, len(data)) for c in cuts), len(data)]
    assert "".join(stream.feed(data[a:b]) for a, b in zip(at, at[1:])) + stream.feed(b"", last=True) == data.decode()


@given(st.binary(max_size=40), st.lists(st.integers(0, 40), max_size=6))
def test_utf8_stream_of_any_bytes(data, cuts):
    stream = bpe.Utf8Stream()
    at = [0, *sorted(min(c, len(data)) for c in cuts), len(data)]
    assert "".join(stream.feed(data[a:b]) for a, b in zip(at, at[1:])) + stream.feed(b"", last=True) == data.decode("utf-8", "replace")


def test_bpe_patterns_whose_pieces_span_words_are_not_cut(monkeypatch):
    monkeypatch.setattr(bpe, "PART_CHARS", 5)
    whole, cut = bpe.Encoder(PATH, r"\p{L}+ \p{L}+|[\s\S]"), bpe.Encoder(PATH, public_tokenizers.PATTERN)
    text = "some words that go on"
    assert not whole.cuts and cut.cuts
    assert whole.encode(text).tolist() == token_counts.encoding(PATH, r"\p{L}+ \p{L}+|[\s\S]").encode_ordinary(text)


def plain_stats(text):
    text = text or ""
    norm = text
    for c in "\t\n\r\x0b\x0c":
        norm = norm.replace(c, " ")
    words = [w for w in norm.split(" ") if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 8)}
    lines, dup, seen = text.split("\n"), 0, set()
    for x in lines:
        if x.strip(" \t\r\x0b\x0c"):
            dup += x in seen
            seen.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_quality_statistics_equal_brute_force(spark):
    r = random.Random(2)
    texts = [None, "", "x\xa0y z", "# a\n# a\n\n \n# a", *(" ".join(r.choices("abc", k=n)) for n in (7, 8, 9, 30, 200)), " ".join(map(str, range(30))) + "\n" + " ".join(map(str, range(12)))]
    docs = spark.createDataFrame([(i, t, "en", None) for i, t in enumerate(texts)], "doc_id int, text string, lang string, source string")
    for x in quality_rules.verdicts(docs).collect():
        want = plain_stats(texts[x.doc_id])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (x.base_failed and x.kept)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("aAbé日🙂 \t\n\r\x0b\x0c\x85\xa0#*&"), max_size=200), st.integers(1, 9))
def test_quality_statistics_of_any_text_in_parts(text, part):
    was, quality_rules.PART_BYTES = quality_rules.PART_BYTES, part
    try:
        (x,) = quality_rules.statistics(pa.array([text])).to_pylist()
    finally:
        quality_rules.PART_BYTES = was
    assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == plain_stats(text)


def test_quality_outliers_go_and_clean_documents_stay(spark):
    r = random.Random(4)
    words = ["".join(r.choices("abcdefghij", k=r.randint(2, 9))) for _ in range(3000)]
    clean = [" ".join(r.choices(words, k=r.randint(25, 300))) for _ in range(300)]
    junk = [" ".join(w + "***" for w in r.choices(words, k=60)) for _ in range(40)]
    rows = [(i, t, "en" if i % 2 else None, "s", 1, 2) for i, t in enumerate(clean + junk)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, distance int, kept int")
    kept = {x.doc_id for x in quality_rules.reject(docs).collect()}
    assert kept == set(range(300))
    assert quality_rules.reject(docs).columns == docs.columns
    assert quality_rules.verdicts(docs.limit(0)).count() == 0


def test_quality_repeated_lines_alone_are_an_outlier(spark):
    r = random.Random(5)
    words = ["".join(r.choices("abcdefghij", k=r.randint(2, 9))) for _ in range(3000)]
    lines = lambda n: [" ".join(r.choices(words, k=r.randint(6, 14))) for _ in range(n)]
    clean = ["\n".join(lines(r.randint(5, 40))) for _ in range(200)]
    once = ["\n".join([*x, x[0]]) for x in (lines(10) for _ in range(5))]
    planted = ["\n".join(y for x in lines(n) for y in (x, "read more")) for n in (15, 20, 60)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(clean + once + planted)], "doc_id int, text string, lang string, source string")
    rows = {x.doc_id: x for x in quality_rules.verdicts(docs).collect()}
    assert not any(x.base_failed for x in rows.values())
    assert {i for i, x in rows.items() if not x.kept} == {205, 206, 207}


def test_quality_verdicts_hold_for_rows_without_ids_of_their_own(spark):
    words = lambda k: " ".join(f"w{(k * 7919 + i * 31) % 997}" for i in range(40))
    good = [(None if k % 2 else 7, words(k), "en", "s", {"k": k}) for k in range(70)]
    bad = [(None, "too short", "en", "s", {}), (7, None, "en", "s", {}), (7, "a b c d e f g h " * 50, None, None, {})]
    docs = spark.createDataFrame(good + bad, "doc_id int, text string, lang string, source string, `a.b` map<string, int>")
    got = quality_rules.reject(docs)
    assert got.schema == docs.schema
    by_text = lambda rows: sorted(map(tuple, rows), key=lambda r: r[1])
    assert by_text(got.collect()) == by_text(good)


def points(spark, groups):
    """Rows of whole-numbered statistics, a group each."""
    rows = [(0, f"={g}", "", *map(int, x)) for g, xs in enumerate(groups) for x in xs]
    return spark.createDataFrame(rows, "_qr_level int, _qr_lang string, _qr_source string, " + ", ".join(f"{x} long" for x in quality_rules.X))


def test_mcd_equals_brute_force(spark):
    """Of all subsets of three quarters of the rows none has a lower determinant."""
    r = np.random.default_rng(3)
    groups = []
    for _ in range(4):
        mix = r.normal(0, 1, (6, 6)) * 400
        clean = r.normal(0, 1, (12, 6)) @ mix
        groups.append(np.concatenate([clean, r.normal(0, 1, (4, 6)) * 300 + 9000]).round())
    found, _ = quality_rules.concentrated(points(spark, groups))
    got = {x._qr_lang: x for x in found.collect()}
    for g, xs in enumerate(groups):
        lowest = None
        for subset in itertools.combinations(range(16), 12):
            part = xs[list(subset)] / quality_rules.SCALE
            cov = quality_rules.floored(np.cov(part.T, bias=True) * quality_rules._consistency(0.75))
            lowest = min(lowest or (math.inf,), (np.linalg.slogdet(cov)[1], part.mean(axis=0).tolist()))
        x = got[f"={g}"]
        assert abs(x._qr_logdet - lowest[0]) < 1e-6 and np.allclose(x._qr_m, lowest[1])


def test_mcd_finds_an_outlier_against_the_correlation(spark):
    """One that neither the floors nor the spread of each statistic tell apart."""
    r = np.random.default_rng(5)
    a = r.normal(0, 500, (600, 1))
    xs = np.concatenate([a + r.normal(0, 60, (600, 1)), a + r.normal(0, 60, (600, 1)), r.normal(0, 100, (600, 4))], axis=1).round()
    outlier = np.array([700, -700, 0, 0, 0, 0])
    (x,) = quality_rules.mcd(points(spark, [np.concatenate([xs, [outlier] * 60])])).collect()
    gap, cov = outlier / quality_rules.SCALE - np.array(x._qr_m), np.array(x._qr_cov).reshape(6, 6)
    cut = quality_rules.chi2_quantile(quality_rules.TAIL, 6)
    assert gap @ np.linalg.inv(cov) @ gap > cut > gap @ np.diag(1 / np.diag(cov)) @ gap
    assert np.allclose(np.array(x._qr_inv).reshape(6, 6), np.linalg.inv(cov))


def test_quality_verdicts_do_not_depend_on_the_layout_of_rows(spark):
    r = random.Random(11)
    words = ["".join(r.choices("abcdefghij", k=r.randint(2, 9))) for _ in range(500)]
    docs = spark.createDataFrame([(i, " ".join(r.choices(words, k=r.randint(20, 90))) + "\n#" * r.randint(0, 9), r.choice("ab"), r.choice("xyz") if i % 3 else "hot") for i in range(300)], "doc_id int, text string, lang string, source string")
    key = lambda df: sorted(map(tuple, quality_rules.verdicts(df).collect()))
    assert key(docs.repartition(1)) == key(docs.repartition(7, "text"))


def test_chi_squared():
    assert abs(quality_rules.chi2_quantile(0.05, 4) - 9.487729) < 1e-5 and abs(quality_rules.chi2_cdf(9.487729, 4) - 0.95) < 1e-6


def labelled(spark):
    r = random.Random(6)
    good = ["".join(r.choices("abcdefghij", k=r.randint(2, 6))) for _ in range(300)]
    bad = [w.upper() + "$$" for w in good]
    rows = [(i, " ".join(r.choices(good if i % 3 else bad, k=80)), int(bool(i % 3))) for i in range(600)]
    return spark.createDataFrame(rows, "doc_id int, text string, quality int")


def test_classifier_on_texts_it_has_not_seen(spark):
    rows = labelled(spark)
    model = quality_classifier.train(rows.where("doc_id < 400"), rows.where("doc_id < 400"))
    got = quality_classifier.score(rows.where("doc_id >= 400"), model).collect()
    assert all((x.score >= 0.3) == bool(x.quality) and 0 <= x.score <= 1 for x in got)


def test_classifier_edge_cases(spark):
    rows = labelled(spark)
    model = quality_classifier.train(rows, rows)
    odd = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (None, "abc" * 100_000, "s")], "doc_id int, text string, x string")
    assert all(0 <= x.score <= 1 for x in quality_classifier.score(odd, model).collect())
    one = quality_classifier.score(odd, quality_classifier.train(rows.where("quality = 1"), rows.where("quality = 1"))).collect()
    assert {x.score for x in one} == {1.0}
    assert {x.score for x in quality_classifier.score(odd, quality_classifier.train(rows.limit(0), rows.limit(0))).collect()} == {0.5}


def test_licences(spark):
    mit = "MIT Licence\n\nCopyright (c) 2020 Some Body\n\n" + licenses.MIT.upper().replace(",", " ,")
    texts = [mit, "Words.\n  released under the MIT Licence!\nSPDX-License-Identifier: Apache-2.0", None, "", "Copyright 2020 X", "MIT"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, licence int")
    for rows in (1, 10**9):
        got = {r.doc_id: (r.text_licence, r.line_licences, r.n_licence_lines) for r in licenses.scan(docs, licenses.known_digests(spark), rows).collect()}
        assert got[0][0] == "MIT" and got[1] == (None, "Apache-2.0,MIT", 2)
        assert all(got[i] == (None, "", 0) for i in (2, 3, 4, 5))
    assert licenses.scan(docs.limit(0), licenses.known_digests(spark), 1).count() == 0


def test_licences_equal_the_sql_at_line_ends_and_repeats(spark):
    import duckdb

    odd = ["Some words.\rCopyright 2020 X and lots", "\r\nCopyright 2020 X\r\nAll rights reserved.\r\nMIT", "a\u0085(c) b", "x\u2028copyright y", "Licensed under CC BY 4.0.\r\nmore", "  # " + licenses.ZLIB.replace("\n\n", "\r\n# "), "MIT License\n" * 50_000, None, ""]
    rows = [(i, t, "en") for i, t in enumerate(odd)] + [(None, "Licensed under CC BY 4.0.", "en"), (None, "SPDX-License-Identifier: GPL-3.0-only", "en"), (4, odd[4], "en")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, licence string")
    got = licenses.scan(docs, licenses.known_digests(spark), len(licenses.KNOWN)).collect()
    con = duckdb.connect()
    con.execute("create table documents (doc_id int, text varchar, licence varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows)
    want = con.execute(licenses.oracle_sql()).fetchall()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r.doc_id: r.line_licences for r in got}[None] == "CC-BY-4.0,GPL-3.0"


def test_licences_of_whole_texts_and_of_a_folder(spark, tmp_path):
    whole = [("BSD-3-Clause", "BSD 3-Clause License\nCopyright (c) 1999, A\nAll rights reserved.\n" + licenses.BSD_2 + licenses.BSD_3 + licenses.BSD_END), ("Zlib", licenses.ZLIB), ("LGPL-2.1", licenses.gnu_notice(licenses.GNU["LGPL"], "2.1")), ("MPL-2.0", licenses.MPL_NOTICE.lower())]
    docs = spark.createDataFrame([(n, t) for n, t in whole], "doc_id string, text string")
    assert {r.doc_id: r.text_licence for r in licenses.scan(docs, licenses.known_digests(spark), 300).collect()} == {n: n for n, _ in whole}
    (tmp_path / "Own-1.0.txt").write_text("Do what you like.\nBut not that.")
    docs = spark.createDataFrame([(1, "DO what you like; but not that")], "doc_id int, text string")
    assert licenses.scan(docs, licenses.digests_of_folder(spark, str(tmp_path)), 1).first().text_licence == "Own-1.0"


def test_classifier_is_right_on_held_out_labels(spark):
    """A classifier without compression, by hand: the share of marked words, which separates these texts."""
    r = random.Random(12)
    words = ["".join(r.choices("abcdefghij", k=r.randint(2, 6))) for _ in range(300)]
    texts = [" ".join(w.upper() + "$$" if r.random() < (0.1 if i % 3 else 0.6) else w for w in r.choices(words, k=r.randint(20, 200))) for i in range(900)]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id int, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(900)] + [(0, 1), (3, None), (None, 1)], "doc_id int, quality int")
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    got = quality_classifier.score(docs, quality_classifier.train(docs, labels.where(~quality_classifier.held_out())))
    assert got.columns == docs.columns
    score = {x.doc_id: x.score for x in got.collect()}
    good, bad = [score[i] for i in held if i % 3], [score[i] for i in held if i % 3 == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    right = sum(g >= 0.3 for g in good) + sum(b < 0.3 for b in bad)
    error = abs(sum(score[i] for i in held) / len(held) - len(good) / len(held))
    assert auc > 0.98 and right > 0.95 * len(held) and error < 0.05
    by_hand = {i: 1 - texts[i].count("$$") / len(texts[i].split()) for i in held}
    assert sum((by_hand[i] > 0.65) == (score[i] >= 0.5) for i in held) > 0.95 * len(held)
