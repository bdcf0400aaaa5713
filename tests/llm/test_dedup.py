"""Exact and near dedup against brute force."""

import random

import pytest

from finloom.llm import exact_dedup, near_dup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, start=1):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts, start)], SCHEMA)


def test_exact_groups_ties_nulls_and_empties(spark):
    docs = frame(spark, ["a b", "ab", "a  b", None, "", " \t", "c", "c", "\xa0"])
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.verdicts(docs).collect()}
    assert got == {1: (3, 3, False), 2: (3, 3, False), 3: (3, 3, True), 4: (6, 3, False), 5: (6, 3, False), 6: (6, 3, True), 7: (7, 2, True), 8: (7, 2, False), 9: (9, 1, True)}
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 6, 7, 9]


def test_exact_null_id_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "x", 1, 2), (4, "x", 1, 2), (None, "y", 1, 2)], "doc_id long, text string, keep_id int, best int")
    got = sorted((r.text_sha256, r.doc_id is None, r.keep_id, r.kept) for r in exact_dedup.verdicts(docs).collect())
    assert [(a, b, c) for _, a, b, c in got] in ([(False, 4, True), (True, 4, False), (True, None, True)], [(True, None, True), (False, 4, True), (True, 4, False)])
    assert exact_dedup.deduplicate(docs).columns == docs.columns
    assert exact_dedup.verdicts(docs.limit(0)).count() == 0


def test_exact_columns_of_any_name_repeats_and_long_texts(spark):
    rows = [(1, "x y", 1, 2, {"a": 1}), (1, "xy ", 1, 2, {"a": 1}), (None, "q", 1, 2, None), (None, "q", 1, 2, None), (5, "z " * 2_000_000, 1, 2, None), (4, "z" * 2_000_000, 1, 2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _xd_len int, `a.b` int, hash map<string, int>")
    got = exact_dedup.deduplicate(docs)
    assert got.schema == docs.schema and sorted((r.doc_id or 0, len(r.text)) for r in got.collect()) == [(0, 1), (1, 3), (5, 4_000_000)]
    assert [(r.keep_id, r.group_size) for r in exact_dedup.verdicts(docs).collect() if r.doc_id in (4, 5)] == [(5, 2)] * 2


def plain_exact(rows):
    """doc_id, keep_id, group_size, kept of each row: the first of a group by length, then id, then place stays."""
    group = {}
    for at, (i, t) in enumerate(rows):
        group.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r"), []).append((-len(t or ""), i is None, i or 0, at, i))
    best = {k: min(v) for k, v in group.items()}
    return sorted(((i is not None, i or 0), str(best[k][4]), len(v), at == best[k][3]) for k, v in group.items() for *_, at, i in v)


def test_exact_rows_that_repeat(spark):
    rows = [(1, "a b"), (1, "ab"), (2, "ab"), (1, "a b"), (1, " ab"), (None, "q"), (None, "q"), (3, None), (3, ""), (3, None), (None, "q "), (7, "z"), (6, "z"), (6, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id is not None, r.doc_id or 0), str(r.keep_id), r.group_size, r.kept) for r in exact_dedup.verdicts(docs).collect())
    assert got == plain_exact(rows)
    assert sorted((r.doc_id or 0, r.text or "") for r in exact_dedup.deduplicate(docs).collect()) == [(0, "q "), (1, "a b"), (3, ""), (6, "z")]
    assert exact_dedup.deduplicate(docs).count() == 4


def test_near_dropped_rows_stay_dropped(spark):
    text, other = " ".join(f"w{i}" for i in range(30)), " ".join(f"v{i}" for i in range(30))
    docs = spark.createDataFrame([(5, text, "x"), (None, text, "y"), (None, other, "z"), (6, text + " more", "u")], "doc_id long, text string, digest string")
    assert sorted((r.doc_id or 0, r.digest) for r in near_dup.deduplicate(docs).collect()) == [(0, "z"), (5, "x")]


def brute(texts, width, percent):
    sets = []
    for t in texts:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\r\x0b\x0c":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {i + 1: (len(s), find(i) + 1) for i, s in enumerate(sets)}


@pytest.mark.parametrize("width, large", [(4, 1000), (5, 1)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, width, large):
    """Also where all groups of two and more are handled as large ones."""
    monkeypatch.setattr(near_dup, "MEMBERS_PER_TASK", large)
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", "  ", "One", "one", "one two", "ONE  two\n", "one two three", "a b c d e f g h i j k l m", "a b c d e f g h i j k l m n"]
    for _ in range(25):
        base = r.choices(vocabulary, k=r.choice([6, 12, 30, 80, 300]))
        texts.append(" ".join(base))
        for _ in range(r.randint(0, 6)):  # copies with few changes, and copies of copies
            base = list(base)
            for _ in range(r.choice([0, 1, 1, 2])):
                base[r.randrange(len(base))] = r.choice(vocabulary)
            texts.append(" ".join(base))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_dup.near_duplicates(frame(spark, texts), width, 80).collect()}
    assert got == brute(texts, width, 80)


def test_near_duplicates_edge_cases(spark):
    docs = spark.createDataFrame([(5, "a b c d e f", 1), (5, "a b c d e f", 1), (None, "a b c d e f", 1), (9, "a b c d e f", 1), (None, None, 1)], "doc_id long, text string, rep int")
    got = sorted((x.doc_id or 0, x.n_shingles, x.component_id, x.kept) for x in near_dup.near_duplicates(docs, 4).collect())
    assert got == [(0, 0, None, True), (0, 3, 5, False), (5, 3, 5, True), (5, 3, 5, True), (9, 3, 5, False)]
    assert near_dup.near_duplicates(docs.limit(0), 4).count() == 0
    assert near_dup.deduplicate(docs, 4).columns == docs.columns


def test_near_duplicates_same_set_in_another_order_and_long_texts(spark):
    a, b = "a b c d e", "f g h i j"
    texts = [f"{a} {b} {a} {b} {a}", f"{a} {b} {a}", "z " + "w " * 3_000_000, "z " + "w " * 3_000_001, None, None]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_dup.near_duplicates(frame(spark, texts), 4, 80).collect()}
    assert got == brute([t if len(t or "") < 1000 else t[:60] for t in texts], 4, 80)


def test_near_duplicates_of_a_template_that_are_none(spark):
    """Texts that share most words but too few: many candidates, no link."""
    template = [f"t{i}" for i in range(160)]
    texts = [" ".join(template[:80] + [f"u{k}_{i}" for i in range(40)] + template[80:]) for k in range(600)]
    texts += [texts[5] + " more", texts[17].replace("u17_3", "other")]
    got = {x.doc_id: x.component_id for x in near_dup.near_duplicates(frame(spark, texts), 5, 80).collect()}
    assert got == {k: {601: 6, 602: 18}.get(k, k) for k in range(1, 603)}


def test_estimate_is_near_the_true_similarity():
    import numpy as np
    import pyarrow as pa

    r = np.random.default_rng(1)
    for n in (30, 400, 5000):
        common, a, b = (np.sort(r.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2)) for k in (n, n // 5, n // 5))
        x, y = np.sort(np.concatenate([common, a])), np.sort(np.concatenate([common, b]))
        column = lambda h: pa.array([near_dup.registers(h).tobytes()])
        got = near_dup.estimated(column(x), column(y), pa.array([len(x)]), pa.array([len(y)]))[0].as_py()
        assert abs(got - n / (n + 2 * (n // 5))) < 0.12
