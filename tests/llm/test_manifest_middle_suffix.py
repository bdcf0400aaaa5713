"""Merkle manifest, fill-in-middle and repeated passages against plain Python, with nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from finloom.llm import fim, merkle, suffix_dedup

DOCS = "doc_id long, source string, lang string, n_chars long, text string, grp string"


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def plain_root(digests):
    while len(digests) > 1:
        digests = [sha("".join(digests[i : i + 8])) for i in range(0, len(digests), 8)]
    return digests[0]


def plain_proof(digests, at):
    out = []
    while len(digests) > 1:
        run = at // 8 * 8
        out.append(("".join(digests[run:at]), "".join(digests[at + 1 : run + 8])))
        digests, at = [sha("".join(digests[i : i + 8])) for i in range(0, len(digests), 8)], at // 8
    return out


def plain_leaf(row, text):
    fields = [row[0], row[1], row[2], row[3], text]
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def plain_audit(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(row, row[4]), row))
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    ordered = {k: sorted(groups[k], key=lambda x: x[:3]) for k in order}
    tops = [plain_root([x[2] for x in ordered[k]]) for k in order]
    out = []
    for n, k in enumerate(order):
        leaves = [x[2] for x in ordered[k]]
        for at, (_, _, leaf, row) in enumerate(ordered[k]):
            path = plain_proof(leaves, at) + plain_proof(tops, n)
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                node = plain_leaf(row, row[4] and re.sub("[A-Z]", lambda m: m[0].lower(), row[4]))
            for before, after in path:
                node = sha(before + node + after)
            out.append((row[0], leaf, tops[n], plain_root(tops), sha("".join(a + b for a, b in path)), node, node == plain_root(tops)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("size", [0, 1, 8, 9, 150])
def test_manifest_equals_plain_trees(spark, size):
    draw = random.Random(size)
    rows = [(i, draw.choice(["a", None]), draw.choice(["en", "en", "en", "fr", None, ""]), i * 3, draw.choice(["Text É", "", None, "x" * 3000, f"Doc {i}"]), "clash") for i in range(size)]
    rows += [(None, "s", "en", None, None, None), (None, "s", "en", 5, "other", None), (0, "s", "en", 1, "Again", None), (0, "s", "en", 1, "Again", None)] * (size > 8)
    got = [tuple(r) for r in merkle.audit(spark.createDataFrame(rows, DOCS)).collect()]
    assert ordered(got) == ordered(plain_audit(rows))
    assert size == 0 or any(r[-1] for r in got)


def plain_middle(doc_id, text):
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text or "")
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    text = text or ""
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_middle_equals_plain_cuts_and_restores(spark, monkeypatch):
    monkeypatch.setattr(fim, "COPIES", 5)
    texts = ["", None, " ", "\t\n a  b ", "word", "a b c d e f g", "é ü 😀 x\x0by", "has <P> in it", "ends <P", "<S", "nbsp stays", " ".join(f"w{i}" for i in range(5000)), "a" * 100_000]
    rows = [(i, texts[i % len(texts)]) for i in range(400)] + [(None, "a b c"), (7, texts[7]), (7, "other"), (None, "a b c")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ends string")
    made = fim.transform(frame).cache()
    assert ordered(tuple(r) for r in made.collect()) == ordered(plain_middle(*r) for r in rows)
    back = made.select("doc_id", fim.restore(made["output"], made["form"]).alias("text"))
    assert ordered(tuple(r) for r in back.collect()) == ordered((i, t or "") for i, t in rows)
    assert {r.form for r in made.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    assert fim.digests(fim.transform(frame.limit(0))).collect() == []


def test_lists_select_what_they_hold():
    draw = np.random.default_rng(1)
    for n in (1, 2, 511, 512, 513, 4000):
        for widest in (1, 2, 3, 900):
            values = np.cumsum(draw.integers(1, widest + 1, n))
            data = fim.ef_encode(values)
            assert [fim.ef_select(data, k) for k in range(n)] == values.tolist()
    assert len(fim.ef_encode(np.cumsum(draw.integers(1, 12, 4000)))) * 8 < 4000 * 8


def plain_suffix(rows, size):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc_id, len(t), sum(gone), runs, sha(bytes(b for b, x in zip(t, gone) if not x))))
    return out


def passages(draw, words):
    make = lambda n: "".join(draw.choice(words) for _ in range(n))
    base = [make(300) for _ in range(6)]
    rows = [(i, make(draw.randint(0, 250))) for i in range(12)]
    for i in range(30):
        one = draw.choice(base)
        cut = draw.randint(0, len(one))
        rows.append((100 + i, one[:cut] + draw.choice(["", "Ä", "!", make(20)]) + one[cut + draw.randint(0, 3) :]))
    rows += [(200, make(40) + base[0][:399]), (201, make(40) + base[0][:400]), (202, base[1] + base[1]), (203, "a" * 900), (204, "ab" * 300), (205, "z" * 401), (206, "y" * 400), (207, ""), (208, None)]
    rows += [(None, base[2]), (None, make(200)), (209, make(210)), (209, make(210))]
    return rows + [rows[0], rows[0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes_equal_all_windows(spark, seed, monkeypatch):
    draw = random.Random(seed)
    rows = passages(draw, ["alpha ", "beta ", "γάμμα ", "d", "\n"] if seed == 1 else ["ab", "a"])
    if seed == 2:
        monkeypatch.setattr(suffix_dedup, "BLOCK", 128)
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, h int")
    made = suffix_dedup.deduplicate(frame).cache()
    assert ordered(tuple(r) for r in suffix_dedup.digests(made).collect()) == ordered(plain_suffix(rows, suffix_dedup.WINDOW))
    for r in made.where("doc_id = 201").collect():
        text = next(t for i, t in rows if i == 201).encode()
        assert b"".join(text[a:b] for a, b in zip([0, *(s.stop for s in r.spans)], [*(s.start for s in r.spans), len(text)])) == bytes(r.kept)
    assert suffix_dedup.deduplicate(frame.limit(0)).collect() == []
