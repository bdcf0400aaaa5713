"""Candidates of the similarity join against all pairs, for names that begin alike."""

import difflib
import random

import pytest

from finloom.operators import entities


def names(draw, count):
    """Names of one beginning: half of them others with a few letters changed, added or left out."""
    out = set()
    while len(out) < count:
        if out and draw.random() < 0.5:
            name = list(draw.choice(sorted(out)))
            for _ in range(draw.randint(1, 3)):
                at = draw.randrange(3, len(name) + 1)
                name[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "b", "xy"])
            name = "".join(name)
        else:
            name = "mal" + "".join(draw.choice("abc ") for _ in range(draw.randint(0, 40)))
        out.add(" ".join(name.split()))
    return sorted(out)


@pytest.mark.parametrize("threshold", [0.93, 0.8])
def test_no_pair_is_lost(spark, threshold):
    draw = random.Random(5)
    keys = list(enumerate(names(draw, 300)))
    want = set()
    for x, a in keys:
        for y, b in keys:
            if x != y and 0 <= len(b) - len(a) <= entities.LENGTHS and (len(a) < len(b) or x < y) and a[:3] == b[:3] and difflib.SequenceMatcher(None, a, b).ratio() >= threshold:
                want.add((x, y))
    found = entities.candidates(spark.createDataFrame(keys, "company_id int, key string"), threshold).collect()
    got = {(r.x, r.y) for r in found}
    assert len(got) == len(found) and want and want <= got


def test_pairs_are_few_where_names_differ(spark):
    draw = random.Random(6)
    keys = [(i, "mal" + "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(17))) for i in range(2000)]
    assert entities.candidates(spark.createDataFrame(keys, "company_id int, key string")).count() < 2000
    assert entities.candidates(spark.createDataFrame([], "company_id int, key string")).count() == 0
