"""Places and quantiles of groups against plain sorting, with ties, nulls, hot groups and groups of one."""

import random

import numpy as np
import pytest

from finloom.operators import order_stats


def test_places_and_quantiles_equal_plain_sorting(spark):
    draw = random.Random(4)
    rows = [("hot", draw.choice([0.0, 0.0, 1.5, draw.random()])) for _ in range(900)] + [(k, float(draw.randint(-3, 3))) for k in ("a", "b", None) for _ in range(40)] + [("one", 7.0), ("none", None)]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(7)
    placed = order_stats.places(frame, ["k"], "v").cache()
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    want = sorted((str(k), v, g.count(v), sum(x < v for x in g), len(g)) for k, g in groups.items() for v in set(g))
    assert sorted((str(r.k), r.v, r.equal, r.below, r.n) for r in placed.collect()) == want
    found = {r.k: (r.n, r.low, r.mid, r.high) for r in order_stats.quantiles(placed, ["k"], "v", {"low": 0.1, "mid": 0.5, "high": 0.75}).collect()}
    assert set(found) == set(groups)
    for k, g in groups.items():
        assert found[k] == pytest.approx((len(g), *np.quantile(g, [0.1, 0.5, 0.75])))
    assert order_stats.places(frame.limit(0), ["k"], "v").collect() == []


def test_no_window_holds_a_group(spark):
    """Windows are over parts of the ordered table, or over the counts of parts."""
    frame = spark.createDataFrame([("a", 1.0)], "k string, v double")
    plan = order_stats.places(frame, ["k"], "v")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("_part" in line or "_m" in line for line in windows)
