"""Readers and writers of files on small fixtures; rows of words against a plain sweep; reach on a small graph."""

import json

import pytest

from finloom import registry
from finloom.operators import layout
from finloom.sources import files


def rows(df, *by):
    return [tuple(r) for r in df.orderBy(*by).collect()]


def test_companies(spark, tmp_path):
    (tmp_path / "c.csv").write_text("stock_code,name,sector\n 1001 , One ,\n1002,Two, Tech \n1002,Two,Tech\n,None,\n")
    df = files.companies(spark, str(tmp_path / "c.csv"))
    assert rows(df, "stock_code") == [("1001", "One", None), ("1002", "Two", "Tech")]
    assert rows(files.companies(spark, str(tmp_path / "c.csv"), df.where("stock_code = '1001'")), "stock_code") == [("1002", "Two", "Tech")]


def test_market_values(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps([{"stock_code": "1001", "market_cap": 2e9}, {"stock_code": "1003", "market_cap": None}]))
    (tmp_path / "m.txt").write_text("LARGE 1001 One Name 9.50 x\nMID 1002A Two 1.25 y\nnothing here\n")
    assert rows(files.market_values(spark, str(tmp_path / "m.json"), str(tmp_path / "m.txt")), "stock_code") == [("1001", 2.0), ("1002A", 1.25)]


def test_link_list_and_roadmap(spark, tmp_path):
    (tmp_path / "l.txt").write_text("1001 see https://a.example.com/x.pdf here\nno code\n1002 no link\n")
    assert rows(files.link_list(spark, str(tmp_path / "l.txt")), "stock_code") == [("1001", "https://a.example.com/x.pdf", "a.example.com")]
    (tmp_path / "r.md").write_text("# Plan\n- [x] one\ntext\n## Later\n* [ ] two\n")
    assert rows(files.roadmap(spark, str(tmp_path / "r.md")).select("heading", "task", "done"), "task") == [("Plan", "one", True), ("Later", "two", False)]


def test_briefs(spark, tmp_path):
    (tmp_path / "2024-01-02.json").write_text(json.dumps({"date": "2024-01-02", "headline": "h", "items": []}))
    assert files.briefs(spark, str(tmp_path)).count() == 1
    for n, wrong in enumerate(('{"date": "2024-01-04", "headline": "h", "items": []}', '{"date": "2024-01-03", "other": 1}', '{"date": ', '{"headline": "h"}')):
        (tmp_path / str(n)).mkdir()
        (tmp_path / str(n) / "2024-01-03.json").write_text(wrong)
        with pytest.raises(Exception):
            files.briefs(spark, str(tmp_path / str(n))).collect()


def test_inbox(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, content in (("a.pdf", b"x"), ("sub/b.pdf", b"x"), ("c.pdf", b"y"), ("d.txt", b"z")):
        (tmp_path / name).write_bytes(content)
    df = files.inbox(spark, str(tmp_path))
    assert sorted(r.path.rsplit("/", 1)[1] for r in df.collect()) == ["a.pdf", "c.pdf"]
    assert all(r.storage_key == f"{r.sha256[:2]}/{r.sha256[2:4]}/{r.sha256}.pdf" for r in df.collect())
    assert files.inbox(spark, str(tmp_path), df).count() == 0


def test_writers(spark, tmp_path):
    facts = spark.createDataFrame([(2, 2020, "b", 12.5), (1, 2020, "a", 1500000.0), (1, 2021, "a", None), (1, 2019, "a", -0.25), (1, 2018, "a", 100.0)], "company_id long, fy int, concept string, value double")
    files.write_long_csv(facts, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), header=True, inferSchema=False)
    assert rows(back, "company_id", "fy") == [("1", "2018", "a", "100"), ("1", "2019", "a", "-0.25"), ("1", "2020", "a", "1500000"), ("2", "2020", "b", "12.5")]
    files.write_report(facts, str(tmp_path / "json"))
    assert {r.company_id: len(r["items"]) for r in spark.read.json(str(tmp_path / "json")).collect()} == {1: 4, 2: 1}


def sweep(words):
    out, top, bottom, no = {}, None, None, -1
    for y0, _, y1, word in sorted(words):
        if no >= 0 and min(bottom, y1) - max(top, y0) >= 0.45 * min(bottom - top, y1 - y0):
            top, bottom = min(top, y0), max(bottom, y1)
        else:
            top, bottom, no = y0, y1, no + 1
        out[word] = no
    return out


def test_row_groups(spark):
    words = [(d, 1, i, float(i * 7 % 5), float(i * 6 + i * d % 7), float(i * 6 + i * d % 7 + 11)) for d in range(20) for i in range(30)] + [(50, 1, 1, 0.0, None, 3.0)]
    got = {}
    for r in layout.row_groups(spark.createDataFrame(words, "doc int, page int, word_id int, x0 double, y0 double, y1 double")).collect():
        got.setdefault(r.doc, {})[r.word_id] = r.row_no
    assert got == {d: sweep([(y0, x0, y1, w) for dd, _, w, x0, y0, y1 in words if dd == d]) for d in range(20)}


def test_reach(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (7, 8), (None, 1)], "src int, dst int")
    assert rows(layout.reach(links, spark.createDataFrame([(1,), (1,)], "node int"), 3), "node") == [(1, 0), (2, 1), (3, 2), (4, 3)]


def test_reach_over_all_links_of_the_tables(spark):
    import pyarrow.parquet as pq

    sf = "/root/testdata/sf0.001"
    column = lambda table, name: pq.read_table(f"{sf}/{table}.parquet", columns=[name])[name].to_pylist()
    buyer = dict(zip(column("orders", "o_orderkey"), column("orders", "o_custkey")))
    pairs = {(f"c{buyer[k]}", f"s{s}") for k, s in zip(column("lineitem", "l_orderkey"), column("lineitem", "l_suppkey")) if k in buyer}
    links = pairs | {(b, a) for a, b in pairs}
    assert sorted(map(tuple, layout.both_ways(spark, sf).collect())) == sorted(links)

    def walk(seeds):
        depths, newest = dict.fromkeys(seeds, 0), set(seeds)
        for depth in (1, 2, 3):
            newest = {b for a, b in links if a in newest} - depths.keys()
            depths.update(dict.fromkeys(newest, depth))
        return depths

    customers = [f"c{c}" for c in column("customer", "c_custkey")]
    whole = registry.queries()["crawl_bfs_whole"](spark, sf).collect()
    assert sorted(map(tuple, whole)) == sorted(walk(customers).items())
    assert {d for _, d in whole} == {0, 1}
    one = sorted({a for a, _ in pairs})[:1]
    deep = layout.reach(layout.both_ways(spark, sf), spark.createDataFrame([(c,) for c in one], "node string"), 3).collect()
    assert sorted(map(tuple, deep)) == sorted(walk(one).items()) and {d for _, d in deep} >= {0, 1, 2}
