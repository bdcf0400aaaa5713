"""Every query of the fact model against its DuckDB twin, on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from finloom import registry
from finloom.plans.facts import TABLES
from finloom.streaming import activity

SF = "/root/testdata/sf0.001"
#: Queries for which the smallest tables are too small: a second page, flags of peers, and equal company names.
EMPTY = {"review_page", "peer_flags", "company_dup_exact"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.8g}"
    return "null" if value is None else str(int(value)) if isinstance(value, bool) else str(value)


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_duckdb(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    result = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = sorted(tuple(plain(v) for _, v in sorted(zip(columns, row))) for row in result.fetchall())
    got = sorted(tuple(plain(v) for _, v in sorted(zip(df.columns, row))) for row in df.collect())
    assert got == want and (got or name in EMPTY)


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert rows and {"company_id", "net_margin", "place", "sector_median"} <= set(rows[0].asDict())


def test_parse_numbers_golden(spark):
    rows = {r.raw: r.number for r in registry.queries()["parse_numbers"](spark, SF).collect()}
    some = {k: v for k, v in rows.items() if k in ("n/a", "(6.50)", "RM 7,000", "8-", "10.5%", "Note 11")}
    assert some == {k: {"n/a": None, "(6.50)": -6.5, "RM 7,000": 7000.0, "8-": -8.0, "10.5%": 10.5, "Note 11": None}[k] for k in some}


def test_streamed_windows_equal_batch(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    rows = [(i % 50, at + datetime.timedelta(minutes=7 * (i % 50)), "view" if i % 2 else "click") for i in range(60)] + [(99, at + datetime.timedelta(days=2), "view")]
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string")
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    query = activity.windowed_counts(stream).writeStream.format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("windows").selectExpr("sum(n)").first()[0] == 50
