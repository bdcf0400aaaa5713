"""Operators that SQL text of both engines can't share: rows of words on a page, and reach over links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.plans.stored import stored

#: Words share a row if they overlap by this part of the smaller height.
OVERLAP = 0.45


def row_groups(words: DataFrame) -> DataFrame:
    """doc, page, word_id and row_no (from 0) of each word (doc, page, word_id, x0, y0, y1)."""
    return with_rows(words.select("doc", "page", "word_id", "x0", "y0", "y1"), ["doc", "page"]).select("doc", "page", "word_id", "row_no")


def with_rows(words: DataFrame, keys: list[str]) -> DataFrame:
    """words (word_id, x0, y0, y1 and any columns that can be sorted) with row_no (from 0) within keys, which name a page or a part of one.

    A sweep down the page: a word joins the row above it if they overlap enough, and widens it. The words of one page are held
    together as an array, which a page bounds; pages are spread over the cluster. Words without a place (null y0 or y1) are left out.
    All columns travel in the array, so words are shuffled once and meet no second time.
    """
    placed = words.where("y0 is not null and y1 is not null")
    first = ["y0", "x0", "y1", "word_id"]
    rest = [c for c in words.columns if c not in (*first, *keys)]
    pages = placed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*first, *rest))).alias("on_page"))
    start = F.struct(F.lit(None).cast("double").alias("top"), F.lit(None).cast("double").alias("bottom"), F.lit(-1).alias("row_no"), F.array().cast("array<int>").alias("rows"))

    def step(row, word):
        y0, y1 = word["y0"].cast("double"), word["y1"].cast("double")
        shared = F.least(row["bottom"], y1) - F.greatest(row["top"], y0)
        joins = (row["row_no"] >= 0) & (shared >= OVERLAP * F.least(row["bottom"] - row["top"], y1 - y0))
        no = F.when(joins, row["row_no"]).otherwise(row["row_no"] + 1)
        top, bottom = F.when(joins, F.least(row["top"], y0)).otherwise(y0), F.when(joins, F.greatest(row["bottom"], y1)).otherwise(y1)
        return F.struct(top.alias("top"), bottom.alias("bottom"), no.alias("row_no"), F.concat(row["rows"], F.array(no)).alias("rows"))

    swept = pages.select(*keys, "on_page", F.aggregate("on_page", start, step, lambda row: row["rows"]).alias("rows"))
    each = swept.select(*keys, F.inline(F.arrays_zip("on_page", "rows")))
    return each.select(*keys, "on_page.*", F.col("rows").alias("row_no"))


def reach(links: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """node and depth: all that the seeds (node) reach over links (src, dst) in so many hops, each at its least depth.

    Breadth first: each hop joins the newest nodes only, and leaves out what was found before.
    """
    edges = links.where("src is not null and dst is not null").select("src", "dst").distinct()
    newest = seeds.where("node is not null").select("node").distinct()
    found = newest.withColumn("depth", F.lit(0))
    for depth in range(1, hops + 1):
        newest = newest.join(edges, newest.node == edges.src).select(F.col("dst").alias("node")).distinct().join(found.select("node"), "node", "left_anti")
        found = found.unionByName(newest.withColumn("depth", F.lit(depth)))
    return found


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stand for pages, their lines for words."""
    lines = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    y0 = (F.col("l_linenumber") * 7 + F.col("l_partkey") % 13).cast("double")
    return row_groups(lines.select(F.col("l_orderkey").alias("doc"), F.lit(1).alias("page"), F.col("l_linenumber").alias("word_id"), F.col("l_partkey").cast("double").alias("x0"), y0.alias("y0"), (y0 + 12).alias("y1")))


def both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src and dst of every distinct pair of customer and supplier of any order's line, both ways; c and s keep their ids apart."""
    read = lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    lines = read("orders").join(read("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    pairs = lines.where("o_custkey is not null and l_suppkey is not null").select("o_custkey", "l_suppkey").distinct()
    customer, supplier = (F.concat(F.lit(mark), F.col(key).cast("string")) for mark, key in (("c", "o_custkey"), ("s", "l_suppkey")))
    ends = F.array(F.struct(customer.alias("src"), supplier.alias("dst")), F.struct(supplier.alias("src"), customer.alias("dst")))
    return pairs.select(F.inline(ends))


def _crawl(spark: SparkSession, sf_dir: str, seeds: str) -> DataFrame:
    customers = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet").where(seeds)
    return reach(stored(both_ways(spark, sf_dir), "links"), customers.where("c_custkey is not null").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node")), 3)


def crawl_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the customers of one segment reach in three hops over all links."""
    return _crawl(spark, sf_dir, SEGMENT)


def crawl_bfs_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all customers reach in three hops over all links."""
    return _crawl(spark, sf_dir, "true")


#: The segment whose customers are crawl_bfs's seeds.
SEGMENT = "c_mktsegment = 'BUILDING'"


def _crawl_sql(seeds: str) -> str:
    links = "pair as (select distinct 'c' || o_custkey as c, 's' || l_suppkey as s from orders join lineitem on l_orderkey = o_orderkey where o_custkey is not null and l_suppkey is not null), edge as (select c as src, s as dst from pair union all select s, c from pair)"
    walk = f"walk as (select 'c' || c_custkey as node, 0 as depth from customer where {seeds} union select dst, depth + 1 from walk join edge on src = node where depth < 3)"
    return f"with recursive {links}, {walk} select node, min(depth) as depth from walk group by node"


FRAMES = {"row_groups": order_rows, "crawl_bfs": crawl_bfs, "crawl_bfs_whole": crawl_bfs_whole}
FRAMES_SQL = {"crawl_bfs": _crawl_sql(SEGMENT), "crawl_bfs_whole": _crawl_sql("true")}
