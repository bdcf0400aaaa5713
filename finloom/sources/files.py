"""Files in and out: company and listing CSV, market values, link lists, roadmaps, daily documents, an inbox, long CSV.

Readers take paths that Spark reads and return DataFrames; a table that lacks a row's key leaves the row out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A daily document.
BRIEF = "date string, headline string, items array<struct<code: string, kind: string, text: string>>"
BRIEF_FIELDS = ["date", "headline", "items"]


def companies(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """stock_code, name, sector from CSV: trimmed, blank sectors null, one row per code, without the codes of known."""
    rows = spark.read.csv(path, header=True, schema="stock_code string, name string, sector string")
    clean = rows.select(F.trim("stock_code").alias("stock_code"), F.trim("name").alias("name"), F.nullif(F.trim("sector"), F.lit("")).alias("sector"))
    first = clean.where("stock_code <> ''").groupBy("stock_code").agg(F.min(F.struct("name", "sector")).alias("r")).select("stock_code", "r.name", "r.sector")
    return first if known is None else first.join(known.select("stock_code"), "stock_code", "left_anti")


def market_values(spark: SparkSession, json_path: str, text_path: str) -> DataFrame:
    """stock_code and market_cap in billions: JSON rows (in units) before lines like `LARGE 1234 Some Name 5.60 ...`."""
    words = F.filter(F.split("value", r"\s+"), lambda w: w != "")
    rows = spark.read.text(text_path).select(words.alias("w"))
    # A line is a group, a code, a name of any number of words, and figures, of which the first with decimals counts.
    figures = F.filter(F.slice("w", 4, 1000), lambda w: w.rlike(r"^\d+\.\d+$"))
    listed = rows.where("size(w) >= 4").select(F.get("w", F.lit(1)).alias("stock_code"), F.get(figures, F.lit(0)).try_cast("double").alias("by_text"))
    listed = listed.where(F.col("stock_code").rlike("^[0-9]{4}[A-Z]?$")).groupBy("stock_code").agg(F.max("by_text").alias("by_text"))
    reported = spark.read.json(json_path, schema="stock_code string, market_cap double", multiLine=True).where("market_cap <> 0")
    reported = reported.groupBy("stock_code").agg((F.max("market_cap") / 1e9).alias("by_json"))
    return reported.join(listed, "stock_code", "full").select("stock_code", F.coalesce("by_json", "by_text").alias("market_cap"))


def link_list(spark: SparkSession, path: str) -> DataFrame:
    """stock_code, url and host of each line that has both a code and an address."""
    found = spark.read.text(path).select(F.regexp_extract("value", r"\b(\d{4}[A-Z]?)\b", 1).alias("stock_code"), F.regexp_extract("value", r"(https?://[^\s)\]]+)", 1).alias("url"))
    return found.where("stock_code <> '' and url <> ''").withColumn("host", F.expr("try_parse_url(url, 'HOST')"))


def roadmap(spark: SparkSession, path: str) -> DataFrame:
    """heading, task and done of each checkbox of a Markdown file, under the last heading above it."""
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\n")).alias("line_no", "value"))
    above = Window.partitionBy("file").orderBy("line_no")
    heading = F.last(F.nullif(F.regexp_extract("value", r"^#+\s+(.*\S)", 1), F.lit("")), ignorenulls=True).over(above)
    box = r"^\s*[-*]\s+\[([ xX])\]\s+(.*\S)"
    return lines.withColumn("heading", heading).where(F.col("value").rlike(box)).select("file", "line_no", "heading", F.regexp_extract("value", box, 2).alias("task"), (F.lower(F.regexp_extract("value", box, 1)) == "x").alias("done"))


def briefs(spark: SparkSession, path: str) -> DataFrame:
    """Daily JSON documents, a file each; reading fails on a malformed one, on fields beyond the schema's and on a date that isn't the file's name."""
    raw = spark.read.text(path, wholetext=True)
    named = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    more = F.array_except(F.json_object_keys("value"), F.array(*map(F.lit, BRIEF_FIELDS)))
    checked = raw.select(F.from_json("value", BRIEF, {"mode": "FAILFAST"}).alias("r"), named.alias("named"), more.alias("more"))
    right = F.coalesce((F.size("more") == 0) & (F.col("named") == F.col("r.date")), F.lit(False))
    return checked.where(F.assert_true(right, F.concat(F.lit("not a daily document: "), F.col("named"))).isNull()).select("r.*")


def storage_key(digest: str) -> F.Column:
    """Path of content by its digest: aa/bb/digest.pdf."""
    return F.concat_ws("/", F.substring(digest, 1, 2), F.substring(digest, 3, 2), F.concat(F.col(digest), F.lit(".pdf")))


def inbox(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """path, length, sha256 and storage_key of each new content below path; of equal files the least path stays."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(path)
    hashed = found.select("path", "length", F.sha2("content", 256).alias("sha256"))
    new = hashed.groupBy("sha256").agg(F.min(F.struct("path", "length")).alias("r")).select("r.path", "r.length", "sha256")
    new = new if known is None else new.join(known.select("sha256"), "sha256", "left_anti")
    return new.withColumn("storage_key", storage_key("sha256"))


def plain(value: str) -> F.Column:
    """A decimal as text, without trailing zeros or an exponent."""
    text = F.col(value).cast("decimal(38,4)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def write_long_csv(facts: DataFrame, path: str) -> None:
    """facts (company_id, fy, concept, value) as CSV files, sorted over all files; values as plain decimal text."""
    rows = facts.where("value is not null").select("company_id", "fy", "concept", plain("value").alias("value"))
    rows.orderBy("company_id", "fy", "concept").write.mode("overwrite").csv(path, header=True)


def write_report(items: DataFrame, path: str) -> None:
    """Nested JSON: a line per company with its items."""
    rest = [c for c in items.columns if c != "company_id"]
    items.groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("items")).write.mode("overwrite").json(path)
