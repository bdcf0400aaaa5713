"""Exact dedup: group by a 128-bit content hash, compare bytes inside each group, keep one row. Native expressions only.

The grouping key is (MD5, normalised text). MD5 spreads the rows and orders the local sorts; the text beside it makes Spark
compare bytes within each hash. Each map task sends one row per distinct text, however many copies it saw. Who stays is decided over
digests (MD5 and SHA-256) and sizes alone, which are written once; the groups of texts then confirm that each digest has one text, or
end the job with an error. Verdicts join back by digests; a digest with a third of all rows is a skewed side that adaptive execution
splits.

Defined results: a null text is empty, and all empty texts form one group; of equal texts the one with the most code points
stays, then the smallest doc_id; a null doc_id loses to any other. Of rows that repeat a document in all of this (the same doc_id,
normalised text and number of code points), one stays; deduplicate() takes the greatest by its columns written as JSON. Texts of any
length are read whole. An empty table gives no rows. Further columns pass through deduplicate() untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.llm.common import settle

#: The characters that normalising deletes.
DELETED = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), DELETED, "")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, size, norm, hash, sha of each row."""
    rows = docs.select(F.col(doc_id).alias("id"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("size"), normalised(F.col(text)).alias("norm"))
    return rows.withColumns({"hash": F.md5("norm"), "sha": F.sha2("norm", 256)})


def _groups(slim: DataFrame, keyed: DataFrame) -> DataFrame:
    """One row per distinct normalised text: its digests, the id and size that stay, how many rows have both (ties), group_size.

    slim: id, size, hash, sha of each row; keyed: those with the normalised texts, whose bytes are compared by grouping.
    """
    counted = slim.groupBy("hash", "sha", "id", "size").agg(F.count("*").alias("ties"))
    order = F.struct((-F.col("size")).alias("a"), F.col("id").isNull().alias("b"), "id")
    best = counted.groupBy("hash", "sha").agg(F.min_by(F.struct("id", "size", "ties"), order).alias("best"), F.sum("ties").alias("group_size"))
    texts = keyed.groupBy("hash", "norm").agg(F.count("*").alias("rows")).select("hash", F.sha2("norm", 256).alias("sha"), "rows")
    sure = F.when(F.col("rows") == F.col("group_size"), F.col("group_size")).otherwise(F.raise_error(F.concat(F.lit("texts differ under one pair of digests: "), "sha")).cast("long"))
    return best.join(texts, ["hash", "sha"]).select("hash", "sha", F.col("best.id").alias("keep_id"), F.col("best.size").alias("keep_size"), F.col("best.ties").alias("ties"), sure.alias("group_size"))


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    keyed = _keyed(docs, doc_id, text)
    slim = settle(keyed.drop("norm"), "exact-rows")
    groups = _groups(slim, keyed)
    out = lambda kept: [F.col("id").alias("doc_id"), "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256")]
    first = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("size") == F.col("keep_size"))
    met = slim.join(groups, ["hash", "sha"]).where(~first | (F.col("ties") == 1))
    # Rows that tie for the place are told apart by a number only.
    tied = groups.where("ties > 1").withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("ties")))).withColumn("id", F.col("keep_id"))
    return met.select(*out(first)).unionByName(tied.select(*out(F.col("nth") == 1)))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, with their columns."""
    keyed = _keyed(docs, doc_id, text)
    groups = settle(_groups(settle(keyed.drop("norm"), "exact-rows"), keyed), "exact-groups")
    # The row is held as one struct, so that its columns may bear any name.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), normalised(F.col(text)).alias("norm"))
    rows = rows.select("row", F.col(f"row.`{doc_id}`").alias("id"), F.length(F.coalesce(F.col(f"row.`{text}`"), F.lit(""))).alias("size"), F.md5("norm").alias("hash"), F.sha2("norm", 256).alias("sha"))
    stays = groups.select("hash", "sha", F.col("keep_id"), F.col("keep_size").alias("size"), "ties")
    kept = rows.join(stays, ["hash", "sha", "size"]).where(F.col("id").eqNullSafe(F.col("keep_id")))
    tied = kept.where("ties > 1").groupBy("hash", "sha").agg(F.max_by("row", F.to_json("row")).alias("row"))
    return kept.where("ties = 1").select("row.*").unionByName(tied.select("row.*"))


ORACLE_SQL = r"""
with t as (
    select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents
), r as (
    select doc_id, norm, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size, row_number() over w as place from t window w as (partition by norm order by n desc, doc_id nulls last)
)
select doc_id, keep_id, group_size, place = 1 as kept, sha256(norm) as text_sha256 from r
"""
