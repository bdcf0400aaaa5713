"""Documents that keep coming: an inbox read once per content, facts that a new reading replaces, and the latest filing of each figure.

Extensions: the work the batch operators do, kept up to date by Structured Streaming.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.operators.review import upsert_facts
from finloom.sources.files import storage_key


def inbox_stream(spark: SparkSession, path: str, pattern: str = "*.pdf", delay: str = "1 day") -> DataFrame:
    """path, length, sha256, storage_key, modificationTime of each new content; the same content again within the delay is left out."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    found = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    hashed = found.select("path", "modificationTime", "length", F.sha2("content", 256).alias("sha256"))
    return hashed.withWatermark("modificationTime", delay).dropDuplicatesWithinWatermark(["sha256"]).withColumn("storage_key", storage_key("sha256"))


def replacing(read: Callable[[], DataFrame], write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: facts of the batch take the place of all that their documents had before; sent twice, it changes nothing more.

    A document that was read again without facts has one row with its document_id and no concept; what it had before goes.
    read gives the stored facts, write puts a whole new version in their place (a new folder or table version for each batch).
    """

    def batch(written: DataFrame, batch_id: int) -> None:
        write(upsert_facts(read(), written.where("concept is not null"), written.select("document_id")), batch_id)

    return batch


def latest_filings(reported: DataFrame, delay: str = "30 days") -> DataFrame:
    """company_id, concept, period_end and the value last filed so far: a running aggregate, in update or complete mode."""
    best = F.max_by(F.struct("value", "document_id"), F.struct("filed", "document_id"))
    rows = reported.withWatermark("filed", delay).groupBy("company_id", "concept", "period_end").agg(best.alias("b"))
    return rows.select("company_id", "concept", "period_end", "b.value", "b.document_id")
