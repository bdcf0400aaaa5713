"""What the operators share: reading tables, and tables written to the shared folder to cut lineage."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the contracts define it, for SQL regular expressions.
SPACE = r"[\x20\x09-\x0D]"
#: Arrow batches are cut at this many rows, so that a batch of long texts stays small in a Python worker.
ARROW_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds; called by the operators that run Python over texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on one machine a local one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "/tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/finloom-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Rows in a file of a table of a few numbers a row.
ROWS_PER_FILE = 500_000


def settle(df: DataFrame, name: str, slim: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: computed once, without lineage, and safe when executors are lost.

    slim: rows of a few numbers, written to as few files as they need.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    if slim:
        held = keep(df)
        held.coalesce(1 + held.count() // ROWS_PER_FILE).write.parquet(path)
        held.unpersist()
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep(df: DataFrame) -> DataFrame:
    """Have df computed once, in memory or on the executors' disks; what a lost executor held is computed again from its lineage.

    For tables that a few later steps read. Loops cut their lineage with settle().
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


#: A table is broadcast below this size, counted as JSON.
BROADCAST_BYTES = 24 << 20


def few(df: DataFrame, most: int) -> DataFrame:
    """A table of a row per group, computed once in the shared folder; broadcast if its rows and bytes are counted and small."""
    held = settle(df, "groups")
    rows, size = held.agg(F.count("*"), F.sum(F.length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in held.columns)))).cast("long"))).first()
    return F.broadcast(held) if rows <= most and (size or 0) <= BROADCAST_BYTES else held


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def clear_shared(spark: SparkSession) -> None:
    """Delete all that settle() wrote in this application, once its results are stored."""
    remove(spark, shared_folder(spark))
