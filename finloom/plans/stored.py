"""Tables written once to the folder that driver and executors share, for plans that read them several times."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df under spark.checkpoint.dir and read it back: computed once, without lineage, and safe when executors are lost."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "/tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/finloom-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
