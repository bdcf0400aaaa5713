"""Activity over an event stream: one row per event id, then counts in tumbling windows. An extension; the batch form is activity_windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_events(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Drop events that come again; state is kept no longer than the lateness allows."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["event_id"])


def windowed_counts(events: DataFrame, width: str = "1 hour", lateness: str = "1 hour") -> DataFrame:
    """start, event_type, n for each window that the watermark has passed."""
    counted = unique_events(events, lateness).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), "event_type", "n")
