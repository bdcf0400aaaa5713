"""Exact ranks and quantiles of groups of any size: a distributed sort, counts of its parts, and sums within parts.

Distinct values are counted first, then ordered by range over the cluster together with their groups. A group may span many parts:
the counts of its parts before one's own give the offset, and a running sum within the part gives the place. No task holds a group,
and equal values, however many, are one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finloom.plans.stored import stored


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys that may be null, with the columns of left first."""
    theirs = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, (left[k].eqNullSafe(theirs[f"_r_{k}"]) for k in keys))
    return left.join(theirs, on, how).drop(*(f"_r_{k}" for k in keys))


def places(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value, equal, below, n: for each distinct value of a group how many have it, how many are less, and how many there are.

    Null values are left out. The ordered table is written once, so its parts are the same for all who read it.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("equal"))
    held = stored(counts.orderBy(*keys, value).withColumn("_part", F.spark_partition_id()), "places")
    sums = held.groupBy(*keys, "_part").agg(F.sum("equal").alias("_m"))
    group = Window.partitionBy(*keys)
    offsets = sums.withColumns({"_before": F.sum("_m").over(group.orderBy("_part")) - F.col("_m"), "n": F.sum("_m").over(group)}).drop("_m")
    local = Window.partitionBy(*keys, "_part").orderBy(value)
    placed = joined(held, offsets, [*keys, "_part"])
    return placed.withColumn("below", F.col("_before") + F.sum("equal").over(local) - F.col("equal")).select(*keys, value, "equal", "below", "n")


def quantiles(placed: DataFrame, keys: list[str], value: str, named: dict[str, float]) -> DataFrame:
    """keys, n and a column for each named quantile, between the two values around (n - 1) * q; placed: places() of the same keys."""
    pick = lambda at: F.max(F.when((F.col("below") <= at) & (at < F.col("below") + F.col("equal")), F.col(value)))
    each, out = {}, []
    for name, q in named.items():
        place = (F.col("n") - 1) * F.lit(q)
        each[f"_{name}_lo"], each[f"_{name}_hi"] = pick(F.floor(place)), pick(F.ceil(place))
        part = place - F.floor(place)
        out.append(((1 - part) * F.col(f"_{name}_lo") + part * F.col(f"_{name}_hi")).alias(name))
    found = placed.groupBy(*keys).agg(F.first("n").alias("n"), *(x.alias(c) for c, x in each.items()))
    return found.select(*keys, "n", *out)
