"""Mixing sources to target weights by Poisson replication.

A source of n documents with target share w gets the mean repetition rate w * target / n. Each document draws its count by
inverting the Poisson distribution of that rate at a uniform number hashed from seed and doc_id, is exploded by the count, and
all copies are dealt out and ordered by a hash of (seed, doc_id, copy). Counts depend on nothing but seed, doc_id and rate, so a
task that runs again on another executor draws the same. The inversion looks at the distribution within SPREAD standard deviations
of its mean only, so its memory grows with the root of the rate; counts are exploded in portions, so no row holds a long list.

Defined results: a null source is a source of its own; a null doc_id draws like the text 'null'; rows that repeat a doc_id draw
the same count each; empty and null texts are documents like others, and texts of any length pass through; a source without a
weight (or with weight 0) yields no rows; an empty table gives no rows; a rate above MAX_RATE copies a document is an error;
columns named copy_no and shuffle_key are replaced, all others pass through, whatever their names.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from finloom.llm.common import few, settle

#: Up to this many sources the table of rates is broadcast; beyond it the join shuffles.
BROADCAST_SOURCES = 100_000
#: Beyond so many standard deviations, and 25 copies, nothing of the distribution is left that a 52-bit number could hit.
SPREAD = 12
MAX_RATE = 1e11
#: Copies are exploded in portions of so many.
PORTION = 10_000


def uniform(seed: int, doc_id: Column) -> Column:
    """In (0, 1), from the first 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def rates(docs: DataFrame, weights: dict[str | None, float] | None, temperature: float, epochs: float) -> DataFrame:
    """source, n, rate. Weights are shares of the target size (epochs times the input); without them n ** temperature."""
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
        counts = counts.withColumn("share", share)
    else:
        given = docs.sparkSession.createDataFrame(list(weights.items()), "w_source string, share double")
        counts = counts.join(given, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source").fillna(0.0, ["share"])
    counts = settle(counts, "source-counts")
    documents, shares = counts.agg(F.sum("n"), F.sum("share")).first()
    rate = F.col("share") / F.lit(float(shares or 1)) * F.lit((documents or 0) * float(epochs)) / F.col("n")
    return counts.select("source", "n", rate.alias("rate"))


@lru_cache(maxsize=16)
def cumulative(rate: float) -> tuple[int, np.ndarray]:
    """The first count that matters, and P(X <= k) from there on; by logarithms, so that large rates don't underflow."""
    low = max(0, math.floor(rate - SPREAD * math.sqrt(rate) - 25))
    high = math.ceil(rate + SPREAD * math.sqrt(rate) + 25)
    k = np.arange(low + 1, high + 1, dtype=float)
    steps = np.log(rate / k)  # log of P(k) / P(k - 1)
    if low:
        # Sum both ways from the mode, where the steps are small, and let the whole be 1.
        logs = np.concatenate([[0.0], np.cumsum(steps)])
        p = np.exp(logs - logs.max())
        return low, np.cumsum(p / p.sum())
    return low, np.cumsum(np.exp(np.concatenate([[0.0], np.cumsum(steps)]) - rate))


def poisson(u: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """The smallest counts k with P(X <= k) >= u."""
    out = np.zeros(len(u), np.int64)
    for value in np.unique(rate):
        if value > MAX_RATE:
            raise ValueError(f"a mean of {value:g} copies a document; lower the weight, or raise the number of documents")
        if value > 0:
            low, c = cumulative(float(value))
            at = rate == value
            out[at] = low + np.searchsorted(c, u[at])
    return out


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = 0.5, epochs: float = 1.0, seed: int = 17) -> DataFrame:
    """The columns of docs with copy_no (1, 2, ...) and shuffle_key, in random order by shuffle_key within random partitions."""

    def copies_of(u: pa.Array, rate: pa.Array) -> pa.Array:
        return pa.array(poisson(u.to_numpy(zero_copy_only=False), rate.to_numpy(zero_copy_only=False)))

    table = few(rates(docs, weights, temperature, epochs).where("rate > 0").select(F.col("source").alias("_mix_source"), F.col("rate").alias("_mix_rate")), BROADCAST_SOURCES)
    names = [c for c in docs.columns if c not in ("copy_no", "shuffle_key")]
    # The row is held as one struct, so that its columns may bear any name.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_mix_row"), F.col("source").alias("_mix_of"), F.col("doc_id").alias("_mix_id"))
    # Called nondeterministic, so that it runs once and not again for the filter.
    drawn = rows.join(table, F.col("_mix_of").eqNullSafe(F.col("_mix_source")))
    counted = drawn.select("_mix_row", "_mix_id", arrow_udf(copies_of, "long").asNondeterministic()(uniform(seed, F.col("_mix_id")), F.col("_mix_rate")).alias("n")).where("n > 0")
    portions = counted.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {PORTION}"))))
    first = F.col("portion") * PORTION
    copies = portions.withColumn("copy_no", F.explode(F.sequence(first + 1, F.least("n", first + PORTION))))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_mix_id").cast("string"), F.lit("null")), F.lit(":"), F.col("copy_no").cast("string")))
    return copies.select("_mix_row.*", "copy_no", key.alias("shuffle_key")).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def oracle_sql(temperature: float = 0.5, epochs: float = 1.0, seed: int = 17, table: str = "documents", columns: str = "doc_id, text, lang, source, n_chars") -> str:
    return f"""
    with counts as (select source, count(*) as n from {table} group by source),
    rates as (
        select source, pow(n::double, {float(temperature)}::double) / sum(pow(n::double, {float(temperature)}::double)) over () * (sum(n) over () * {float(epochs)}::double) / n as rate from counts
    ), ks as (select source, rate, unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 25)::int)) as k from rates),
    p as (
        select source, k, exp(k * ln(rate) - rate - sum(ln(greatest(k, 1)::double)) over (partition by source order by k rows between unbounded preceding and current row)) as p from ks
    ), c as (select source, k, sum(p) over (partition by source order by k rows between unbounded preceding and current row) as c from p),
    cdf as (select source, list(c order by k) as cdf from c group by source),
    drawn as (
        select d.*, len(list_filter(cdf, lambda x: x < (('0x' || substr(md5('{seed}:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint::double + 0.5) / 4503599627370496.0::double)) as reps
        from {table} d join cdf on d.source is not distinct from cdf.source
    ), copies as (select *, unnest(generate_series(1, reps)) as copy_no from drawn where reps > 0)
    select {columns}, copy_no::bigint as copy_no, md5('{seed}:' || coalesce(doc_id::varchar, 'null') || ':' || copy_no::varchar) as shuffle_key from copies
    """
