"""Near-duplicates of word shingles by HyperMinHash.

Sketch: each distinct shingle is hashed once; the top bits choose one of 512 buckets, and a bucket stores, for its smallest hash,
the number of leading zeros and the ten bits after the first one (16 bits in all). Empty buckets copy one that others of the same
set fill, by a probing order that all sets share. Bands of eight registers are the candidate keys: a pair of similarity 0.8 misses
all 64 bands with probability 8e-6, one of 0.3 meets in 0.4 % of cases.

Links: documents with the same words in the same order (by a cryptographic hash of 128 bits) have the same set, so they are one
class and only its representative goes on. In each bucket of a band the member that
shares most buckets with others is the centre, and each class is first compared with the best centre it meets, so a group of
thousands of near copies costs a comparison each. Connected classes are then joined; where a bucket still holds several components,
all pairs across them are compared by their registers, in blocks. No pair within a component needs comparing, as it can't change the result. A comparison is:
sizes that allow the similarity; the collision-corrected Jaccard estimate, with five standard errors of leeway; then the full sets.

Defined results: a null or empty text has no set and is linked with nothing; a text of fewer words than a shingle is one shingle;
very long texts are read whole; rows that repeat a doc_id are the same document and must carry the same text; a null doc_id gets its group's component but is never
its name (alone, its component is null and it is kept); an empty table gives no rows; further columns are ignored or passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from finloom.llm.common import few, keep, settle, small_batches

BUCKET_BITS, MANTISSA_BITS, BAND_ROWS = 9, 10, 8
BUCKETS = 1 << BUCKET_BITS
BANDS = BUCKETS // BAND_ROWS
#: Mean share of registers that agree by chance, for sets of equal size (Yu and Weber, HyperMinHash).
CHANCE = 0.169919487159739 * 2.0**-MANTISSA_BITS
#: A centre's members are dealt to tasks by about so many, however many it has.
MEMBERS_PER_TASK = 128
#: Groups larger than one in so many of all rows are handled apart: there are no more of them than this, so their table may be broadcast.
LARGE_GROUPS = 100_000
#: Up to this many candidate ids (8 bytes each) are broadcast to choose texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
MAX_WORDS = 100_000
CUT_ROUNDS = 3
CELL = 512

_PROBES = np.random.default_rng(20240).integers(0, BUCKETS, (128, BUCKETS))
#: For sets so small that no probe hits: the filled bucket with the smallest number in the empty one's column.
_ORDER = np.random.default_rng(31).random((BUCKETS, BUCKETS))
_ODD = np.random.default_rng(7).integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)


class _WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes.split() cuts at exactly the six white-space characters of ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(h) - width + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(width):
        mixed += h[i : i + n] * _ODD[i]
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(odd)
    return np.unique(mixed ^ (mixed >> np.uint64(31)))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The 512 registers of a set of sorted hashes."""
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = hashes[first] << np.uint64(BUCKET_BITS)
    zeros = 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    mantissa = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    out, full = np.zeros(BUCKETS, np.uint16), np.zeros(BUCKETS, bool)
    out[bucket[first]], full[bucket[first]] = (zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS)) | mantissa, True
    empty = np.flatnonzero(~full)
    source = out.copy()
    for probe in _PROBES:
        if not len(empty):
            break
        at = probe[empty]
        hit = full[at]
        out[empty[hit]] = source[at[hit]]
        empty = empty[~hit]
    if len(empty):
        filled = np.flatnonzero(full)
        out[empty] = source[filled[_ORDER[np.ix_(filled, empty)].argmin(axis=0)]]
    return out


def sketch(width: int):
    """Column function: text -> struct(n, digest, registers); digest and registers are null for an empty set."""

    @arrow_udf("struct<n: long, digest: binary, registers: binary>")
    def sketched(texts: pa.Array) -> pa.Array:
        n, digest, regs = [], [], []
        for text in texts.to_pylist():
            words = words_of(text)
            h = shingle_hashes(words, width)
            n.append(len(h))
            digest.append(blake2b(b" ".join(words), digest_size=16).digest() if words else None)
            regs.append(registers(h).tobytes() if len(h) else None)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(regs, pa.binary())], ["n", "digest", "registers"])

    return sketched


def estimated(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
    """Jaccard similarity by the share of equal registers, corrected for those that agree by chance."""
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in (a, b))
    n, m = (c.to_numpy(zero_copy_only=False).astype(float) for c in (n_a, n_b))
    chance = CHANCE * 4 * n * m / (n + m) ** 2
    return pa.array(((x == y).mean(axis=1) - chance) / (1 - chance))


def _comparer(width: int, percent: int):
    def shingles(text: str | None) -> set:
        words = words_of(text)
        return set(zip(*(words[i:] for i in range(min(width, len(words))))))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by (a, salt, role): a centre's text, then those of its members."""
        at, centre = None, set()
        for batch in batches:
            found = []
            for a, salt, role, b, text in zip(batch.a, batch.salt, batch.role, batch.id, batch.text):
                if role == 0:
                    at, centre = (a, salt), shingles(text)
                elif at == (a, salt):
                    other = shingles(text)
                    both = len(centre & other)
                    if 100 * both >= percent * (len(centre) + len(other) - both):
                        found.append((a, b))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return compare


def _cell_comparer(percent: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by (cell, role): few rows of role 0 are held, and each row of role 1 is compared with them."""
        cell, held, arrays = None, [], None
        for batch in batches:
            found = []
            for key, across, down, role, rep, n, component, regs in batch.itertuples(index=False):
                if cell != (key, across, down):
                    cell, held, arrays = (key, across, down), [], None
                if role == 0:
                    held.append((rep, n, component, regs))
                elif held:
                    if arrays is None:
                        r, m, c, x = zip(*held)
                        arrays = np.array(r), np.array(m, float), np.array(c), np.frombuffer(b"".join(x), np.uint16).reshape(-1, BUCKETS)
                    r, m, c, x = arrays
                    able = np.flatnonzero((c != component) & (100 * np.minimum(m, n) >= percent * np.maximum(m, n)))
                    chance = CHANCE * 4 * n * m[able] / (n + m[able]) ** 2
                    same = x[able] == np.frombuffer(regs, np.uint16)
                    near = (same.mean(axis=1) - chance) / (1 - chance) >= percent / 100 - leeway(percent)
                    near &= same.reshape(len(able), BANDS, BAND_ROWS).all(axis=2).argmax(axis=1) == key % BANDS  # once: in the first band they share
                    found += [(min(rep, o), max(rep, o)) for o in r[able[near]].tolist()]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return compare


def _across(left: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of the members of a bucket (key, rep, n, component) that lie in different components and may be similar.

    In each bucket all members pass by those outside its largest component. Both sides are dealt to a grid of cells of about
    CELL by CELL members, and only pairs whose estimate is high enough leave a cell.
    """
    parts = left.groupBy("key", "component").agg(F.count("*").alias("c")).groupBy("key").agg(F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("m"))
    grid = parts.select("key", F.col("top.component").alias("largest"), F.ceil(F.col("m") / CELL).cast("int").alias("wide"), F.ceil((F.col("m") - F.col("top.c")) / CELL).cast("int").alias("high"))
    rows = left.join(grid, "key")
    deal = lambda size: F.pmod(F.xxhash64("rep"), F.col(size)).cast("int")
    every = lambda size: F.explode(F.sequence(F.lit(0), F.col(size) - 1))
    passing = rows.select("key", deal("wide").alias("across"), every("high").alias("down"), F.lit(1).alias("role"), "rep", "n", "component")
    held = rows.where("component <> largest").select("key", every("wide").alias("across"), deal("high").alias("down"), F.lit(0).alias("role"), "rep", "n", "component")
    small_batches(left.sparkSession)
    cells = passing.unionByName(held).join(reps.select("rep", "registers"), "rep").select("key", "across", "down", "role", "rep", "n", "component", "registers")
    cells = cells.repartition("key", "across", "down").sortWithinPartitions("key", "across", "down", "role")
    return cells.mapInPandas(_cell_comparer(percent), "a long, b long")


def leeway(percent: int) -> float:
    """Five standard errors of the estimate at the threshold: a pair that is similar fails with probability 3e-7."""
    return 5 * (percent / 100 * (1 - percent / 100) / BUCKETS) ** 0.5


def _linked(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of representatives that are similar enough. a is the one with many partners."""
    spark = docs.sparkSession
    side = lambda c: reps.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", arrow_udf(estimated, "double")("r_a", "r_b", "n_a", "n_b").alias("e"))
    near = keep(near.where(F.col("e") >= percent / 100 - leeway(percent)).select("a", "b"))
    large = near.groupBy("a").agg(F.count("*").alias("c")).where(F.col("c") > large_from(near.count()))
    large = few(large.select("a", F.ceil(F.col("c") / MEMBERS_PER_TASK).alias("salts")), LARGE_GROUPS)
    dealt = near.join(large, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    roles = dealt.select("a", "salt", F.col("a").alias("id"), F.lit(0).alias("role")).distinct().unionByName(dealt.select("a", "salt", F.col("b").alias("id"), F.lit(1).alias("role")))
    ids = keep(near.select(F.col("a").alias("id")).union(near.select("b")).distinct())
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")).join(wanted, "id", "left_semi")
    texts = texts.groupBy("id").agg(F.max("text").alias("text"))
    small_batches(spark)
    rows = roles.join(texts, "id").select("a", "salt", "role", "id", "text").repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
    links = settle(rows.mapInPandas(_comparer(width, percent), "a long, b long"), "links", slim=True)
    near.unpersist()
    ids.unpersist()
    return links


def large_from(rows: int) -> int:
    """Groups of more rows than this are large; at most LARGE_GROUPS can be."""
    return max(MEMBERS_PER_TASK, -(-rows // LARGE_GROUPS))


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable, for all nodes of the links (a, b).

    Each round takes the smallest label among the neighbours and then that label's own label. Nothing but whether a label changed
    reaches the driver; every CUT_ROUNDS rounds the labels are written to the shared folder, so the lineage stays short.
    """
    both = keep(links.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(links.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct())
    labels = keep(both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("label")).select(F.col("x").alias("node"), "label"))
    held, rounds = [both, labels], 0
    while True:
        around = both.join(labels, both.y == labels.node).groupBy("x").agg(F.min("label").alias("near"))
        lower = labels.join(around, labels.node == around.x).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        ends = labels.select(F.col("node").alias("end"), F.col("label").alias("end_label"))
        jumped = lower.join(ends, lower.label == ends.end).select("node", "was", F.least("label", "end_label").alias("label"))
        rounds += 1
        jumped = keep(jumped) if rounds % CUT_ROUNDS else settle(jumped, "labels", slim=True)
        held.append(jumped)
        changed = jumped.where("was <> label").limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            out = settle(labels.withColumnRenamed("label", "component"), "components", slim=True)
            for df in held:
                df.unpersist()
            return out


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id, kept. Linked: 100 * intersection >= percent * union."""
    return _verdicts(docs, width, percent).drop("text_hash")


def _verdicts(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """near_duplicates() with text_hash, which tells rows of one doc_id apart."""
    small_batches(docs.sparkSession)
    # Plans over kept tables print theirs too; without a limit the driver holds megabytes of text for each job.
    docs.sparkSession.conf.set("spark.sql.maxPlanStringLength", "8192")
    docs = docs.select("doc_id", "text")
    sketched = keep(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), sketch(width)("text").alias("s")).select("doc_id", "text_hash", "s.*"))
    classes = sketched.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("registers").alias("registers"), F.count("*").alias("copies"))
    reps = keep(classes.where("rep is not null"))

    piece = lambda i: F.substring(F.col("registers"), i * 2 * BAND_ROWS + 1, F.lit(2 * BAND_ROWS))
    # The band's number stands in the key's low bits.
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(piece(i)).bitwiseAND(F.lit(-BANDS)).bitwiseOR(i.cast("long")))
    keyed = reps.select("rep", F.explode(bands).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    first_members = keep(keyed.join(shared, "key"))

    popular = first_members.groupBy("rep").agg(F.round(F.sum(F.log2("size")), 6).alias("popularity"))
    members = settle(first_members.join(popular, "rep").join(reps.select("rep", "n"), "rep").select("key", "rep", "n", "popularity"), "members", slim=True)
    centre = members.groupBy("key").agg(F.max(F.struct("popularity", (-F.col("rep")).alias("neg"), "n")).alias("c"))
    met = members.join(centre, "key").select("rep", "n", "c.popularity", (-F.col("c.neg")).alias("a"), F.col("c.n").alias("n_a"))
    fits = lambda n, m: F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)
    best = met.where((F.col("a") != F.col("rep")) & fits("n", "n_a")).groupBy("rep").agg(F.max(F.struct("popularity", (-F.col("a")).alias("neg"))).alias("c"))
    stars = keep(best.select((-F.col("c.neg")).alias("a"), F.col("rep").alias("b")))
    links = _linked(stars, reps, docs, width, percent)

    known = components(links)
    labelled = members.join(known, members.rep == known.node, "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("component"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    left = settle(labelled.join(mixed, "key"), "mixed-buckets", slim=True)
    across = _across(left, reps, percent)
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _linked(settle(across.join(tried, ["a", "b"], "left_anti"), "across", slim=True), reps, docs, width, percent)

    final = components(links.unionByName(more))
    named = reps.join(final, reps.rep == final.node, "left").select("digest", F.coalesce("component", "rep").alias("component"), "copies")
    rows = sketched.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "digest")
    # Large classes meet their rows by a broadcast table, the others by a shuffle, so no task gets the copies of one text.
    limit = large_from(sketched.count())
    large = few(named.where(F.col("copies") > limit).select("digest", "component"), LARGE_GROUPS)
    some = rows.where("digest is not null")
    small = some.join(large, "digest", "left_anti").join(named.where(F.col("copies") <= limit).select("digest", "component"), "digest", "left")
    out = some.join(large, "digest").unionByName(small).unionByName(rows.where("digest is null").withColumn("component", F.lit(None).cast("long")))
    component = F.coalesce("component", "doc_id")
    out = settle(out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")), "near-duplicates")
    for df in (sketched, reps, first_members, stars):
        df.unpersist()
    return out


def deduplicate(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that name their component, with their columns; a verdict holds for the rows of its doc_id and text."""
    kept = _verdicts(docs, width, percent).where("kept").select(F.col("doc_id").alias("_nd_id"), F.col("text_hash").alias("_nd_hash")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(F.col("_nd_id")) & (F.xxhash64(docs["text"]) == F.col("_nd_hash")), "left_semi")
