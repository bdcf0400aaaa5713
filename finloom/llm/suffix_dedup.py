"""Repeated passages by a depth-limited radix sort of suffixes, most significant digit first, through WINDOW bytes.

A suffix is a place where a whole window of WINDOW bytes starts; its key is that window. Each pass groups suffixes by a further
digit of the key and goes on only with groups of several; what is equal after the last digit is exactly a repeated window.

A row per byte of the corpus can't be shuffled, so suffixes travel in runs. The most significant digit is the window's anchor: of
its grams of GRAM bytes the one with the least hash, the leftmost of equals. It is a function of the window's bytes alone, as any digit must
be, and neighbouring windows share it, so that a run of some 170 suffixes is one row. Further digits are read from the anchor
outwards instead of from left to right; the order of a key's digits doesn't change which keys are equal.

* Pass 1 groups runs by anchor. Runs whose anchor occurs once are unique and end here: nearly all of a clean corpus.
* Pass 2 groups by all bytes of the run's windows. Equal runs are repeated throughout. One run stands for each such class from
  here on; only anchors with several classes go on.
* The further passes split runs into cells of 64, 16 and 1 suffixes by their distance from the anchor. The digit is the core, the
  bytes that all windows of a cell share: a cell whose core is unique holds unique windows only. Cells equal in all bytes are
  repeated. What is neither is split by the next pass; the last one compares single windows.

Digests are BLAKE2b-128 of the bytes compared, held as two numbers. Groups are counted with partial aggregates and joined back by
key, which adaptive execution splits where one key is hot; no group is ever collected. The bytes of runs that go on past pass 2 are
the only text that is written. Texts move twice, compressed: to the places of their runs that go on, and to what is to be removed.
They are scanned in blocks of BLOCK windows, so memory doesn't grow with a text's length; the bytes of one document are in one task.

Defined results: a null text is empty; a text shorter than WINDOW keeps everything; windows never cross documents, and a document
may repeat its own; equal rows are documents of their own, so a row that is there twice loses all its windows; null ids are
allowed; an empty table gives no rows. Removed runs may cut a character, so what stays is bytes. Columns other than the id and the
text are not read. A text of one repeated byte makes a row per byte, as each suffix has an anchor of its own.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.llm.common import settle, small_batches

#: Bytes of a window; of a gram; windows that are scanned at once.
WINDOW, GRAM, BLOCK = 400, 64, 1 << 20
#: Suffixes of a cell in the passes over cells.
CELLS = [64, 16, 1]
#: Grams of a window.
SPREAD = WINDOW - GRAM + 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


_OF_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2 ** 64, made once per worker."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(1 << 14, 1 << (n - 1).bit_length())
            ups = np.full(size, _ODD)
            downs = np.full(size, np.uint64(pow(int(_ODD), -1, 1 << 64)))
            ups[0] = downs[0] = 1
            cls.up, cls.down = np.cumprod(ups), np.cumprod(downs)
        return cls.up[:n], cls.down[:n]


def grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each gram of data, by differences of one running sum."""
    up, down = _Powers.of(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_OF_BYTE[data] * up)])
    return _mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1])


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each width neighbouring keys, by prefix and suffix minima of blocks."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[: n - width + 1], prefix[width - 1 : n])


def text_runs(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of runs: hash of the anchor, the anchor's place, first and last suffix of the run."""
    for at in range(0, len(data) - WINDOW + 1, BLOCK):
        hashes = grams(data[at : at + BLOCK + WINDOW - 1])
        least = _least((hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64), SPREAD)
        first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        last = np.append(first[1:], len(least)) - 1
        anchor = (least[first] & _LOW).astype(np.int64)
        yield hashes[anchor].view(np.int64), anchor + at, first + at, last + at


def _digest(data: memoryview, *of: int) -> bytes:
    return hashlib.blake2b(data, digest_size=16, salt=struct.pack("<qq", *of)).digest()


def _numbers(digests: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """128-bit digests as two columns of 64-bit numbers."""
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return pa.array(both[:, 0]), pa.array(both[:, 1])


def _id_type(rows: DataFrame) -> str:
    return rows.schema["id"].dataType.simpleString()


def runs(docs: DataFrame) -> DataFrame:
    """docs (id, h, text) to a row per run: id, h, gram, anchor, first, last, s1 and s2 (a digest of all its bytes and its shape)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for row, text in enumerate(texts):
                view = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                if len(view) < WINDOW:
                    continue
                for gram, anchor, first, last in text_runs(np.frombuffer(view, np.uint8)):
                    spans = [_digest(view[s : e + WINDOW], a - s, e - s) for a, s, e in zip(anchor.tolist(), first.tolist(), last.tolist())]
                    same = pa.array(np.full(len(gram), row))
                    columns = [batch.column(0).take(same), batch.column(1).take(same), pa.array(gram), pa.array(anchor), pa.array(first), pa.array(last), *_numbers(spans)]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "h", "gram", "anchor", "first", "last", "s1", "s2"])

    schema = f"id {_id_type(docs)}, h bigint, gram bigint, anchor bigint, first bigint, last bigint, s1 bigint, s2 bigint"
    return docs.select("id", "h", "text").mapInArrow(step, schema)


def packed(docs: DataFrame) -> DataFrame:
    """docs (id, h, text) with the text compressed, for a shuffle."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [squeeze.compress(x.as_buffer()) if x.is_valid else None for x in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], ["id", "h", "packed"])

    return docs.select("id", "h", "text").mapInArrow(step, f"id {_id_type(docs)}, h bigint, packed binary")


def _beside(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """packed docs joined to lists (id, h and others); ids may be null."""
    theirs = lists.withColumnsRenamed({"id": "of", "h": "hash"})
    return docs.join(theirs, docs["id"].eqNullSafe(theirs["of"]) & (docs["h"] == theirs["hash"]), how).drop("of", "hash")


def _contexts(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The bytes of runs: kept (id, h, gram, anchor, first, last, done) with data, read from their texts."""
    per_text = kept.groupBy("id", "h").agg(F.collect_list(F.struct("gram", "anchor", "first", "last", "done")).alias("runs"))
    names = ["gram", "anchor", "first", "last", "done"]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in range(batch.num_rows):
                data = memoryview(expand.decompress(batch.column(2)[row].as_buffer()))
                mine = batch.column(3)[row].values
                places = zip(mine.field("first").to_pylist(), mine.field("last").to_pylist())
                same = pa.array(np.full(len(mine), row))
                texts = pa.array([bytes(data[first : last + WINDOW]) for first, last in places], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(same), batch.column(1).take(same), *(mine.field(c) for c in names), texts], ["id", "h", *names, "data"])

    schema = f"id {_id_type(docs)}, h bigint, gram bigint, anchor bigint, first bigint, last bigint, done boolean, data binary"
    return _beside(packed(docs), per_text, "inner").select("id", "h", "packed", "runs").mapInArrow(step, schema)


def cells(rows: DataFrame, width: int) -> DataFrame:
    """Runs to their cells of so many suffixes.

    rows: id, h, start (the run's first suffix), gram, anchor, data (the run's bytes), open (its intervals of suffixes that go on, as
    first, last, done). Out: id, h, start, first, last, done, c1 and c2 (digest of the core), s1 and s2 (of all bytes).
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, grams_, anchors = (batch.column(k).to_pylist() for k in (2, 3, 4))
            of, out, cores, spans = [], [], [], []
            for row, (start, gram, anchor, parts) in enumerate(zip(starts, grams_, anchors, batch.column(6).to_pylist())):
                view = memoryview(batch.column(5)[row].as_buffer())
                for part in parts:
                    for cell in range((anchor - part["last"]) // width, (anchor - part["first"]) // width + 1):
                        # The cell's windows start at anchor - distance, for distances from cell * width on.
                        near, far = anchor - cell * width, anchor - cell * width - width + 1
                        lo, hi = max(far, part["first"]), min(near, part["last"])
                        of.append(row)
                        out.append((lo, hi, part["done"]))
                        cores.append(_digest(view[near - start : far - start + WINDOW], gram, cell))
                        spans.append(_digest(view[lo - start : hi - start + WINDOW], anchor - lo, anchor - hi))
            if out:
                own = [batch.column(k).take(pa.array(of)) for k in range(3)]
                first, last, done = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(done, pa.bool_()), *_numbers(cores), *_numbers(spans)], ["id", "h", "start", "first", "last", "done", "c1", "c2", "s1", "s2"]
                )

    schema = f"id {_id_type(rows)}, h bigint, start bigint, first bigint, last bigint, done boolean, c1 bigint, c2 bigint, s1 bigint, s2 bigint"
    return rows.select("id", "h", "start", "gram", "anchor", "data", "open").mapInArrow(step, schema)


def repeated(docs: DataFrame) -> DataFrame:
    """id, h, first, last: runs of suffixes (last included) whose windows occur elsewhere too. docs: id, h, text."""
    interval, span, both = ["id", "h", "first", "last"], ["s1", "s2"], ["c1", "c2", "s1", "s2"]
    all_runs = settle(runs(docs), "suffix-runs")
    # Pass 1: anchors that occur more than once, and whether all their runs are equal, which settles pass 2 for them.
    anchors = all_runs.groupBy("gram").agg(F.count("*").alias("n"), *(f(c).alias(f"{c}_{f.__name__}") for c in span for f in (F.min, F.max)))
    same = (F.col("s1_min") == F.col("s1_max")) & (F.col("s2_min") == F.col("s2_max"))
    anchors = settle(anchors.where("n > 1").select("gram", same.alias("same")), "suffix-anchors")
    live = settle(all_runs.join(anchors, "gram"), "suffix-live")
    found = live.where("same").select(*interval)
    # Pass 2: classes of equal runs among anchors with several. done: known to be repeated, from here on only compared with.
    mixed = live.where("not same")
    one = F.min(F.struct("id", "h", "anchor", "first", "last")).alias("one")
    classes = settle(mixed.groupBy("gram", *span).agg(F.count("*").alias("n"), one), "suffix-classes")
    found = found.unionByName(mixed.join(classes.where("n > 1").select("gram", *span), ["gram", *span]).select(*interval))
    contexts = settle(_contexts(classes.select("one.*", "gram", (F.col("n") > 1).alias("done")), docs), "suffix-contexts")
    runs_left = contexts.withColumnRenamed("first", "start")
    left = runs_left.withColumn("open", F.array(F.struct(F.col("start").alias("first"), "last", "done")))
    for width in CELLS:
        parts = settle(cells(left, width), f"suffix-cells-{width}")
        one = F.min(F.struct("id", "h", "start", "first", "last")).alias("one")
        kinds = parts.groupBy(*both).agg(F.count("*").alias("n"), F.max("done").alias("known"), one)
        kinds = settle(kinds.withColumn("repeated", F.col("known") | (F.col("n") > 1)), f"suffix-kinds-{width}")
        found = found.unionByName(parts.where("not done").join(kinds.where("repeated").select(*both), both).select(*interval))
        if width > 1:
            # Of a core that several kinds share: the one run of each kind that isn't known, and one run of each that is.
            cores = kinds.groupBy("c1", "c2").agg(F.count("*").alias("kinds"), F.min("repeated").alias("all_known")).where("kinds > 1 and not all_known")
            shared = kinds.join(cores, ["c1", "c2"]).select("one.*", F.col("repeated").alias("done"))
            per_run = shared.groupBy("id", "h", "start").agg(F.collect_list(F.struct("first", "last", "done")).alias("open"))
            theirs = per_run.withColumnsRenamed({"id": "of", "h": "hash", "start": "at"})
            same_run = runs_left["id"].eqNullSafe(theirs["of"]) & (runs_left["h"] == theirs["hash"]) & (runs_left["start"] == theirs["at"])
            left = runs_left.join(theirs, same_run)
    return found


def _cut(rows: DataFrame) -> DataFrame:
    """rows (id, packed, found) with the removed spans and the bytes that stay; found: a run's first suffix << 24 | its length - 1."""
    out = f"doc_id {_id_type(rows)}, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary"
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, found in zip(batch.column(1), batch.column(2)):
                data = expand.decompress(text.as_buffer())
                mine, rest, at = [], [], 0
                if found.is_valid and len(found.values):
                    places = np.sort(found.values.to_numpy())
                    starts = places >> 24
                    stops = np.maximum.accumulate(starts + (places & 0xFFFFFF) + WINDOW)
                    new = np.concatenate([[True], starts[1:] > stops[:-1]])
                    ends = np.append(np.flatnonzero(new)[1:], len(new)) - 1
                    for start, stop in zip(starts[new].tolist(), stops[ends].tolist()):
                        mine.append({"start": start, "stop": stop})
                        rest.append(data[at:start])
                        at = stop
                rest.append(data[at:])
                sizes.append(len(data))
                spans.append(mine)
                kept.append(b"".join(rest))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return rows.select("id", "packed", "found").mapInArrow(step, out)


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_bytes, spans (removed, start and stop in bytes), kept (the bytes that stay)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    place = F.shiftleft("first", 24).bitwiseOR(F.col("last") - F.col("first"))
    per_text = repeated(rows).groupBy("id", "h").agg(F.collect_list(place).alias("found"))
    return _cut(_beside(packed(rows), per_text, "left"))


def digests(rows: DataFrame) -> DataFrame:
    """deduplicate()'s rows with counts and a digest in place of spans and bytes."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Rows that are equal in id and text are told apart by a row number.
ORACLE_SQL = f"""
with d as (
    select doc_id, row_number() over () as r, encode(coalesce(text, '')) as data, strlen(coalesce(text, '')) as n from documents
), suffix as (
    select r, p, md5(data[p:p + {WINDOW - 1}]) as w from (select r, data, unnest(range(1, n - {WINDOW - 2})) as p from d where n >= {WINDOW})
), hit as (
    select r, p from suffix where w in (select w from suffix group by w having count(*) > 1)
), marked as (
    select r, p, case when p <= lag(p) over (partition by r order by p) + {WINDOW} then 0 else 1 end as fresh from hit
), numbered as (
    select r, p, sum(fresh) over (partition by r order by p) as k from marked
), spans as (
    select r, k, min(p) as a, max(p) + {WINDOW} as b from numbered group by r, k
), gaps as (
    select r, coalesce(lag(b) over (partition by r order by a), 1) as from_byte, a - 1 as to_byte from spans
    union all select r, max(b), 2147483647 from spans group by r
), kept as (
    select d.r, string_agg(case when to_byte >= from_byte then hex(data[from_byte:least(to_byte, n)]) else '' end, '' order by from_byte) as kept from gaps join d using (r) group by d.r
), removed as (
    select r, sum(b - a) as n_removed, count(*) as n_spans from spans group by r
)
select doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans, sha256(coalesce(unhex(kept), data)) as kept_sha256
from d left join removed using (r) left join kept using (r)
"""
