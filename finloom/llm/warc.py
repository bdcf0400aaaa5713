"""WARC archives: writing them, reading them back, and assembling request, response and metadata records to captures.

Each capture is written as three records: a response (or a revisit, if a capture with a larger id has the same payload), and the
request and metadata that name it through WARC-Concurrent-To. The page's id stands in the fields of the metadata record, and a
revisit names its response by WARC-Refers-To, so both are found by joining records. Archives are gzip files of whole records that
Spark's writer commits, so a task that runs again leaves nothing double; how many captures go into a file follows from their mean
size. Reading streams each file record by record through Spark's text source, cut at the mark that begins a record and mended by
Content-Length, so a task holds one record and files may be of any size; gzip of one member or of one a record are both read.

Defined results: a null payload is empty; a null url has no WARC-Target-URI; rows that repeat a capture (page id, url and payload)
are captures of their own, with record ids of their own; a null id is smaller than any other; payloads are equal by length and
SHA-256. Sizes and digests come from the payload that is read; a revisit takes them from the response it refers to, or, where the
archives lack that, from its headers. WARC-Concurrent-To may repeat and may stand on either side. Captures with no request or
metadata have nulls there, and records that are concurrent to no capture are left out of the assembly (orphans() lists them); a
record that is read twice is one; of several requests of one capture the one with the smallest record id is shown, and n_requests
and n_metadata count them; a record cut short keeps what there is of it; an empty table makes no archive and gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from finloom.llm.common import few, settle, small_batches

#: Files are rolled at about this many bytes of payload.
BYTES_PER_FILE = 128 << 20
#: Up to this many payloads that occur twice (about 200 bytes each) are broadcast; of more, the join shuffles.
BROADCAST_DIGESTS = 100_000
#: Copies of one row are spread in portions of so many.
PORTION = 1_000
VERSION = b"WARC/1.1\r\n"
#: What ends a record and begins the next.
BETWEEN = b"\r\n\r\nWARC/"


def payload_digest(data: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(kind: str, headers: list[tuple[str, str | None]], *block: bytes) -> list[bytes]:
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {sum(map(len, block))}"]
    return [VERSION, "\r\n".join(lines).encode("utf-8", "replace"), b"\r\n\r\n", *block, b"\r\n"]


def record_id(page_id, url: str | None, digest: str, copy_no: int = 1) -> str:
    """Of equal rows each has an id of its own."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}' + (f' {copy_no}' if copy_no > 1 else ''))}>"


def _one_line(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\r\n]+", " ", url)


def _capture(page_id: int | None, url: str | None, body: bytes, content: str, copy_no: int, same_id: int | None, same_url: str | None) -> bytes:
    """The three records of one capture; the writer adds the line break that ends the last one."""
    own, shown_url = record_id(page_id, url, content, copy_no), _one_line(url)
    common = [("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", shown_url)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    head = [("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha1:{payload_digest(body)}"), ("Content-Type", "application/http; msgtype=response")]
    if same_id is None:
        first = _record("response", head, http, body)
    else:
        profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        first = _record("revisit", [*head, profile, ("WARC-Refers-To", record_id(same_id, same_url, content))], http)
    other = lambda kind: [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, own + kind)}>"), *common, ("WARC-Concurrent-To", own)]
    path = re.sub(r"^\w+://[^/]*", "", shown_url or "") or "/"
    request = _record("request", [*other("request"), ("Content-Type", "application/http; msgtype=request")], f"GET {path} HTTP/1.1\r\nUser-Agent: finloom\r\n\r\n".encode("utf-8", "replace"))
    fields = ([] if page_id is None else [f"pageId: {page_id}"]) + [f"payloadBytes: {len(body)}"]
    metadata = _record("metadata", [*other("metadata"), ("Content-Type", "application/warc-fields")], "".join(f"{x}\r\n" for x in fields).encode())
    return b"".join([*first, b"\r\n", *request, b"\r\n", *metadata])


def records_of(page_id: pa.Array, url: pa.Array, payload: pa.Array, content: pa.Array, copy_no: pa.Array, same_id: pa.Array, same_url: pa.Array) -> pa.Array:
    return pa.array((_capture(*(x.as_py() for x in row)) for row in zip(page_id, url, payload, content, copy_no, same_id, same_url)), pa.binary())


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """One capture per row into WARC files under path."""
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("content", F.concat_ws(":", F.octet_length("payload"), F.sha2("payload", 256)))
    # Rows without payloads, to find equal ones: one per page, url and payload, from partial counts.
    distinct = rows.groupBy("page_id", "url", "content").agg(F.count("*").alias("copies"), F.max(F.octet_length("payload")).alias("bytes"))
    distinct = settle(distinct, "warc-rows")
    # Of equal payloads the largest id is the response.
    first = distinct.groupBy("content").agg(F.max(F.struct("page_id", "url")).alias("f"), F.count("*").alias("same")).where("same > 1")
    first = few(first.select(F.col("content").alias("same_content"), F.col("f.page_id").alias("first_id"), F.col("f.url").alias("first_url")), BROADCAST_DIGESTS)
    total, size, most = distinct.agg(F.sum("copies"), F.sum(F.col("copies") * F.col("bytes")), F.max("copies")).first()
    names = ["page_id", "url", "payload", "content"]
    if (most or 1) > 1:
        again = distinct.where("copies > 1").select("copies", *(F.col(c).alias(f"again_{c}") for c in ("page_id", "url", "content")))
        again = few(again, BROADCAST_DIGESTS)
        same = (rows["content"] == F.col("again_content")) & rows["page_id"].eqNullSafe(F.col("again_page_id")) & rows["url"].eqNullSafe(F.col("again_url"))
        # Rows that repeat are brought down to one, from each task one, and numbered as they are spread out again.
        repeated = rows.join(again, same).groupBy("page_id", "url", "content", "copies").agg(F.max("payload").alias("payload"))
        portions = repeated.withColumn("portion", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {PORTION}"))))
        spread = portions.repartition("content", "page_id", "portion").withColumn("i", F.explode(F.sequence(F.lit(1), F.least(F.lit(PORTION), F.expr(f"copies - portion * {PORTION}")))))
        spread = spread.select(*names, (F.col("portion") * PORTION + F.col("i")).alias("copy_no"))
        rows = rows.join(again, same, "left_anti").select(*names, F.lit(1).cast("long").alias("copy_no")).unionByName(spread)
    else:
        rows = rows.withColumn("copy_no", F.lit(1).cast("long"))
    joined = rows.join(first, F.col("content") == F.col("same_content"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    shown = joined.select(*names, "copy_no", F.when(revisit, F.col("first_id")).alias("same_id"), F.when(revisit, F.col("first_url")).alias("same_url"))
    text = shown.select(arrow_udf(records_of, "binary")("page_id", "url", "payload", "content", "copy_no", "same_id", "same_url").cast("string").alias("value"))
    per_file = max(1, BYTES_PER_FILE * (total or 1) // max(1, size or 1))
    text.write.option("lineSep", "\r\n").option("maxRecordsPerFile", min(per_file, 1_000_000)).option("compression", "gzip").text(path)


def parse(pieces: Iterator[bytes]) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers (lower-case names, which may repeat) and block of each record of one file, given as it is cut at BETWEEN.

    A piece that ends before its record does is put together with what follows.
    """
    held: list[bytes] = []
    wanted = headers = start = None
    size = 0
    for piece in pieces:
        held.append(BETWEEN + piece if held else piece)
        size += len(held[-1])
        if wanted is None or size >= wanted:
            data = b"".join(held)
            held = [data]
            if headers is None:
                end = data.find(b"\r\n\r\n")
                if end < 0:
                    continue
                pairs = (x.partition(":") for x in data[:end].decode("utf-8", "replace").split("\r\n")[1:])
                headers, start = [(k.strip().lower(), v.strip()) for k, _, v in pairs], end + 4
                length = dict(headers).get("content-length", "")
                wanted = start + (int(length) if length.isdigit() else 0)
            if size >= wanted:
                yield headers, data[start:wanted]
                held, wanted, headers, size = [], None, None, 0
    if headers is not None:  # cut short
        yield headers, b"".join(held)[start:]


FIELDS = re.compile(rb"(?im)^(pageid|payloadbytes):[ \t]*(-?\d+)[ \t]*\r?$")
HTTP_LENGTH = re.compile(rb"(?i)\r\ncontent-length:[ \t]*(\d+)")


def _row(headers: list[tuple[str, str]], block: bytes) -> dict:
    h = dict(reversed(headers))
    kind = h.get("warc-type")
    head, _, body = block.partition(b"\r\n\r\n") if kind in ("response", "revisit") else (b"", b"", block)
    length = HTTP_LENGTH.search(head) if kind == "revisit" else None
    fields = {k.lower(): int(v) for k, v in FIELDS.findall(block)} if kind == "metadata" else {}
    return {
        "record_id": h.get("warc-record-id"),
        "record_type": kind,
        "target_uri": h.get("warc-target-uri"),
        "date": h.get("warc-date"),
        "concurrent_to": [v for k, v in headers if k == "warc-concurrent-to"],
        "refers_to": h.get("warc-refers-to"),
        "stated_digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        "payload": None if kind == "revisit" else body,
        "payload_digest": payload_digest(body) if kind == "response" else None,
        "payload_bytes": len(body) if kind == "response" else None,
        "stated_bytes": int(length[1]) if length else None,
        "page_id": fields.get(b"pageid"),
    }


SCHEMA = pa.schema(
    [(c, pa.string()) for c in ("record_id", "record_type", "target_uri", "date")]
    + [("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()), ("stated_digest", pa.string()), ("payload", pa.binary()), ("payload_digest", pa.string())]
    + [(c, pa.int64()) for c in ("payload_bytes", "stated_bytes", "page_id")]
)
RECORD_SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, concurrent_to array<string>, refers_to string, stated_digest string, "
    "payload binary, payload_digest string, payload_bytes long, stated_bytes long, page_id long"
)
#: Records leave a task in batches of about so many bytes of payload.
BATCH_BYTES = 4 << 20


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for file, value in zip(batch.column(0), batch.column(1)):
            yield file.as_py(), value.as_py()


def _records(pieces: Iterator[tuple[str, bytes]]) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """The records of one file after another."""
    ahead = next(pieces, None)
    while ahead:
        file = ahead[0]

        def one() -> Iterator[bytes]:
            nonlocal ahead
            while ahead and ahead[0] == file:
                piece = ahead[1]
                ahead = next(pieces, None)
                yield piece

        yield from parse(one())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for headers, block in _records(_pieces(batches)):
        rows.append(_row(headers, block))
        size += len(block)
        if size >= BATCH_BYTES or len(rows) >= 1_000:
            yield pa.RecordBatch.from_pylist(rows, SCHEMA)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, SCHEMA)


def read_archives(spark: SparkSession, path: str, files: str = "*.gz") -> DataFrame:
    """All records of the gzip WARC files under path, a row each."""
    small_batches(spark)
    cut = spark.read.option("lineSep", BETWEEN.decode()).option("pathGlobFilter", files).schema("value string").text(path)
    return cut.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")).mapInArrow(_rows, RECORD_SCHEMA)


def _kind(*kinds: str):
    return F.col("record_type").isin(*kinds)


def _edges(records: DataFrame) -> DataFrame:
    """record_id, main_id: which request or metadata record belongs to which capture, whichever of them names the other."""
    named = records.select("record_id", "record_type", F.explode("concurrent_to").alias("other"))
    forward = named.where(_kind("request", "metadata")).select("record_id", F.col("other").alias("main_id"))
    backward = named.where(_kind("response", "revisit")).select(F.col("other").alias("record_id"), F.col("record_id").alias("main_id"))
    return forward.unionByName(backward).distinct()


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture, request, metadata (structs), n_requests, n_metadata."""
    # Links and the small records beside captures are read once; payloads of captures only pass through.
    slim = settle(records.select("record_id", "record_type", "target_uri", "date", "concurrent_to", "page_id", F.when(_kind("request", "metadata"), F.col("payload")).alias("payload")), "warc-links")
    beside = slim.where(_kind("request", "metadata")).dropDuplicates(["record_id"]).drop("concurrent_to").join(_edges(slim), "record_id")
    shown = lambda kind, *more: F.min(F.when(F.col("record_type") == kind, F.struct("record_id", "target_uri", "date", "payload", *more))).alias(kind)
    grouped = beside.groupBy("main_id").agg(
        shown("request"), shown("metadata", "page_id"), F.count_if(F.col("record_type") == "request").alias("n_requests"), F.count_if(F.col("record_type") == "metadata").alias("n_metadata")
    )
    names = ["record_type", "target_uri", "date", "refers_to", "stated_digest", "stated_bytes", "payload", "payload_digest", "payload_bytes"]
    main = records.where(_kind("response", "revisit")).groupBy("record_id").agg(*(F.max(c).alias(c) for c in names))
    joined = main.join(grouped, F.col("record_id") == F.col("main_id"), "left")
    return joined.select(
        F.struct("record_id", *names).alias("capture"), "request", "metadata", F.coalesce("n_requests", F.lit(0)).alias("n_requests"), F.coalesce("n_metadata", F.lit(0)).alias("n_metadata")
    )


def orphans(records: DataFrame) -> DataFrame:
    """Request and metadata records that are concurrent to no capture."""
    main = records.where(_kind("response", "revisit")).select(F.col("record_id").alias("main_id"))
    held = _edges(records).join(main, "main_id", "left_semi")
    return records.where(_kind("request", "metadata")).join(held, "record_id", "left_anti")


def captures(assembled: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (the page of the response), and what stands beside the capture."""
    c = F.col("capture")
    slim = assembled.select(
        c["record_id"].alias("record_id"), F.col("metadata.page_id").alias("page_id"), c["record_type"].alias("record_type"), c["refers_to"].alias("named"),
        F.coalesce(c["payload_bytes"], c["stated_bytes"]).alias("payload_bytes"), F.coalesce(c["payload_digest"], c["stated_digest"]).alias("payload_digest"), "n_requests", "n_metadata",
    )
    slim = settle(slim, "captures")
    wanted = slim.where("record_type = 'revisit'").select(F.col("named").alias("record_id")).distinct()
    found = slim.where("record_type = 'response'").join(wanted, "record_id", "left_semi")
    found = found.select(F.col("record_id").alias("first"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("first_bytes"), F.col("payload_digest").alias("first_digest"))
    joined = slim.join(few(found, BROADCAST_DIGESTS), (F.col("record_type") == "revisit") & (F.col("named") == F.col("first")), "left")
    return joined.select(
        "page_id", F.coalesce("first_bytes", "payload_bytes").alias("payload_bytes"), F.coalesce("first_digest", "payload_digest").alias("payload_digest"), "record_type", "refers_to", "n_requests", "n_metadata"
    )


ORACLE_SQL = """
with p as (select page_id, coalesce(html, '') as html, max(page_id) over (partition by coalesce(html, '')) as first_id from pages),
h as (select *, sha1(html) as hex from p),
b as (select *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::bigint >> (5 * (3 - i % 4))) & 31)::int + 1, 1) for i in generate_series(0, 31)], '') as b32 from h)
select page_id, octet_length(encode(html)) as payload_bytes, b32 as payload_digest, case when page_id = first_id then 'response' else 'revisit' end as record_type,
    case when page_id <> first_id then first_id end as refers_to, 1::bigint as n_requests, 1::bigint as n_metadata from b
"""
