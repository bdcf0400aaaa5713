"""Fill-in-middle by an index of distinct texts: each text's token boundaries are found once, as an Elias-Fano list.

1. Identical texts are grouped by their digests (SHA-256 and MD5), and collect_set compares the bytes inside a group. Map tasks
   send one row per distinct text, so texts are shuffled once.
2. A Python step over the distinct texts writes the ends of their tokens (in code points) as an Elias-Fano list: 2 + log2(u / n)
   bits a boundary. A directory of every 512th boundary makes a lookup one short scan.
3. Documents (ids and digests only) join the texts by digest; for each, two seeded numbers select two boundaries, and the text is
   cut there.

Hot texts: a text of more than COPIES documents gets a row for each share of some COPIES of them, so no task and no array holds
more; what is replicated is at most one text per COPIES documents. Everything else stays where it is.

Defined results: a null text is empty; an empty text, or one with a sentinel in it, is plain; a null doc_id is seeded as an empty
decimal; repeated rows each get the same cut; texts of any length are read whole; an empty table gives no rows. Other columns are
not read (join the result by doc_id).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finloom.llm.common import few, settle, small_batches

SEED = 42
#: Sentinels of prefix, suffix and middle; percentages of documents left plain, and of the others in the order suffix-prefix-middle.
PRE, SUF, MID = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 50, 80
#: Documents of one text that one share takes; texts with more are dealt in shares.
COPIES = 1000
#: Rows of the table of hot texts that is broadcast at most.
MOST_HOT = 100_000
#: Boundaries between two entries of a list's directory.
STRIDE = 512


def token_ends(text: str) -> np.ndarray:
    """Ends of the tokens of text, in code points: after each word, and at the end of white space that no word follows."""
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    after = np.append(space[1:], True)
    ends = np.flatnonzero(~space & after) + 1
    return np.append(ends, len(points)) if space[-1] else ends


def ef_encode(values: np.ndarray) -> bytes:
    """An ascending list as an Elias-Fano list: header (n, low bits), directory, low bits packed, high bits in unary."""
    n = len(values)
    if not n:
        return np.array([0, 0], "<u4").tobytes()
    low = max(0, int(values[-1] // n).bit_length() - 1)
    high = (values >> low) + np.arange(n)
    unary = np.zeros(int(high[-1]) + 1, np.uint8)
    unary[high] = 1
    bits = ((values[:, None] >> np.arange(low)) & 1).astype(np.uint8).ravel()
    parts = [np.array([n, low], "<u4"), high[::STRIDE].astype("<u4"), np.packbits(bits, bitorder="little"), np.packbits(unary, bitorder="little")]
    return b"".join(p.tobytes() for p in parts)


def ef_select(data: bytes, k: int) -> int:
    """The kth value of a list (from 0): the directory's entry before it, then a scan of the unary bits from there."""
    n, low = np.frombuffer(data, "<u4", 2)
    n, low = int(n), int(low)
    entries = -(-n // STRIDE)
    packed = 8 + 4 * entries
    unary_from = packed + -(-n * low // 8)
    at = int(np.frombuffer(data, "<u4", 1, 8 + 4 * (k // STRIDE))[0])
    left, byte = k % STRIDE, at // 8
    unary = np.frombuffer(data, np.uint8, offset=unary_from + byte)
    skip, size = at % 8, STRIDE // 4
    while True:  # a chunk holds the bit looked for, or the next, longer one does
        found = np.flatnonzero(np.unpackbits(unary[:size], bitorder="little")[skip:])
        if len(found) > left or size >= len(unary):
            break
        size *= 4
    high = byte * 8 + skip + int(found[left]) - k
    first = k * low
    word = int.from_bytes(data[packed + first // 8 : packed + (first + low + 7) // 8], "little")
    return (high << low) | ((word >> first % 8) & ((1 << low) - 1))


@F.pandas_udf(T.BinaryType())
def _index(texts: pd.Series) -> pd.Series:
    return pd.Series([ef_encode(token_ends(t)) for t in texts], dtype=object)


@F.pandas_udf(T.LongType())
def _count(lists: pd.Series) -> pd.Series:
    return pd.Series([int(np.frombuffer(x, "<u4", 1)[0]) for x in lists], dtype="int64")


@F.pandas_udf(T.LongType())
def _select(lists: pd.Series, k: pd.Series) -> pd.Series:
    """The end of the first k tokens; 0 for none."""
    return pd.Series([ef_select(x, int(i) - 1) if i else 0 for x, i in zip(lists, k)], dtype="int64")


def text_key(text: Column) -> Column:
    """SHA-256 and MD5 of a text, as one key."""
    return F.concat(F.sha2(text, 256), F.md5(text))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """key, text, copies: a row per distinct text of docs (text, without nulls).

    collect_set compares the texts of a key byte by byte; two texts of one key (both digests equal) end the job with an error.
    """
    groups = docs.select(text_key(F.col("text")).alias("key"), "text").groupBy("key").agg(F.collect_set("text").alias("texts"), F.count("*").alias("copies"))
    only = F.when(F.size("texts") == 1, F.element_at("texts", 1)).otherwise(F.raise_error(F.concat(F.lit("texts differ under one key: "), "key")).cast("string"))
    return groups.select("key", only.alias("text"), "copies")


def text_index(docs: DataFrame) -> DataFrame:
    """text, ids, ends: a row per distinct text of docs (doc_id, text), or per share of a hot one's documents.

    ids holds COPIES documents or so at most. The ids come to the texts, which stay where grouping put them; shares of hot texts alone
    move once more. Token ends are found last, once per row.
    """
    slim = settle(docs.select("doc_id", text_key(F.col("text")).alias("key")), "fim-ids")
    hot = few(slim.groupBy("key").agg(F.count("*").alias("copies")).where(F.col("copies") > COPIES), MOST_HOT)
    texts, ids = distinct_texts(docs), F.collect_list(F.struct("doc_id")).alias("ids")
    shares = F.ceil(F.col("copies") / COPIES).cast("int")
    few_copies = slim.join(hot, "key", "left_anti").groupBy("key").agg(ids)
    usual = texts.where(F.col("copies") <= COPIES).join(few_copies.hint("shuffle_hash"), "key")
    dealt = texts.where(F.col("copies") > COPIES).withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1)))
    numbered = slim.withColumn("row", F.monotonically_increasing_id()).join(hot, "key")
    spread = numbered.groupBy("key", F.pmod("row", shares).cast("int").alias("share")).agg(ids)
    rows = usual.select("text", "ids").unionByName(dealt.join(spread, ["key", "share"]).select("text", "ids"))
    return rows.withColumn("ends", _index("text"))


def seeds(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _cut(rows: DataFrame, seed: int) -> DataFrame:
    """rows (doc_id, text, ends, n) with form, the three parts and the output."""
    h1, h2, h3, h4 = seeds(F.col("doc_id"), seed)
    picks = {"k1": F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)), "k2": F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1))}
    clean = (F.col("text") != "") & ~F.col("text").contains(PRE) & ~F.col("text").contains(SUF) & ~F.col("text").contains(MID)
    form = F.when(~clean | (h3 % 100 >= PLAIN_FROM), "plain").when(h4 % 100 < SPM_BELOW, "spm").otherwise("psm")
    rows = rows.withColumns(picks).withColumn("form", form)
    rows = rows.withColumns({"a": _select("ends", "k1").cast("int"), "b": _select("ends", "k2").cast("int")})
    whole = F.col("text")
    parts = {"prefix": F.substring(whole, F.lit(1), F.col("a")), "middle": F.substring(whole, F.col("a") + 1, F.col("b") - F.col("a")), "suffix": F.substring(whole, F.col("b") + 1, F.length(whole))}
    rows = rows.withColumns(parts)
    psm, spm = F.concat(F.lit(PRE), "prefix", F.lit(SUF), "suffix", F.lit(MID), "middle"), F.concat(F.lit(SUF), "suffix", F.lit(PRE), "prefix", F.lit(MID), "middle")
    output = F.when(F.col("form") == "plain", whole).when(F.col("form") == "psm", psm).otherwise(spm)
    chars = lambda c: F.when(F.col("form") != "plain", F.col(c)).cast("long")
    return rows.select("doc_id", "n", "form", chars("a").alias("prefix_chars"), F.when(F.col("form") != "plain", F.col("b") - F.col("a")).cast("long").alias("middle_chars"), output.alias("output"))


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """Per row of docs: doc_id, n (tokens), form, prefix_chars, middle_chars, output (the training text)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return _cut(text_index(rows).withColumn("n", _count("ends")).select("text", "ends", "n", F.inline("ids")), seed)


def restore(output: Column, form: Column) -> Column:
    """The exact text from an output and its form."""
    after = lambda s, mark: F.substring(s, F.instr(s, mark) + len(mark), F.length(s))
    before = lambda s, mark: F.substring(s, F.lit(1), F.instr(s, mark) - 1)
    middle = after(output, MID)
    psm_prefix, psm_suffix = after(before(output, SUF), PRE), after(before(output, MID), SUF)
    spm_suffix, spm_prefix = after(before(output, PRE), SUF), after(before(output, MID), PRE)
    return F.when(form == "plain", output).when(form == "psm", F.concat(psm_prefix, middle, psm_suffix)).otherwise(F.concat(spm_prefix, middle, spm_suffix))


def digests(rows: DataFrame) -> DataFrame:
    """transform()'s rows with digests of the output and of the text restored from it, in place of the output."""
    restored = F.sha2(restore(F.col("output"), F.col("form")), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), restored.alias("restored_sha256"))


ORACLE_SQL = rf"""
with t as (
    select doc_id, coalesce(text, '') as text, sha256('{SEED}:' || coalesce(doc_id::varchar, '')) as h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as tokens
    from documents
), s as (
    select *, len(tokens) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from t
), k as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as k1, greatest(h1 % (n + 1), h2 % (n + 1)) as k2,
        case when text = '' or contains(text, '{PRE}') or contains(text, '{SUF}') or contains(text, '{MID}') or h3 % 100 >= {PLAIN_FROM} then 'plain' when h4 % 100 < {SPM_BELOW} then 'spm' else 'psm' end as form
    from s
), p as (
    select *, array_to_string(tokens[1:k1], '') as prefix, array_to_string(tokens[k1 + 1:k2], '') as middle, array_to_string(tokens[k2 + 1:n], '') as suffix from k
)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '{PRE}' || prefix || '{SUF}' || suffix || '{MID}' || middle else '{SUF}' || suffix || '{PRE}' || prefix || '{MID}' || middle end) as output_sha256,
    sha256(text) as restored_sha256
from p
"""
