"""Quality classifier by compression: zstandard dictionaries of good and of bad labelled text.

A text is compressed in blocks of BLOCK bytes under each dictionary; the difference of the two sizes over the text's length is
the evidence, and a logistic curve fitted on labelled texts that no dictionary saw makes it the probability of label 1. Blocks are
compressed apart, so that the evidence per byte doesn't fade as a long text becomes its own dictionary; every byte of a text counts.

The fit is bounded: at most MAX_TEXTS labelled texts a class for the dictionaries, MAX_CHUNKS chunks of CHUNK characters of them,
and MAX_TEXTS other texts a class for the curve, all drawn by hash. Where zstandard's trainer refuses the samples (a handful, or all
alike), the dictionary is the samples themselves. Scoring covers all rows.

Defined results: an empty or null text has no evidence and gets the curve's value at zero; rows without a label score like others;
a null label is no label; of several labels of one doc_id the lowest counts, and of several texts of it all; if a class has no labelled text, every score is the share of label 1 (0.5 without labels); repeated rows
score alike; long texts are compressed whole; an empty table gives no rows; further columns pass through, and one named as the score is
replaced.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from finloom.llm.common import keep, small_batches

BLOCK, CHUNK = 2048, 2048
#: Bytes added to a text's length, so that a few bytes are no strong evidence.
DAMPING = 150
MAX_TEXTS, MAX_CHUNKS = 1500, 1500
DICTIONARY_BYTES, LEVEL = 65_536, 3
THRESHOLD = 0.3


@lru_cache(maxsize=4)
def _compressors(good: bytes, bad: bytes):
    made = []
    for data in (good, bad):
        d = zstandard.ZstdCompressionDict(data)
        d.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False).compress)
    return made


def evidence(text: str | None, good: bytes, bad: bytes) -> float:
    """(size under the bad dictionary - size under the good one) / (bytes + DAMPING)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return 0.0
    by_good, by_bad = _compressors(good, bad)
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    return sum(len(by_bad(b)) - len(by_good(b)) for b in blocks) / (len(data) + DAMPING)


def evidence_column(good: bytes, bad: bytes):
    @arrow_udf("double")
    def column(texts: pa.Array) -> pa.Array:
        return pa.array([evidence(t, good, bad) for t in texts.to_pylist()], pa.float64())

    return column


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """slope, intercept of P(1) = sigmoid(slope * x + intercept): weighted Newton steps with a small ridge."""
    scale = x.std() or 1.0
    a = np.stack([x / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (weight * p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        w = w + np.clip(np.linalg.solve(h, a.T @ (weight * (y - p)) - 1e-2 * w), -5, 5)
    return float(w[0] / scale), float(w[1])


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """A model from documents (doc_id, text) and labels (doc_id, quality).

    The labels are drawn first, by a hash of doc_id; so documents are only passed over, and what comes to the driver is bounded.
    """
    small_batches(docs.sparkSession)
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    slim = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    slim = slim.withColumn("half", half)
    counts = {(r["half"], r["quality"]): r["count"] for r in slim.groupBy("half", "quality").count().collect()}
    total = sum(counts.values())
    share = sum(n for (_, q), n in counts.items() if q) / total if total else 0.5
    drawn = [r for h in (0, 1) for q in (0, 1) for r in slim.where((F.col("half") == h) & (F.col("quality") == q)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TEXTS).collect()]
    if not all(counts.get((0, q)) for q in (0, 1)):
        return {"constant": share}
    chosen = F.broadcast(docs.sparkSession.createDataFrame(drawn, slim.schema))
    rows = keep(docs.select("doc_id", "text").where("text <> ''").join(chosen, "doc_id"))
    starts = F.sequence(F.lit(1), F.length("text"), F.lit(CHUNK))
    pieces = F.transform(starts, lambda s: F.struct(s.alias("at"), F.substring(F.col("text"), s, F.lit(CHUNK)).alias("chunk")))
    chunks = rows.where("half = 0").select("doc_id", "quality", F.explode(pieces).alias("c")).select("doc_id", "quality", "c.*")
    dictionaries = {}
    for quality in (1, 0):
        found = chunks.where(F.col("quality") == quality).orderBy(F.xxhash64("doc_id", "at"), "doc_id").limit(MAX_CHUNKS).collect()
        dictionaries[quality] = _dictionary([r["chunk"].encode("utf-8", "surrogatepass") for r in found])
    x = evidence_column(dictionaries[1], dictionaries[0])("text")
    seen = rows.where("half = 1").select("quality", x.alias("x")).toPandas()
    rows.unpersist()
    sizes = seen["quality"].value_counts()
    if len(sizes) < 2 or not (dictionaries[0] and dictionaries[1]):
        return {"constant": share}
    # Each class counts for as much as it has labels.
    weight = seen["quality"].map(lambda q: counts[1, q] / sizes[q]).to_numpy()
    slope, intercept = fit_curve(seen["x"].to_numpy(), seen["quality"].to_numpy().astype(float), weight * len(seen) / weight.sum())
    return {"good": dictionaries[1], "bad": dictionaries[0], "slope": slope, "intercept": intercept}


def _dictionary(samples: list[bytes]) -> bytes:
    """Trained; where the trainer refuses, as it does for a handful of samples, the samples themselves are the dictionary."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 4)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY_BYTES:]


def score(docs: DataFrame, model: dict, text: str = "text", out: str = "score") -> DataFrame:
    """docs with the probability of label 1."""
    small_batches(docs.sparkSession)
    if "constant" in model:
        return docs.withColumn(out, F.lit(model["constant"]))
    x = evidence_column(model["good"], model["bad"])(F.col(text))
    return docs.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-(x * F.lit(model["slope"]) + F.lit(model["intercept"])))))


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0
