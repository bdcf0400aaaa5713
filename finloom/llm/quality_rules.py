"""Quality rules: base rules, then robust multivariate outliers among the documents of one language and source.

Each text gives a vector of six transformed statistics: mean word length; symbols, repeated lines, words in repeated windows, words
equal to the one before, and words in capitals, each as the logarithm of a rate. Location and scatter of each group are
minimum-covariance-determinant estimates. Concentration steps start from three places (medians with quartile ranges, medians with
the covariance of spatial signs, means with the plain covariance); each keeps the three quarters of rows with the smallest
Mahalanobis distances and estimates anew, the start that ends at the lowest determinant wins, and a last step reweights. All rows
take part in each step; a step is two aggregations with partial sums, so a source with a third of all rows costs no more than its
share. Statistics are whole numbers of 1 / SCALE, sums are sums of whole numbers, and quantiles are read from counts on a fixed
grid, so no verdict depends on how rows are laid out in files.

Estimates are made for all documents, for each language, and for each source of a language; each is drawn towards the wider one
with the weight STRENGTH / (n + STRENGTH), so one rule holds for groups of all sizes. FLOORS are the least standard deviations in
any direction. A document is rejected when its squared distance exceeds the chi-squared quantile with the given tail.

Defined results: a null text has no words, like an empty one, and fails the base rules; a null language or source is a value of its
own; repeated rows and rows with equal statistics are judged alike; texts are read whole, however long; an empty table gives no
rows; further columns, of any name, pass through reject() untouched.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from finloom.llm.common import keep, settle, small_batches

SYMBOLS = "#*$%&|<>"
WINDOW = 8
SUBSET = 0.75
STEPS = 3
TAIL = 1e-6
STRENGTH = 60.0
#: Statistics are counted in steps of one in so many.
SCALE = 256
#: Distances are counted in so many cells an octave.
CELLS = 64
#: Least standard deviations; those of repetition are wide, as clean texts repeat a line or a passage now and then, and the base rule bounds the latter.
FLOORS = (0.3, 0.5, 0.6, 1.0, 0.5, 0.6)
#: Up to this many groups their estimates (three starts of 29 numbers each, about 900 bytes) are broadcast; of more, joined by a shuffle.
BROADCAST_GROUPS = 20_000
P = len(FLOORS)


#: Long texts are cut into words so many bytes at a time.
PART_BYTES = 1 << 20
WHITE = re.compile(rb"[\x20\x09-\x0D]")


def word_codes(data: bytes) -> tuple[np.ndarray, int]:
    """A number for each word, equal for equal words; and how many words are in capitals.

    bytes.split() cuts at the six white-space characters of ASCII, as the contract has them.
    """
    codes: dict[bytes, int] = {}
    parts, capitals, at = [np.zeros(0, np.int64)], 0, 0
    while at < len(data):
        end = len(data)
        if end - at > PART_BYTES and (cut := WHITE.search(data, at + PART_BYTES)):
            end = cut.start()
        words = data[at:end].split()
        parts.append(np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words)))
        capitals += sum(map(bytes.isupper, words))
        at = end
    return np.concatenate(parts), capitals


def repetition(ids: np.ndarray) -> tuple[int, int]:
    """How many words stand in a window of eight that occurs twice or more, and how many equal the word before."""
    n, stutters = len(ids), int((ids[1:] == ids[:-1]).sum())
    if n <= WINDOW:
        return 0, stutters
    for step in (1, 2, 4):  # ids of windows of two, four, eight words
        ids = np.unique(ids[:-step] * (int(ids.max()) + 1) + ids[step:], return_inverse=True)[1]
    again = np.bincount(ids)[ids] > 1
    if not again.any():
        return 0, stutters
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, np.flatnonzero(again), 1)
    np.add.at(edges, np.flatnonzero(again) + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum()), stutters


STATISTICS = "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long, n_lines: long, n_stutters: long, n_capitals: long>"


def statistics(texts: pa.Array) -> pa.Array:
    """Read from the texts' UTF-8 bytes: all that is counted is ASCII, and code points are the bytes that continue none."""
    rows = []
    for text in texts:
        data = text.as_buffer().to_pybytes() if text.is_valid else b""
        ids, capitals = word_codes(data)
        repeated, stutters = repetition(ids)
        points = len(data) - int((np.frombuffer(data, np.uint8) & 0xC0 == 0x80).sum())
        lines = [x for x in data.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
        rows.append((len(ids), points - sum(map(data.count, (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))), sum(data.count(s.encode()) for s in SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines), stutters, capitals))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutters", "n_capitals"]
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * 8)], names)


def chi2_cdf(x: float, dof: int) -> float:
    """For even degrees of freedom."""
    term = total = 1.0
    for i in range(1, dof // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(tail: float, dof: int) -> float:
    """The x with P(X > x) = tail."""
    low, high = 0.0, 2000.0
    for _ in range(200):
        mid = (low + high) / 2
        term = total = 1.0
        for i in range(1, dof // 2):
            term *= mid / 2 / i
            total += term
        low, high = (mid, high) if math.exp(-mid / 2) * total > tail else (low, mid)
    return low


@lru_cache(maxsize=4096)
def _consistency(share: float) -> float:
    """What makes the covariance of the share of rows nearest to the centre that of all rows, under normality."""
    return share / chi2_cdf(chi2_quantile(1 - share, P), P + 2) if share < 1 else 1.0


X = [f"_qr_x{i}" for i in range(P)]
KEYS = ["_qr_level", "_qr_lang", "_qr_source"]
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def _vector() -> dict[str, Column]:
    words = F.col("n_words").cast("double")
    shrunk = (F.col("word_chars") + 40 * 6.0) / (words + 40)
    per_hundred = lambda a, b: F.log1p(100.0 * F.col(a) / b)
    lines = F.col("n_lines") + 5.0
    values = [6.0 * F.log(shrunk / 6.0), per_hundred("n_symbols", words + 20), per_hundred("n_dup_lines", lines), *(per_hundred(c, words + 20) for c in ("n_repeat_words", "n_stutters", "n_capitals"))]
    return {x: F.round(v * SCALE).cast("long") for x, v in zip(X, values)}


def _distance() -> Column:
    gap = [F.col(x) / F.lit(float(SCALE)) - F.col("_qr_m")[i] for i, x in enumerate(X)]
    terms = [gap[i] * gap[j] * F.col("_qr_inv")[i * P + j] * F.lit(1.0 if i == j else 2.0) for i, j in PAIRS]
    return sum(terms[1:], terms[0])


def _cell() -> Column:
    """The grid cell of a squared distance."""
    return F.floor(F.log2(F.greatest(_distance(), F.lit(0.0)) + F.lit(2.0**-20)) * CELLS).cast("int")


def floored(cov: np.ndarray) -> np.ndarray:
    """The covariance with the least standard deviations in all directions."""
    d = np.array(FLOORS)
    values, vectors = np.linalg.eigh(cov / np.outer(d, d))
    return (vectors * np.maximum(values, 1.0)) @ vectors.T * np.outer(d, d)


def _square(upper: list) -> np.ndarray:
    out = np.zeros((P, P))
    for (i, j), v in zip(PAIRS, upper):
        out[i, j] = out[j, i] = v
    return out


ESTIMATE = "struct<m: array<double>, cov: array<double>, inv: array<double>, logdet: double>"


def _estimates(centres: list[np.ndarray], covs: list[np.ndarray]) -> pa.Array:
    out = [floored((c + c.T) / 2) for c in covs]
    lists = lambda xs: pa.array([np.ravel(x).tolist() for x in xs], pa.list_(pa.float64()))
    inverses, dets = [np.linalg.inv(c) for c in out], [float(np.linalg.slogdet(c)[1]) for c in out]
    return pa.StructArray.from_arrays([lists(centres), lists(out), lists(inverses), pa.array(dets, pa.float64())], ["m", "cov", "inv", "logdet"])


def _from_sums(n: pa.Array, total: pa.Array, s: pa.Array, q: pa.Array) -> pa.Array:
    """From the sums over n of total rows to centre and covariance, made consistent for the share that n is."""
    centres, covs = [], []
    for rows, all_rows, sums, squares in zip(n.to_pylist(), total.to_pylist(), s.to_pylist(), q.to_pylist()):
        mean = np.array(sums, float) / rows / SCALE
        centres.append(mean)
        covs.append((_square(squares) / rows / SCALE**2 - np.outer(mean, mean)) * _consistency(round(rows / all_rows, 3)))
    return _estimates(centres, covs)


def _from_spread(centre: pa.Array, shape: pa.Array) -> pa.Array:
    """From medians and a covariance (upper half) in steps of 1 / SCALE."""
    return _estimates([np.array(m, float) / SCALE for m in centre.to_pylist()], [_square(v) / SCALE**2 for v in shape.to_pylist()])


def _sums() -> list[Column]:
    s = F.array(*[F.sum(x) for x in X])
    q = F.array(*[F.sum(F.col(X[i]) * F.col(X[j])) for i, j in PAIRS])
    return [F.count("*").alias("n"), s.alias("s"), q.alias("q")]


def _opened(rows: DataFrame, *names: str) -> DataFrame:
    return rows.select(*KEYS, *names, F.col("e.m").alias("_qr_m"), F.col("e.cov").alias("_qr_cov"), F.col("e.inv").alias("_qr_inv"), F.col("e.logdet").alias("_qr_logdet"))


def _quartiles(points: DataFrame) -> DataFrame:
    """KEYS, total, q: array of (q1, median, q3) for each statistic, from counts of its values."""
    cells = points.select(*KEYS, F.posexplode(F.array(*X)).alias("i", "x")).groupBy(*KEYS, "i", "x").agg(F.count("*").alias("c"))
    upto = Window.partitionBy(*KEYS, "i").orderBy("x")
    cells = cells.withColumns({"upto": F.sum("c").over(upto), "total": F.sum("c").over(Window.partitionBy(*KEYS, "i"))})
    at = lambda share: F.min(F.when(F.col("upto") >= F.col("total") * share, F.col("x")))
    each = cells.groupBy(*KEYS, "i").agg(F.max("total").alias("total"), F.array(at(0.25), at(0.5), at(0.75)).alias("q"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "q")))  # one entry per statistic
    return each.groupBy(*KEYS).agg(F.max("total").alias("total"), F.transform(ordered, lambda e: e["q"]).alias("q"))


def concentrated(points: DataFrame) -> tuple[DataFrame, bool]:
    """The estimates of lowest determinant, without the last step; and whether the table is small."""
    quartiles = settle(_quartiles(points), "mcd-quartiles")
    small = quartiles.count() <= BROADCAST_GROUPS
    beside = (lambda df: F.broadcast(df)) if small else (lambda df: df)

    middle = F.transform("q", lambda v: v[1])
    scale = [(F.col("q")[i][2] - F.col("q")[i][0]) / 1.349 + F.lit(SCALE * FLOORS[i] / 4) for i in range(P)]
    ranges = F.array(*[scale[i] * scale[i] if i == j else F.lit(0.0) for i, j in PAIRS])
    first = quartiles.select(*KEYS, "total", F.lit(0).alias("start"), arrow_udf(_from_spread, ESTIMATE)(middle, ranges).alias("e"))
    # Spatial signs: directions from the medians, in whole millionths, put back to the scale of the quartile ranges.
    z = [(F.col(X[i]) - F.col("q")[i][1]) / scale[i] for i in range(P)]
    length = sum((v * v for v in z[1:]), z[0] * z[0]) + F.lit(1e-9)
    placed = points.join(beside(quartiles), KEYS)
    signs = placed.groupBy(*KEYS).agg(*[F.sum(F.round(z[i] * z[j] / length * 1e6).cast("long")).alias(f"u{i}{j}") for i, j in PAIRS])
    signs = signs.join(beside(quartiles), KEYS)
    shape = F.array(*[F.col(f"u{i}{j}") / F.lit(1e6) / F.col("total") * P * scale[i] * scale[j] for i, j in PAIRS])
    second = signs.select(*KEYS, "total", F.lit(1).alias("start"), arrow_udf(_from_spread, ESTIMATE)(middle, shape).alias("e"))
    plain = points.groupBy(*KEYS).agg(*_sums()).withColumn("total", F.col("n"))
    third = plain.select(*KEYS, "total", F.lit(2).alias("start"), arrow_udf(_from_sums, ESTIMATE)("n", "total", "s", "q").alias("e"))
    params = settle(_opened(first.unionByName(second).unionByName(third), "total", "start"), "mcd-start")

    for step in range(STEPS):
        measured = points.join(beside(params), KEYS).withColumn("_qr_cell", _cell()).select(*KEYS, "start", "total", "_qr_cell", *X)
        counts = measured.groupBy(*KEYS, "start", "total", "_qr_cell").agg(F.count("*").alias("c"))
        upto = F.sum("c").over(Window.partitionBy(*KEYS, "start").orderBy("_qr_cell"))
        cut = counts.withColumn("upto", upto).where(F.col("upto") >= F.col("total") * SUBSET).groupBy(*KEYS, "start").agg(F.min("_qr_cell").alias("_qr_cut"))
        near = measured.join(beside(cut), [*KEYS, "start"]).where("_qr_cell <= _qr_cut")
        sums = near.groupBy(*KEYS, "start", "total").agg(*_sums())
        params = settle(_opened(sums.select(*KEYS, "start", "total", arrow_udf(_from_sums, ESTIMATE)("n", "total", "s", "q").alias("e")), "total", "start"), f"mcd-step{step}")

    names = ["_qr_m", "_qr_cov", "_qr_inv", "_qr_logdet"]
    best = params.groupBy(*KEYS).agg(F.max("total").alias("total"), F.min(F.struct(F.round("_qr_logdet", 6), "start", *names)).alias("b")).select(*KEYS, "total", *(f"b.{c}" for c in names))
    return best, small


def mcd(points: DataFrame) -> DataFrame:
    """KEYS, total (rows), _qr_m, _qr_cov, _qr_inv, _qr_logdet: an estimate for each group of points (KEYS and X)."""
    best, small = concentrated(points)
    inner = points.join(F.broadcast(best) if small else best, KEYS).where(_distance() <= chi2_quantile(0.025, P)).groupBy(*KEYS, "total").agg(*_sums())
    # All of the rows nearest to the centre are in, but for outliers: the share is that of the quantile.
    last = inner.select(*KEYS, "total", arrow_udf(_from_sums, ESTIMATE)("n", F.round(F.col("n") / 0.975).cast("long"), "s", "q").alias("e"))
    return settle(_opened(last, "total"), "mcd")


def _drawn(n0: pa.Array, m0: pa.Array, c0: pa.Array, n1: pa.Array, m1: pa.Array, c1: pa.Array, n2: pa.Array, m2: pa.Array, c2: pa.Array) -> pa.Array:
    """A source's estimate drawn to its language's, and that to the one of all documents."""
    centres, inverses = [], []
    for row in zip(*(c.to_pylist() for c in (n0, m0, c0, n1, m1, c1, n2, m2, c2))):
        centre, cov = np.array(row[1]), np.array(row[2])
        for n, m, c in (row[3:6], row[6:9]):
            w = n / (n + STRENGTH)
            centre, cov = w * np.array(m) + (1 - w) * centre, w * np.array(c) + (1 - w) * cov
        centres.append(centre.tolist())
        inverses.append(np.linalg.inv(cov.reshape(P, P)).ravel().tolist())
    floats = pa.list_(pa.float64())
    return pa.StructArray.from_arrays([pa.array(centres, floats), pa.array(inverses, floats)], ["m", "inv"])


def _judges(fit: DataFrame) -> tuple[DataFrame, bool]:
    """_qr_lang, _qr_source, _qr_group_rows, _qr_m, _qr_inv for each language and source, and whether the table is small."""
    levels = [(0, F.lit(""), F.lit("")), (1, F.col("_qr_lang"), F.lit("")), (2, F.col("_qr_lang"), F.col("_qr_source"))]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("_qr_level"), lang.alias("_qr_lang"), source.alias("_qr_source")) for k, lang, source in levels]))
    found = mcd(fit.select(each.alias("k"), *X).select("k.*", *X))
    part = lambda k, *keys: found.where(F.col("_qr_level") == k).select(*keys, F.col("total").alias(f"n{k}"), F.col("_qr_m").alias(f"m{k}"), F.col("_qr_cov").alias(f"c{k}"))
    joined = part(2, "_qr_lang", "_qr_source").join(part(1, "_qr_lang"), "_qr_lang").join(F.broadcast(part(0)), F.lit(True))
    drawn = joined.select("_qr_lang", "_qr_source", "n2", arrow_udf(_drawn, "struct<m: array<double>, inv: array<double>>")(*(f"{c}{k}" for k in range(3) for c in "nmc")).alias("e"))
    table = settle(drawn.select("_qr_lang", "_qr_source", F.col("n2").alias("_qr_group_rows"), F.col("e.m").alias("_qr_m"), F.col("e.inv").alias("_qr_inv")), "judges")
    return table, table.count() <= BROADCAST_GROUPS


def _measured(docs: DataFrame, names: list[str], text: str) -> DataFrame:
    """The named columns as one struct (so they may bear any name), the statistics, base_failed, and what judges are found by."""
    row = F.struct(*(F.col(f"`{c}`") for c in names)) if names else F.lit(None)
    # Called nondeterministic, so that it runs once and not again for a filter.
    measure = arrow_udf(statistics, STATISTICS).asNondeterministic()
    rows = docs.select(row.alias("_qr_row"), "lang", "source", measure(F.col(text)).alias("_qr_s")).select("_qr_row", "lang", "source", "_qr_s.*")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    named = {f"_qr_{c}": F.concat(F.lit("="), F.coalesce(c, F.lit("\0"))) for c in ("lang", "source")}
    return rows.withColumn("base_failed", failed).withColumns({**_vector(), **named})


def _judged(rows: DataFrame, judges: DataFrame, small: bool, tail: float) -> DataFrame:
    joined = rows.join(F.broadcast(judges) if small else judges, ["_qr_lang", "_qr_source"], "left").withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= chi2_quantile(tail, P)))


def judged(docs: DataFrame, text: str = "text", tail: float = TAIL) -> DataFrame:
    """docs (its columns without text, as one struct) with the statistics, base_failed, group_rows, distance (null if base_failed) and kept."""
    small_batches(docs.sparkSession)
    rows = keep(_measured(docs, [c for c in docs.columns if c != text], text))
    judges, small = _judges(rows.where("not base_failed").select("_qr_lang", "_qr_source", *X))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = settle(_judged(rows, judges, small, tail).select("_qr_row", *counts, F.col("_qr_group_rows").alias("group_rows"), "distance", "kept"), "judged")
    rows.unpersist()
    return out


def verdicts(docs: DataFrame) -> DataFrame:
    rows = judged(docs.select("doc_id", "text", "lang", "source"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return rows.select("_qr_row.doc_id", *counts, "kept", F.round("distance", 6).alias("distance"), "group_rows")


def reject(docs: DataFrame, text: str = "text", tail: float = TAIL) -> DataFrame:
    """The rows of docs that are kept, with their columns, whatever their doc_ids.

    Texts are read twice, for the estimates and for the verdicts, so that no text is shuffled: a verdict travels with its row.
    """
    small_batches(docs.sparkSession)
    points = keep(_measured(docs, [], text).where("not base_failed").select("_qr_lang", "_qr_source", *X))
    judges, small = _judges(points)
    points.unpersist()
    return _judged(_measured(docs, docs.columns, text), judges, small, tail).where("kept").select("_qr_row.*")
