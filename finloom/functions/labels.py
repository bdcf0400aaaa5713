"""Row labels, company names, file names and page texts: keys to match by, and what they say of a document.

Native expressions, but for accents (a small column function over the standard library's normal forms) and the similarity of two
names (Ratcliff and Obershelp's ratio, from the standard library), for which Spark has none.
"""

from __future__ import annotations

import difflib
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Phrases of labels that say nothing of what a row is.
STOP_PHRASES = ["for the financial period", "for the financial year", "for the period", "for the year", "net of tax", "attributable to", "of the group", "continuing operations"]
#: What ends a company's name, and words of a country in brackets.
SUFFIXES = ["berhad", "bhd", "sdn", "plc", "ltd", "limited", "inc"]
COUNTRY = r"\((?:malaysia|m)\)"
#: Words that a Malay label is made of.
MALAY = ["dan", "yang", "bagi", "daripada", "kepada", "pada", "dalam", "lain", "jumlah", "tahun", "keuntungan", "kerugian", "hasil", "pendapatan", "aset", "liabiliti", "ekuiti", "tunai", "cukai", "kumpulan", "syarikat", "perbelanjaan", "modal", "saham"]


def _folded(texts: pa.Array) -> pa.Array:
    plain = lambda s: "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    return pa.array([s if s is None or s.isascii() else plain(s) for s in texts.to_pylist()], pa.string())


def without_accents(text: Column) -> Column:
    return arrow_udf(_folded, "string")(text)


def _replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    for pattern, by in pairs:
        text = F.regexp_replace(text, pattern, by)
    return text


def normalize_label(text: Column) -> Column:
    """The key of a printed row label."""
    out = F.lower(_replaced(without_accents(text), ("[‘’‛`´]", "'"), ("[–—−‐‑]", "-")))
    out = _replaced(
        out,
        (r"(?:^|[\s(,-]+)notes?\b[\s.]*(?:\d+[a-z]?|[a-z])?(?:[\s,&]+\d+[a-z]?)*[\s)]*$", ""),  # the numbers of notes that explain it
        (r"/\s*\([^)]*\)", " "),
        (r"\([^)]*\)\s*/\s*", " "),
        (r"^[^a-z0-9%(]+", ""),  # bullets
        (r"^\(?(?:[ivx]{1,3}|[a-z]|\d{1,2})[.)]\s+", ""),  # numbering
        (r"\.{2,}", " "),
        (r"[^a-z0-9%' ]+", " "),
        (r"\s+\d{1,3}\s*$", ""),
    )
    for phrase in STOP_PHRASES:
        out = F.replace(out, F.lit(phrase), F.lit(" "))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def looks_malay(label: Column) -> Column:
    """Whether half of a label's words or more are Malay."""
    words = F.filter(F.split(F.lower(label), r"[^a-z]+"), lambda w: w != "")
    return (F.size(words) > 0) & (2 * F.size(F.filter(words, lambda w: w.isin(*MALAY))) >= F.size(words))


def company_key(name: Column) -> Column:
    """The comparison key of a company's name: 'S P Setia Berhad' and 'SP Setia Bhd.' have the same."""
    out = _replaced(F.lower(name), (COUNTRY, " "), ("&", " and "), ("['’]", ""), ("[^a-z0-9]+", " "))
    out = _replaced(F.trim(out), (r"(?<=(?:^| )[a-z]) (?=[a-z](?: |$))", ""))  # single letters in a row are one word
    out = _replaced(out, (r"\breal estate investment trust\b", "reit"), (r"\bcorporation\b", "corp"), (r"\bcompany\b", "co"))
    short = F.array_join(F.filter(F.split(out, " +"), lambda w: ~w.isin(*SUFFIXES)), " ")
    return F.when(short == "", out).otherwise(short)


def squashed(key: Column) -> Column:
    return F.replace(key, F.lit(" "), F.lit(""))


def _ratios(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a.to_pylist(), b.to_pylist())], pa.float64())


def key_similarity(a: Column, b: Column) -> Column:
    """Of two company keys: 1 if equal, 0.99 if equal without spaces, else their ratio."""
    return F.when(a == b, 1.0).when(squashed(a) == squashed(b), 0.99).otherwise(arrow_udf(_ratios, "double")(a, b))


def name_appears(name: Column, text: Column) -> Column:
    """Whether a text names a company: its key, its key without spaces (of five letters or more), or its first two long words."""
    key, body = company_key(name), company_key(text)
    long = F.slice(F.filter(F.split(key, " "), lambda w: F.length(w) >= 4), 1, 2)
    whole = F.concat(F.lit(" "), body, F.lit(" ")).contains(F.concat(F.lit(" "), key, F.lit(" ")))
    dense = (F.length(squashed(key)) >= 5) & squashed(body).contains(squashed(key))
    both = (F.size(long) == 2) & F.forall(long, lambda w: body.contains(w))
    return F.coalesce((key != "") & (whole | dense | both), F.lit(False))


def registration_number(text: Column) -> Column:
    """The 12-digit number that a text shows most often, the first of equals; null for none."""
    found = F.regexp_extract_all(text, F.lit(r"\b(\d{12})\b"), F.lit(1))
    counted = F.transform(F.array_distinct(found), lambda n: F.struct(F.size(F.filter(found, lambda m: m == n)).alias("times"), (-F.array_position(found, n)).alias("place"), n.alias("number")))
    return F.get(F.reverse(F.array_sort(counted)), F.lit(0))["number"]


def fingerprint(text: Column, pages: Column) -> Column:
    """SHA-1 of page count and the first 20,000 normalised characters; null below 500 of them."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " "))
    return F.when(F.length(plain) >= 500, F.sha1(F.concat_ws("|", F.coalesce(pages, F.lit(0)).cast("string"), F.substring(plain, 1, 20_000)).cast("binary")))


def is_scanned(text: Column, pages: Column) -> Column:
    """Fewer than 80 characters a page: an image without a text layer."""
    return F.length(F.trim(F.coalesce(text, F.lit("")))) < 80 * F.greatest(F.coalesce(pages, F.lit(1)), F.lit(1))


#: Words of a file's name, in lower case, by what they make of it. A phrase is a tuple of words that follow each other.
BROKERS = {"rhb", "hlib", "publicinvest", "midf", "uobkh", "aminvest", "kenanga", "cimb", "pb"}
BROKER_PHRASES = [("initiating", "coverage"), ("results", "review"), ("result", "review"), ("pb", "stock"), ("rhb", "research"), ("affin", "hwang"), ("ta", "research"), ("maybank", "ib")]
DECKS = {"presentation", "briefing", "slides", "deck"}
NOTICES = {"circular", "prospectus", "abridged", "egm"}
GROUP_BUSINESS = {"islamic", "takaful", "insurance"}


def file_words(name: Column) -> Column:
    """The words of a file's name without its ending: cut at all that is no letter or digit, and between a letter and a digit after it."""
    stem = F.regexp_replace(F.lower(name), r"\.[a-z0-9]+$", "")
    return F.filter(F.split(F.regexp_replace(stem, r"(?<=[a-z])(?=\d)", " "), r"[^a-z0-9]+"), lambda w: w != "")


def _has(words: Column, some) -> Column:
    return F.arrays_overlap(words, F.array(*map(F.lit, sorted(some))))


def _phrase(words: Column, *phrase: str) -> Column:
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")).contains(f" {' '.join(phrase)} ")


def junk_kinds(name: Column, pages: Column, company: Column, head: Column) -> Column:
    """array(struct(kind, certain)): why a document is no annual report, from its name, page count and first pages."""
    words, text = file_words(name), F.lower(F.coalesce(head, F.lit("")))
    pages = F.coalesce(pages, F.lit(0))
    last = F.element_at(words, -1)
    test = (last == "test") | ((F.element_at(F.slice(F.reverse(words), 1, 2), -1) == "test") & last.rlike(r"^\d+$"))
    mentions = ["target price", "price target", "maintain buy", "maintain sell", "maintain hold", "upgrade to", "downgrade to", "research analyst", "analyst certification", "stock rating"]
    said = sum(((F.length(text) - F.length(F.replace(text, F.lit(m), F.lit("")))) / len(m) for m in mentions), F.lit(0.0))
    broker = _has(words, BROKERS - {"pb", "cimb"}) | F.exists(F.array(*(_phrase(words, *p) for p in BROKER_PHRASES)), lambda x: x)
    annual = _phrase(words, "annual", "report") | _has(words, {"ar", "annualreport"})
    sustain = F.exists(words, lambda w: w.startswith("sustainab") | (w == "esg"))
    cover = text.rlike(r"sustainability\s+(?:report|statement)") & ~text.rlike(r"annual\s+report|financial\s+statements|financial\s+position|directors.?\s*report")
    sheet = F.exists(words, lambda w: w.startswith("statistic")) & _has(words, {"key"}) | _phrase(words, "fact", "sheet") | _has(words, {"factsheet"})
    other = _has(words, GROUP_BUSINESS) | _phrase(words, "i", "bank") | _phrase(words, "investment", "bank")
    own = F.lower(F.coalesce(company, F.lit(""))).rlike("|".join(sorted(GROUP_BUSINESS)) + "|investment bank")
    verdicts = [
        ("TEST_FILE", test, True),
        ("BROKER_NOTE", broker & (pages <= 30), True),
        ("BROKER_NOTE", ~(broker & (pages <= 30)) & pages.between(1, 12) & (said >= 2), False),
        ("KEY_STATISTICS", sheet | pages.between(1, 2), True),
        ("SUSTAINABILITY_ONLY", sustain & ~annual, True),
        ("SUSTAINABILITY_ONLY", ~sustain & ~annual & cover, False),
        ("PRESENTATION", _has(words, DECKS), True),
        ("CIRCULAR", _has(words, NOTICES) | _phrase(words, "notice", "of", "agm"), True),
        ("SUBSIDIARY_REPORT", other & ~own, False),
    ]
    found = F.array(*(F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(kind).alias("kind"), F.lit(certain).alias("certain"))) for kind, when, certain in verdicts))
    return F.filter(found, lambda v: v.isNotNull())


def file_hints(name: Column) -> Column:
    """struct(code, doc_type, fiscal_year, quarter, day) that a file's name gives; a quarter outranks 'annual', a year is no code."""
    stem = F.lower(F.regexp_replace(name, r"\.[A-Za-z0-9]+$", ""))
    nothing = lambda c: F.nullif(c, F.lit(""))
    code = nothing(F.regexp_extract(stem, r"(?:^|[^0-9])((?!(?:19|20)\d\d(?:[^0-9]|$))\d{4,5})(?=[^0-9]|$)", 1))
    quarter = nothing(F.regexp_extract(stem, r"(?:^|[^a-z0-9])q([1-4])(?=[^0-9]|$)", 1)).cast("int")
    day = F.try_to_date(nothing(F.regexp_extract(stem, r"((?:19|20)\d\d-\d\d-\d\d)", 1)))
    year = nothing(F.regexp_extract(stem, r"(?:^|[^0-9])((?:19|20)\d\d)(?=[^0-9]|$)", 1)).cast("int")
    annual = stem.rlike(r"annual|(?:^|[^a-z])ar(?=[^a-z]|$)")
    kind = F.when(quarter.isNotNull() | stem.rlike("quarter|interim"), "QUARTERLY").when(annual, "ANNUAL").otherwise("OTHER")
    return F.struct(code.alias("code"), kind.alias("doc_type"), year.alias("fiscal_year"), quarter.alias("quarter"), day.alias("day"))
