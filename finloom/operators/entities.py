"""Who is who: duplicate companies, shared registration numbers, listings, and what is wrong with stored documents and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.functions import labels

#: Names this similar are one issuer's; keys are compared if they begin alike and differ by at most so many letters.
SIMILAR, PREFIX, LENGTHS = 0.93, 3, 4
#: A listing's name this similar is the company's own.
LISTED = 0.85


def duplicate_companies(companies: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """a, b, similarity: pairs of companies (company_id, name) that look like one issuer, a < b.

    Companies of one key are one group, whose members are paired with its least id only, so a name that many share costs a row
    each. Different keys of equal beginnings and near lengths are compared where candidates() finds a piece that they share.
    """
    keyed = companies.where("company_id is not null and name is not null").select("company_id", labels.company_key(F.col("name")).alias("key"))
    keyed = keyed.where("key <> ''").withColumn("dense", labels.squashed(F.col("key")))
    first = keyed.groupBy("dense").agg(F.min("company_id").alias("first"))
    same = keyed.join(first, "dense").where(F.col("company_id") != F.col("first")).select(F.col("first").alias("a"), F.col("company_id").alias("b"), F.lit(1.0).alias("similarity"))
    reps = keyed.groupBy("dense").agg(F.min_by(F.struct("company_id", "key"), "company_id").alias("r")).select("r.*")
    near = candidates(reps, threshold).withColumn("similarity", labels.key_similarity(F.col("key_x"), F.col("key_y"))).where(F.col("similarity") >= threshold)
    return same.unionByName(near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.round("similarity", 3).alias("similarity")))


def _edits(a: Column, b: Column, threshold: float) -> Column:
    """How many letters of two keys of these lengths may be unmatched: the ratio is 2 * matched / (a + b)."""
    return F.floor((1 - threshold) * (a + b) + 1e-9).cast("int")


def candidates(keys: DataFrame, threshold: float = SIMILAR) -> DataFrame:
    """x, key_x, y, key_y: all pairs of keys (company_id, key; each key once) that can reach the threshold, the shorter one as x.

    Matched letters keep their order in both keys, so at most d = (1 - threshold) * (a + b) letters lie between them. Equal
    beginnings can be matched whole, so these letters follow them: what follows in the shorter key is cut into d + 1 pieces (d for
    the longest partner), and one piece, left whole, stands in the longer key, moved by no more letters than were added or left out
    before it. Pieces are joined by their
    text, number and length of key, beside the beginning; no pair that reaches the threshold is lost.
    """
    rows = keys.select("company_id", "key", F.substring("key", 1, PREFIX).alias("start"), F.length("key").alias("long"))

    def cut(size: Column) -> Column:
        """The pieces of a key of this size: number, first letter (from 0), letters."""
        n = _edits(size, size + LENGTHS, threshold) + 1
        begin = F.least(size, F.lit(PREFIX))
        at = lambda i: begin + F.floor(i * (size - begin) / n).cast("int")
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("part"), at(i).alias("from"), (at(i + 1) - at(i)).alias("letters")))

    pieces = rows.select(F.col("company_id").alias("x"), F.col("key").alias("key_x"), "start", F.col("long").alias("size"), F.explode(cut(F.col("long"))).alias("p"))
    pieces = pieces.select("x", "key_x", "start", "size", "p.part", F.substr("key_x", F.col("p.from") + 1, F.col("p.letters")).alias("piece"))
    probes = rows.withColumn("more", F.explode(F.sequence(F.lit(0), F.lit(LENGTHS)))).withColumn("size", F.col("long") - F.col("more")).where("size > 0")
    probes = probes.withColumn("edits", _edits(F.col("size"), F.col("long"), threshold)).where("edits >= more")
    probes = probes.withColumn("p", F.explode(cut(F.col("size"))))
    back, forth = F.floor((F.col("edits") - F.col("more")) / 2).cast("int"), F.floor((F.col("edits") + F.col("more")) / 2).cast("int")
    probes = probes.withColumn("at", F.explode(F.sequence(F.col("p.from") - back, F.col("p.from") + forth))).where((F.col("at") >= F.least("long", F.lit(PREFIX))) & (F.col("at") + F.col("p.letters") <= F.col("long")))
    probes = probes.select(F.col("company_id").alias("y"), F.col("key").alias("key_y"), "start", "size", "p.part", F.substr("key", F.col("at") + 1, F.col("p.letters")).alias("piece"))
    pairs = pieces.join(probes, ["start", "size", "part", "piece"])
    pairs = pairs.where((F.col("x") != F.col("y")) & ((F.length("key_x") < F.length("key_y")) | (F.col("x") < F.col("y"))))
    return pairs.select("x", "key_x", "y", "key_y").distinct()


def duplicate_issues(pairs: DataFrame, companies: DataFrame) -> DataFrame:
    """Per pair: which of the two holds the data (holder), the other, and the fix; companies (company_id, docs, facts, listed)."""
    side = lambda c: companies.select(F.col("company_id").alias(c), F.struct("facts", "docs", "listed").alias(f"of_{c}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    first = (F.col("of_a.facts") > F.col("of_b.facts")) | ((F.col("of_a.facts") == F.col("of_b.facts")) & (F.col("of_a.docs") >= F.col("of_b.docs")))
    mine = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    rows = rows.select(mine("a", "b").alias("holder"), mine("b", "a").alias("other"), "similarity", mine("of_a", "of_b").alias("h"), mine("of_b", "of_a").alias("o"))
    fix = F.when(F.col("h.listed") & ~F.col("o.listed"), "delete other").when(~F.col("h.listed") & F.col("o.listed"), "move data to other").otherwise("check by hand")
    empty = (F.col("o.facts") == 0) & (F.col("o.docs") == 0)
    return rows.select("holder", "other", "similarity", F.when(empty, "low").otherwise("high").alias("severity"), fix.alias("fix"), (F.col("h.facts") + F.col("o.facts")).alias("facts_affected"))


def shared_registrations(documents: DataFrame) -> DataFrame:
    """registration, companies (how many), first_id: numbers that documents (company_id, text) of two companies or more show most."""
    found = documents.select("company_id", labels.registration_number(F.col("text")).alias("registration")).where("registration is not null")
    grouped = found.distinct().groupBy("registration").agg(F.count("*").alias("companies"), F.min("company_id").alias("first_id"))
    return grouped.where("companies > 1")


def listing_status(companies: DataFrame, listing: DataFrame, least: float = LISTED) -> DataFrame:
    """company_id, listed_name, status: OK, OTHER_ISSUER (the code is another name's) or UNLISTED; listing: stock_code, name."""
    rows = companies.join(listing.select("stock_code", F.col("name").alias("listed_name")), "stock_code", "left")
    alike = labels.key_similarity(labels.company_key(F.col("name")), labels.company_key(F.col("listed_name"))) >= least
    return rows.select("company_id", "listed_name", F.when(F.col("listed_name").isNull(), "UNLISTED").when(alike, "OK").otherwise("OTHER_ISSUER").alias("status"))


def junk_documents(documents: DataFrame) -> DataFrame:
    """document_id, kind, certain: why documents (document_id, file_name, pages, company_name, head) are no annual reports."""
    kinds = labels.junk_kinds(F.col("file_name"), F.col("pages"), F.col("company_name"), F.col("head"))
    return documents.select("document_id", F.inline(kinds))


def duplicate_documents(documents: DataFrame) -> DataFrame:
    """fingerprint, n, first_doc, last_doc: texts (document_id, text, pages) that stand in two documents or more."""
    rows = documents.select("document_id", labels.fingerprint(F.col("text"), F.col("pages")).alias("fingerprint")).where("fingerprint is not null")
    return rows.groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("document_id").alias("first_doc"), F.max("document_id").alias("last_doc")).where("n > 1")


def impact(issues: DataFrame, facts: DataFrame) -> DataFrame:
    """company_id, category, times, impact: issues (company_id, category, weight), facts (company_id, facts)."""
    counted = issues.groupBy("company_id", "category").agg(F.count("*").alias("times"), F.max("weight").alias("weight"))
    rows = counted.join(facts, "company_id", "left")
    score = F.col("weight") + 10 * F.log10(F.coalesce("facts", F.lit(0)) + F.lit(1.0)) + 2 * F.least(F.col("times"), F.lit(50))
    return rows.select("company_id", "category", "times", F.bround(score, 1).alias("impact"))


def fiscal_year_gaps(years: DataFrame) -> DataFrame:
    """company_id, gap_from, gap_to: runs of years without a row between a company's first and last."""
    following = F.lead("fy").over(Window.partitionBy("company_id").orderBy("fy"))
    return years.withColumn("next", following).where("next > fy + 1").select("company_id", (F.col("fy") + 1).alias("gap_from"), (F.col("next") - 1).alias("gap_to"))
