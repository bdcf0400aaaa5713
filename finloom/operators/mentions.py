"""Whom a text is about: mentions of companies weighted by place, with the registration number printed beside the name.

A mention ends at Berhad or Bhd, and takes the capitalised words before it. A text is cut before each legal form, and of a piece only
its length, its first characters and its last words are looked at, so mentions are found within the row of their text: nothing but
them is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions.labels import company_key
from finloom.functions.words import let

#: Words before the legal form that a name may have; characters of the head, whose mentions count more, and by how much; characters
#: after a name within which its number stands.
NAME_WORDS, HEAD, HEAD_WEIGHT, NEAR = 6, 3000, 3, 120
FORMS = ["berhad", "bhd"]
#: Where a word begins that is a legal form but for what is no letter; sizes that are summed at a stretch.
AT_FORM, STRETCH = f"(?i)(?<= )(?=(?:{'|'.join(FORMS)})(?![a-z]))", 256
#: Keys that are no company.
NOBODY = ["", "the", "company", "the company", "group", "of the"]


def _starts(sizes: Column) -> Column:
    """The sum of the sizes before each one; by stretches, so that the work for long arrays stays near linear."""
    add = lambda of: F.aggregate(of, F.lit(0), lambda a, x: a + x)
    stretches = F.transform(F.sequence(F.lit(0), ((F.size(sizes) - 1) / STRETCH).cast("int")), lambda k: F.slice(sizes, k * STRETCH + 1, STRETCH))

    def within(stretch: Column, before: Column) -> Column:
        return F.transform(stretch, lambda _, i: before + add(F.slice(stretch, 1, i)))

    def all_of(split: Column) -> Column:
        sums = F.transform(split, add)
        return let(sums, lambda of: F.flatten(F.transform(split, lambda s, k: let(add(F.slice(of, 1, k)), lambda before: within(s, before)))))

    return let(stretches, all_of)


def _ends(text: Column) -> Column:
    """Array of struct(place, before, after) for each legal form in a text of single blanks: its place, the words before, the text from it on."""
    pieces = F.split(F.concat(F.lit(" "), text), AT_FORM)
    reach = max(map(len, FORMS)) + NEAR + 1
    parts = F.transform(pieces, lambda p: F.struct(F.length(p).alias("size"), F.substring(p, 1, reach).alias("head"), F.substring_index(p, " ", -NAME_WORDS - 1).alias("tail")))

    def placed(parts: Column, starts: Column) -> Column:
        # A piece from the second on has a word at least, and the least one (bhd and a blank) four characters.
        tails = lambda i: F.transform(F.slice(parts, F.greatest(i - NAME_WORDS, F.lit(0)) + 1, F.least(i, F.lit(NAME_WORDS))), lambda p: p["tail"])
        heads = lambda i: F.transform(F.slice(parts, i + 1, reach // 4 + 1), lambda p: p["head"])
        before = lambda i: F.substring_index(F.trim(F.array_join(tails(i), "")), " ", -NAME_WORDS)
        each = F.transform(parts, lambda _, i: F.struct((F.get(starts, i) - 1).alias("place"), before(i).alias("before"), F.substring(F.array_join(heads(i), ""), 1, reach).alias("after")))
        return F.slice(each, 2, F.size(parts))

    return let(parts, lambda parts: let(_starts(F.transform(parts, lambda p: p["size"])), lambda starts: placed(parts, starts)))


def mentions(texts: DataFrame) -> DataFrame:
    """doc, place (in characters), key (the name's last two words, normalised), weight, number (12 digits beside the name, or null).

    texts: doc, text.
    """
    ends = texts.select("doc", F.inline(_ends(F.trim(F.regexp_replace("text", r"\s+", " ")))))
    # A private company's form is Sdn Bhd.
    ends = ends.where(~F.lower(F.substring_index("before", " ", -1)).startswith("sdn"))
    # Each mention is made once as a struct and then judged: as columns, a filter would repeat the work on its names.
    return ends.select("doc", F.inline(F.filter(F.array(_mention()), lambda m: m["sound"]))).drop("sound")


def _mention() -> Column:
    """struct(place, key, weight, number, sound) of a row of _ends(); sound: it names a company."""

    def named(before: Column) -> Column:
        # The words from the last one that is not capitalised on.
        plain = F.array_max(F.transform(before, lambda w, i: F.when(~w.rlike(r"^[A-Z0-9&]"), i + 1).otherwise(0)))
        name = F.array_join(F.slice(before, F.coalesce(plain, F.lit(0)) + 1, NAME_WORDS), " ")
        return let(F.split(company_key(name), " "), of_tokens)

    def of_tokens(tokens: Column) -> Column:
        last, key = F.element_at(tokens, -1), F.array_join(F.slice(tokens, F.greatest(F.size(tokens) - 1, F.lit(1)), 2), " ")
        return F.struct(key.alias("key"), (~last.isin("sdn", *FORMS) & ~last.rlike("^[0-9]+$") & ~key.isin(NOBODY)).alias("sound"))

    near = F.length(F.regexp_extract("after", "^[A-Za-z]+", 0)) + NEAR
    # Of a word that goes on beyond, no part counts.
    whole = F.when(F.length("after") > near, F.regexp_replace(F.substring("after", F.lit(1), near + 1), "[^ ]*$", "")).otherwise(F.col("after"))
    number = F.nullif(F.regexp_extract(whole, r"(?<![0-9])([0-9]{12})(?![0-9])", 1), F.lit(""))
    weight = F.when(F.col("place") < HEAD, HEAD_WEIGHT).otherwise(1)
    return let(let(F.split("before", " "), named), lambda n: F.struct(F.col("place").alias("place"), n["key"].alias("key"), weight.alias("weight"), number.alias("number"), n["sound"].alias("sound")))


def dominant(texts: DataFrame) -> DataFrame:
    """doc, key, weight, number: the company that a text names most, of equals the one named first, with its most printed number."""
    # One shuffle: all that follows groups the mentions of a document finer or by itself.
    found = mentions(texts).repartition("doc")
    numbers = found.groupBy("doc", "key", "number").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"), F.min("place").alias("seen"))
    printed = F.when(F.col("number").isNotNull(), F.struct("n", -F.col("seen")))
    named = numbers.groupBy("doc", "key").agg(F.sum("weight").alias("weight"), F.min("seen").alias("seen"), F.max_by("number", printed).alias("number"))
    return named.groupBy("doc").agg(F.max_by(F.struct("key", "weight", "number"), F.struct("weight", -F.col("seen"))).alias("b")).select("doc", "b.*")


_NAME = "case {} % 5 when 0 then 'Alpha Nusantara' when 1 then 'Beta Maju' when 2 then 'Gamma Sentosa' when 3 then 'Delta Perkasa' else 'Epsilon Jaya' end"
#: Covers of reports: a company with its number, and others that are named up to three times, far down in every third.
COVERS = f"""covers as (
    select o_orderkey as doc, 'Annual Report of ' || {_NAME.format("o_custkey")} || ' Berhad (' || cast(200001000000 + o_orderkey as varchar(20)) || ') and subsidiaries ' || case when o_orderkey % 3 = 0 then repeat('filler ', 600) else 'with ' end
        || repeat('its partner ' || {_NAME.format("o_orderkey")} || ' Bhd. ' || 'and Rubber Works Sdn Bhd ', cast(o_orderkey % 6 as int)) || repeat('more ', 40) || '199901000001' as text
    from orders
)"""


def dominant_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").createOrReplaceTempView("orders")
    return dominant(spark.sql(f"with {COVERS} select doc, text from covers"))


#: Weights counted from the keys that made the text.
DOMINANT_SQL = f"""
with named as (
    select o_orderkey as doc, lower({_NAME.format("o_custkey")}) as own, lower({_NAME.format("o_orderkey")}) as other, o_orderkey % 6 * case when o_orderkey % 3 = 0 then 1 else 3 end as others from orders
)
select doc, case when own = other or others <= 3 then own else other end as key, case when own = other then 3 + others else greatest(3, others) end::bigint as weight,
    case when own = other or others <= 3 then (200001000000 + doc)::varchar end as number
from named
"""
FRAMES, SQL = {"dominant_entities": dominant_entities}, {"dominant_entities": DOMINANT_SQL}
