"""Notes on earnings per share: which row is what, the share count that the note's own arithmetic proves, and the statement's columns.

A note prints a profit, one or more share counts and the earnings per share, in units that it states or leaves out. Of all counts
and multipliers that the rows allow, the one counts for which profit / shares gives the printed earnings per share. Its columns
meet those of the statement by year and basis, and else by an equal figure that only one column prints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.functions.numbers import detect_scale, parse_number
from finloom.functions.words import begins, let, says, spoken, words
from finloom.operators.income_rows import NET_RESULTS, UNITS, YEARS, heads_per_share

#: Units of share counts, their plausible bounds, the largest earnings per share in sen, words of a heading.
MULTIPLIERS, LEAST_SHARES, MOST_SHARES, MOST_SEN, HEADING_WORDS = [1, 1_000, 1_000_000], 1e6, 5e11, 5_000, 15
SHARE_COUNTS = ["weighted average", *(f"number of {a}{b}{c}" for a in ("", "issued ") for b in ("", "ordinary ") for c in ("shares", "units", "stapled")), *(f"{a} in {b}" for a in ("shares", "units") for b in ("issue", "circulation"))]
EARNED, EARNERS = ["profit", "earnings", "loss", "income"], ["attributable", "owner", "owners", "shareholders", "unitholders"]
COMPONENTS = ["realis", "unrealis", "continuing", "discontinu", "adjust", "issuance", "conversion", "exercise"]
TOTALS = ["", "total", "unit", "units", "000", "sen"]
WHOLE_COMPANY, YEAR = "CONSOLIDATED", "^(19[89][0-9]|20[0-4][0-9])$"


def role(label: Column) -> Column:
    """shares, shares_diluted, patami, eps, eps_diluted, or null: what a row with this text shows."""

    def of(found: Column) -> Column:
        line = spoken(found)
        diluted = F.exists(found, lambda w: w.startswith("dilut"))
        only_diluted = diluted & ~F.array_contains(found, "basic")
        per_share = says(line, [f"per {k}{u}" for k in ("", "ordinary ", "stapled ") for u in UNITS])
        earns = F.array_min(F.transform(F.array(*map(F.lit, EARNED)), lambda w: F.nullif(F.array_position(found, w), F.lit(0))))
        after = F.slice(found, earns + 1, F.size(found))
        theirs = F.exists(after, lambda w: w.isin(EARNERS)) | says(spoken(after), ["equity holders", "holders of"])
        profit = F.coalesce(theirs, F.lit(False)) | begins(line, [f"{r} {then}" for r in NET_RESULTS for then in (*YEARS, "after tax", "after taxation")])
        return (
            F.when(says(line, SHARE_COUNTS), F.when(diluted, "shares_diluted").otherwise("shares"))
            .when(profit & ~per_share, F.when(~only_diluted, "patami"))
            .when(heads_per_share(found, ("eps", "epu"), cut=False), F.when(only_diluted, "eps_diluted").otherwise("eps"))
        )

    return let(words(label), of)


def _heads_years(cells: Column) -> Column:
    """Whether cells read as the years over columns: one, or several that follow on one another, as 2024 and 2023. 1985 twice is a figure."""
    years = F.array_distinct(F.transform(cells, lambda c: F.trim(c).try_cast("int")))
    return (F.size(cells) == 1) | ((F.size(years) > 1) & (F.array_max(years) - F.array_min(years) == F.size(years) - 1))


def roles(lines: DataFrame) -> DataFrame:
    """doc, row_no, label, context, cells, role of the rows with figures. lines: doc, row_no, label, cells.

    A row's role is that of its own label, else of its label after the two lines above it that have no figures; a total, or a bare
    unit, takes that of the block that it closes. Components of a figure have none. Rows of a note are ordered together.
    A row of years is no row of figures, unless its own label has a role and the cells can't be the years over columns.
    """
    order = Window.partitionBy("doc").orderBy("row_no")
    label = F.trim(F.coalesce("label", F.lit("")))
    held = F.filter(F.coalesce("cells", F.array().cast("array<string>")), lambda c: parse_number(c).isNotNull() | F.trim(c).isin("-", "–", "—"))
    years = F.forall("held", lambda c: F.trim(c).rlike(YEAR))
    rows = lines.select("doc", "row_no", label.alias("label"), "cells", held.alias("held")).withColumn("own", role(F.col("label")))
    rows = rows.withColumn("valued", (F.size("held") > 0) & (~years | (F.col("own").isNotNull() & ~_heads_years(F.col("held"))))).drop("held")
    heading = ~F.col("valued") & (F.col("label") != "") & ~F.col("label").endswith(".") & (F.size(F.split("label", r"\s+")) <= HEADING_WORDS)
    found = words(F.col("label"))
    component = F.exists(found, lambda w: F.exists(F.array(*map(F.lit, COMPONENTS)), lambda s: w.startswith(s))) | says(spoken(found), ["effect", "effects", "interest expense"])
    rows = rows.withColumns({"heading": heading, "component": component, "total": F.array_join(found, " ").isin(TOTALS)})
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "above": F.coalesce(F.sum(F.col("valued").cast("int")).over(before), F.lit(0)),
        "block": F.last(F.when(F.col("heading") | (F.col("valued") & ~F.col("component")), F.col("own")), ignorenulls=True).over(before),
    })
    between = Window.partitionBy("doc", "above").orderBy("row_no")
    nth = F.sum(F.col("heading").cast("int"))
    rows = rows.withColumns({"nth": nth.over(between), "headings": nth.over(Window.partitionBy("doc", "above"))})
    wrapped = F.collect_list(F.when(F.col("heading") & (F.col("nth") > F.col("headings") - 2), F.col("label"))).over(between)
    rows = rows.withColumn("context", F.concat_ws(" ", F.array_join(wrapped, " "), "label")).where("valued")
    says_own = F.coalesce("own", role(F.col("context")))
    named = F.when(F.col("component"), None).when(F.col("total") & F.col("block").isNotNull(), F.col("block")).otherwise(says_own)
    return rows.select("doc", "row_no", "label", "context", "cells", named.alias("role"))


def decimals(printed: Column) -> Column:
    return F.length(F.regexp_extract(printed, "[.]([0-9]+)", 1))


def _thousands(found: Column) -> Column:
    """A thousand of anything but money."""
    at = F.transform(found, lambda w, i: w.isin("thousand", "thousands") | ((w == "000") & ~F.coalesce(F.get(found, i - 1), F.lit("")).isin("rm", "myr")))
    return F.exists(at, lambda x: x)


def _has(found: Column, *some: str) -> Column:
    return F.exists(found, lambda w: w.isin(*some))


def share_unit(context: Column, header: Column) -> Column:
    """The multiplier that a row or, where no money is named, its column states for share counts; null where neither does."""
    found, above, bare = words(context), words(header), F.replace(F.lower(context), F.lit(" "), F.lit(""))
    units = bare.contains("(unit)") | bare.contains("(units)") | bare.contains("(no)") | bare.contains("(no.)")
    return (
        F.when(_has(found, "million", "mil", "mn") | bare.contains("(m)"), 1_000_000).when(_thousands(found), 1_000).when(units, 1)
        .when(_thousands(above) & ~_has(above, "rm", "myr"), 1_000)
    )


def money_unit(context: Column, header: Column, otherwise: Column) -> Column:
    """The multiplier of a profit by its row, then by its column, then by the statement."""
    out = otherwise
    for text in (header, context):
        scale = detect_scale(text)
        out = F.when(scale["multiplier"] > 1, scale["multiplier"]).when(_has(words(text), "rm", "myr"), 1).otherwise(out)
    return out


def _near(a: Column, b: Column, places: Column) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(5.0) / F.pow(F.lit(10.0), places + 1), F.abs(b) * 0.006) + 0.0001


def share_counts(lines: DataFrame, columns: DataFrame, face: DataFrame) -> DataFrame:
    """doc, col, year, basis, eps (sen), places, patami, shares, multiplier, printed, stated, proved: one row for each column of a note.

    columns: doc, col, year, basis, header, scale (the statement's). face: doc, year, patami, taken where the note has none.
    Columns without earnings per share or a plausible count are left out.
    """
    cells = roles(lines).where("role in ('shares', 'patami', 'eps')").select("doc", "row_no", "label", "context", "role", F.posexplode("cells").alias("col", "printed"))
    # A count times its unit is exact as a decimal only: 1.027 million.
    cells = cells.withColumn("exact", parse_number(F.col("printed"))).withColumn("value", F.col("exact").cast("double")).where("value is not null").join(columns, ["doc", "col"])
    weighted = lambda c: says(spoken(words(F.col(c))), ["weighted"]) | _has(words(F.col(c)), "weighted")
    rank = F.when(weighted("label"), 0).when(weighted("context"), 1).otherwise(2)
    bare = F.replace(F.lower("context"), F.lit(" "), F.lit(""))
    sen = F.col("value") * F.when(bare.contains("(rm)") & ~_has(words(F.col("context")), "sen", "cent", "cents"), 100).otherwise(1)
    stated = share_unit(F.col("context"), F.col("header"))
    line = F.struct(rank.alias("rank"), "row_no", "exact", "printed", stated.alias("stated"))
    small = (F.col("role") == "eps") & (F.abs("value") <= MOST_SEN)
    money = F.col("value") * money_unit(F.col("context"), F.col("header"), F.col("scale"))
    notes = cells.groupBy("doc", "col", "year", "basis").agg(
        F.min_by(F.when(small, F.struct(sen.alias("eps"), decimals(F.col("printed")).alias("places"))), F.when(small, F.col("row_no"))).alias("e"),
        F.min_by(F.when(F.col("role") == "patami", money), F.when(F.col("role") == "patami", F.col("row_no"))).alias("own"),
        F.collect_list(F.when((F.col("role") == "shares") & (F.col("value") > 0), line)).alias("lines"),
    )
    years = face.where("patami is not null").groupBy("doc", "year").agg(F.min("patami").alias("faced"))
    notes = notes.where("e is not null").join(years, ["doc", "year"], "left").withColumn("patami", F.coalesce("own", "faced"))

    def tried(x: Column) -> Column:
        units = F.when(x["stated"].isNotNull(), F.array(x["stated"])).otherwise(F.array(*map(F.lit, MULTIPLIERS)))

        def one(m: Column) -> Column:
            shares = (x["exact"] * m.cast("long")).cast("double")
            proved = F.coalesce(_near(F.col("patami") / F.nullif(shares, F.lit(0.0)) * 100, F.col("e.eps"), F.col("e.places")), F.lit(False))
            return F.struct((~proved).alias("unproved"), x["rank"].alias("rank"), x["row_no"].alias("row_no"), m.alias("multiplier"), shares.alias("shares"), x["printed"].alias("printed"), x["stated"].isNotNull().alias("stated"))

        return F.transform(units, one)

    allowed = F.filter(F.flatten(F.transform("lines", tried)), lambda t: t["shares"].between(LEAST_SHARES, MOST_SHARES))
    notes = notes.withColumn("best", F.array_min(allowed)).where("best is not null")
    return notes.select("doc", "col", "year", "basis", "e.eps", "e.places", "patami", "best.shares", "best.multiplier", "best.printed", "best.stated", (~F.col("best.unproved")).alias("proved"))


def aligned(notes: DataFrame, face: DataFrame) -> DataFrame:
    """doc, col (the statement's), note_col, shares, multiplier, printed, confidence, note_eps, face_eps.

    face: doc, col, year, basis, eps (sen or null), places. Equal years and bases meet first, in order of columns; a column left over
    meets the one column left over whose figure is equal to the coarser printed precision, if there is just one. Confidence: 1.0 if
    the figure is equal and the arithmetic proves it, 0.8 for one of the two, 0.5 for none.
    """
    order = Window.partitionBy("doc", "year", "its").orderBy("col")
    its = F.coalesce("basis", F.lit(WHOLE_COMPANY))
    ours = notes.withColumn("its", its).withColumn("nth", F.row_number().over(order)).withColumnRenamed("col", "note_col")
    theirs = face.select("doc", "col", "year", "basis", F.col("eps").alias("face_eps"), F.col("places").alias("face_places")).withColumn("its", its).withColumn("nth", F.row_number().over(order)).drop("basis")
    equal = F.abs(F.col("eps") - F.col("face_eps")) <= F.lit(5.0) / F.pow(F.lit(10.0), F.least("places", "face_places") + 1) + 0.0001
    ours, theirs = ours.select("doc", "note_col", "year", "its", "nth", "eps", "places", "shares", "multiplier", "printed", "proved"), theirs
    # Both sides are few columns a document: one join by document gives all candidates, and windows settle who meets whom.
    pairs = ours.join(theirs.select("doc", "col", F.col("year").alias("y"), F.col("its").alias("i"), F.col("nth").alias("n"), "face_eps", "face_places"), "doc")
    keyed = F.coalesce((F.col("year") == F.col("y")) & (F.col("its") == F.col("i")) & (F.col("nth") == F.col("n")), F.lit(False))
    pairs = pairs.withColumns({"keyed": keyed, "equal": F.coalesce(equal, F.lit(False))})
    note, column = Window.partitionBy("doc", "note_col"), Window.partitionBy("doc", "col")
    pairs = pairs.withColumns({"note_met": F.max("keyed").over(note), "col_met": F.max("keyed").over(column)})
    free = F.col("equal") & ~F.col("note_met") & ~F.col("col_met")
    pairs = pairs.withColumn("choices", F.sum(free.cast("int")).over(note))
    alone = free & (F.col("choices") == 1)
    pairs = pairs.withColumn("alone", alone & (F.col("note_col") == F.min(F.when(alone, F.col("note_col"))).over(column)))
    confidence = F.when(F.col("equal") & F.col("proved"), 1.0).when(F.col("equal") | F.col("proved"), 0.8).otherwise(0.5)
    return pairs.where("keyed or alone").select("doc", "col", "note_col", "shares", "multiplier", "printed", confidence.alias("confidence"), F.col("eps").alias("note_eps"), "face_eps")
