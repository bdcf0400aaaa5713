"""Rows of a statement to concepts, where a label's meaning hangs on the rows before it.

A label alone says too little: "Owners of the Company" stands under the profit and again under comprehensive income, "Taxation" below
the profit is another tax, and "Basic" means something under a heading of earnings per share only. The automaton over the rows of a
statement is written as regular expressions over one letter a row: a pattern's matches are the blocks, found from left to right in
linear time. What a row needs beyond its block comes from windows over its statement.

lines: doc, statement, row_no, label, concept (what the label alone maps to, or null), cells (array of printed cells, null where blank).
The rows of one statement are held together; documents are spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.functions.numbers import parse_number
from finloom.functions.words import begins, says, spoken, words

PAT, TCI, CONTINUING = "is.profit_for_period", "is.total_comprehensive_income", "is.profit_continuing"
BASIC, DILUTED = "is.eps_basic", "is.eps_diluted"
#: Holders by letter, and what their shares are under comprehensive income (no concept takes the last).
HOLDERS = {"is.pat_owners": "O", "is.pat_nci": "N", "is.pat_perpetual_bond": "P"}
UNDER_TCI = {"is.pat_owners": "is.tci_owners", "is.pat_nci": "is.tci_nci"}
#: Concepts that end above the profit; below it such a label belongs to other comprehensive income.
ABOVE_PROFIT = ["is.tax_expense", "is.profit_before_tax", "is.operating_profit", "is.gross_profit", "is.revenue", "is.cost_of_sales"]
PROFIT_SECTION = [PAT, TCI, *HOLDERS, *UNDER_TCI.values()]

#: Words of headings and rows of earnings per share.
EARNINGS, UNITS, KINDS_OF_SHARE = ["earnings", "loss", "losses", "profit", "profits"], ["share", "shares", "unit", "units", "security", "securitys"], ["ordinary", "stapled"]
TAILS = ["sen", "cent", "cents", "share", "shares", "unit", "units", "company", "parent", "bank", "group", "owner", "owners", "holder", "holders", "unitholders", "shareholders", "attributable", "rm"]
FOREIGN = ["total", "comprehensive", "income", "revenue", "tax", "taxation", "expense", "expenses", "weighted", "number of", "dividend", "dividends"]
NOT_TOTAL_STEMS, NOT_TOTAL = ["realis", "unrealis", "distribut", "dividend", "normalis", "normaliz"], ["before", "adjusted", "core", "net assets"]
YEARS = ["for the year", "for the period", "for the financial year", "for the financial period"]
RESULTS = [*("profit loss".split()), "profit loss", "loss profit", "profit profit", "loss loss"]
NET_RESULTS = [*RESULTS, *(f"net {x}" for x in RESULTS)]

#: Letters of rows from the profit on. Without figures: a heading of earnings per share (b where it holds a foreign word), c another
#: line, d another one with a foreign word. With figures: w heading, s basic or diluted, t both, u the tail of a wrapped heading, x others.
#: A block is a heading of up to four lines with the figures under it, or a heading with figures of its own.
EPS_BLOCK = "[ab][ac]{0,3}(?:[stu][st]*)?|[wt][st]*"
#: A run of holders in which none comes twice.
HOLDER_BLOCK = "O(?:NP?|PN?)?|N(?:OP?|PO?)?|P(?:ON?|NO?)?"
MARK = "struct<block: int, nth: int, opens: string>"


def _marks(events: Column, pattern: str) -> Column:
    """For each letter its block's number, place in it and first letter; letters outside of matches are blocks of their own."""
    tokens = F.regexp_extract_all(events, F.lit(f"(?:{pattern})|."), F.lit(0))
    each = F.transform(tokens, lambda t, i: F.transform(F.sequence(F.lit(1), F.length(t)), lambda k: F.struct(i.alias("block"), k.alias("nth"), F.left(t, F.lit(1)).alias("opens"))))
    return F.coalesce(F.flatten(each), F.array().cast(f"array<{MARK}>"))


def heads_per_share(found: Column, names: tuple[str, ...] = ("eps",), cut: bool = True) -> Column:
    """Whether words speak of earnings per share or unit; cut: also where a line ends before the unit."""
    at = lambda k: F.coalesce(F.get(found, k), F.lit(""))

    def here(word: Column, i: Column) -> Column:
        named = at(i + 1).isin(UNITS) | (at(i + 1).isin(KINDS_OF_SHARE) & at(i + 2).isin(UNITS))
        ends = (i == F.size(found) - 1) & at(i - 1).isin("earnings", "loss") & F.lit(cut)
        return (word == "per") & (i > 0) & at(i - 1).isin(EARNINGS) & (named | ends)

    return F.exists(found, lambda w: w.isin(*names)) | F.exists(F.transform(found, here), lambda x: x)


def _read(lines: DataFrame) -> DataFrame:
    """Lines with what their own label and cells say."""
    text = F.replace(F.replace(F.coalesce("label", F.lit("")), F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl"))
    rows = lines.where(F.trim(F.coalesce("label", F.lit(""))) != "").select("doc", "statement", "row_no", "label", "concept", "cells", text.alias("text"), words(text).alias("found"))
    rows = rows.withColumns({"line": spoken(F.col("found")), "read": F.transform("cells", lambda c: F.struct(F.trim(c).alias("printed"), parse_number(c).alias("value")))})
    held = F.filter("read", lambda x: x["value"].isNotNull() | x["printed"].isin("-", "–", "—"))
    rows = rows.withColumns({"figures": F.col("read.value"), "held": F.coalesce(F.transform(held, lambda x: x["printed"]), F.array().cast("array<string>"))})
    note_only = (F.size("held") == 1) & F.get("held", F.lit(0)).rlike("^[0-9]{1,2}([.][0-9]{1,2})?$")
    first = F.get("found", F.lit(0))
    kind = lambda k: F.coalesce(F.get("found", F.lit(k)).isin("basic", "diluted"), F.lit(False))
    line = F.col("line")
    foreign = says(line, FOREIGN)
    numbered = (F.length(first) <= 2) & first.rlike("^[a-z]+$") & F.col("text").rlike(r"^[^A-Za-z]*[A-Za-z]{1,2}\)")
    rows = rows.withColumns({
        "valued": F.size("held") > 0, "eps_valued": (F.size("held") > 0) & ~note_only, "heads": heads_per_share(F.col("found")),
        "sub": kind(0) | (F.coalesce(numbered, F.lit(False)) & kind(1)), "foreign": foreign,
        "tail": (says(line, TAILS) & ~foreign) | line.isin([f" {r} {y} " for r in RESULTS for y in YEARS]),
        "opens_profit": begins(line, [f"{r} {then}" for r in NET_RESULTS for then in (*YEARS, "attributable to", "after tax", "after taxation")]),
        "tci_tail": begins(line, ["comprehensive income for the", "total comprehensive income for the", *YEARS]),
        "part": begins(line, [f"{a}{b} {c}" for a in ("", "from ") for b in ("continuing", "discontinued", "discontinuing") for c in ("operation", "operations")]),
    })
    heads, sub = F.col("heads"), F.col("sub")
    letter = F.when(
        ~F.col("eps_valued"), F.when(heads, F.when(F.col("foreign"), "b").otherwise("a")).otherwise(F.when(F.col("foreign"), "d").otherwise("c"))
    ).otherwise(F.when(heads & sub, "t").when(heads, "w").when(sub, "s").when(F.col("tail"), "u").otherwise("x"))
    return rows.withColumn("letter", letter)


READ = ["row_no", "label", "text", "concept", "cells", "figures", "valued", "eps_valued", "sub", "opens_profit", "tci_tail", "part", "letter"]


def _per_share_blocks(rows: DataFrame) -> DataFrame:
    """Rows with the block of earnings per share that they are in. Blocks start below the first sign of the profit only."""
    profit = F.min(F.when((F.col("statement") == "IS") & ((~F.col("valued") & F.col("opens_profit")) | (F.col("valued") & F.col("concept").isin(PROFIT_SECTION))), F.col("row_no")))
    whole = rows.groupBy("doc", "statement").agg(F.array_sort(F.collect_list(F.struct(*READ))).alias("rows"), profit.alias("profit"))
    events = F.array_join(F.transform("rows", lambda r: F.when(r["row_no"] > F.col("profit"), r["letter"]).otherwise("x")), "")
    flat = whole.withColumn("marks", _marks(events, EPS_BLOCK)).select("doc", "statement", F.explode(F.arrays_zip("rows", "marks")).alias("z"))
    return flat.select("doc", "statement", "z.rows.*", "z.marks.block", "z.marks.nth", F.col("z.marks.opens").isin(list("abwt")).alias("per_share"))


def _stem(text: Column, stem: str) -> Column:
    return F.lower(text).contains(stem)


def _earnings(rows: DataFrame) -> DataFrame:
    """Rows with the concepts of earnings per share that they carry: total ones before those of continuing operations, then the first."""
    block, own = Window.partitionBy("doc", "statement", "block").orderBy("row_no"), F.col("text")
    heading = F.col("per_share") & (~F.col("eps_valued") | (F.col("nth") == 1))
    rows = rows.withColumn("heading", F.array_join(F.collect_list(F.when(heading, own)).over(block), " "))
    rows = rows.withColumn("both", F.when(F.col("per_share"), words(F.concat_ws(" ", "heading", "text"))))
    line = spoken(F.col("both"))
    continuing = lambda c: F.lower(c).rlike(r"\bcontinuing\b")
    other = F.exists("both", lambda w: F.exists(F.array(*map(F.lit, NOT_TOTAL_STEMS)), lambda s: w.startswith(s))) | says(line, NOT_TOTAL)
    other = other | _stem(own, "discontinu") | (_stem(F.col("heading"), "discontinu") & ~continuing(F.col("heading"))) | (continuing(own) & ~F.col("sub"))
    source = F.when(_stem(own, "basic") | _stem(own, "dilut"), own).otherwise(F.col("heading"))
    counts = F.col("per_share") & F.col("eps_valued") & ~other
    diluted = counts & _stem(source, "dilut")
    basic = counts & (_stem(source, "basic") | ~_stem(source, "dilut"))
    in_ringgit = F.col("per_share") & F.replace(F.lower(F.concat_ws(" ", "heading", "text")), F.lit(" "), F.lit("")).contains("(rm)") & ~says(line, ["sen", "cent", "cents"])
    place, whole = F.struct(says(line, ["continuing"]).alias("later"), "row_no"), Window.partitionBy("doc", "statement")
    rows = rows.withColumns({"basic": basic, "diluted": diluted, "place": place, "figures": F.when(in_ringgit, F.transform("figures", lambda x: (x * 100).cast("decimal(24,4)"))).otherwise(F.col("figures"))})
    first = lambda c: F.col(c) & (F.col("place") == F.min(F.when(F.col(c), F.col("place"))).over(whole))
    keys = F.array_compact(F.array(F.when(first("basic"), F.lit(BASIC)), F.when(first("diluted"), F.lit(DILUTED))))
    return rows.withColumn("keys", keys).drop("both", "heading", "place", "basic", "diluted", "block", "nth")


def _parts_summed(rows: DataFrame) -> DataFrame:
    """A holder's line without figures takes the sums of the lines of continuing and discontinued operations under it."""
    whole, ordered = Window.partitionBy("doc", "statement"), Window.partitionBy("doc", "statement").orderBy("row_no")
    plain = ~F.col("per_share")
    rows = rows.withColumn("profit_row", F.min(F.when(plain & F.col("valued") & (F.col("concept") == PAT), F.col("row_no"))).over(whole))
    rows = rows.withColumn("below", F.coalesce(F.col("row_no") > F.col("profit_row"), F.lit(False)))
    holder = plain & ~F.col("part") & F.coalesce(F.col("concept").isin(list(HOLDERS)), F.lit(False))
    rows = rows.withColumns({"holder": holder & (F.col("valued") | F.col("below")), "waits": holder & ~F.col("valued") & F.col("below")})
    said = F.when(F.col("waits"), F.struct(F.lit(True).alias("waits"), "row_no")).when(F.col("per_share") | (F.col("valued") & ~F.col("part")), F.struct(F.lit(False).alias("waits"), "row_no"))
    rows = rows.withColumn("last", F.last(said, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("absorbed", plain & F.col("part") & F.coalesce(F.col("last.waits"), F.lit(False)))
    rows = rows.withColumn("joins", F.when(F.col("absorbed"), F.col("last.row_no")).otherwise(F.col("row_no")))
    parts = F.collect_list(F.when(F.col("absorbed"), F.struct("figures"))).over(Window.partitionBy("doc", "statement", "joins"))
    rows = rows.withColumn("parts", parts)
    wide = F.array_max(F.transform("parts", lambda p: F.size(p["figures"])))

    def added(k: Column) -> Column:
        column = F.filter(F.transform("parts", lambda p: F.get(p["figures"], k)), lambda x: x.isNotNull())
        return F.when(F.size(column) > 0, F.aggregate(column, F.lit(0).cast("decimal(24,4)"), lambda a, x: (a + x).cast("decimal(24,4)")))

    sums = F.when(wide > 0, F.transform(F.sequence(F.lit(0), wide - 1), added))
    rows = rows.withColumn("figures", F.when(F.col("waits"), sums).otherwise(F.col("figures")))
    rows = rows.withColumn("stays", F.when(F.col("waits"), F.exists("figures", lambda x: x.isNotNull())).otherwise(F.when(F.col("per_share"), F.col("eps_valued")).otherwise(F.col("valued")) & ~F.col("absorbed")))
    return rows.drop("last", "joins", "parts", "absorbed", "waits")


KEPT = ["row_no", "label", "concept", "cells", "figures", "keys", "per_share", "valued", "holder", "below", "tci_tail", "stays"]


def _sections(rows: DataFrame) -> DataFrame:
    """The concepts of rows outside of earnings per share: the nth block of holders belongs to the nth subtotal stated so far."""
    concept = F.when(F.col("below") & F.col("concept").isin(ABOVE_PROFIT), None).otherwise(F.col("concept"))
    rows = rows.withColumn("concept", concept)
    tail = F.col("below") & F.col("valued") & ~F.col("per_share") & F.col("concept").isNull() & F.col("tci_tail")
    rows = rows.withColumn("concept", F.when(tail, F.lit(TCI)).otherwise(F.col("concept")))
    whole = rows.groupBy("doc", "statement").agg(F.array_sort(F.collect_list(F.struct(*KEPT))).alias("rows"), F.first("profit_row").alias("profit_row"))
    states = lambda r: ~r["per_share"] & r["valued"] & F.coalesce((r["concept"] == TCI) | (r["row_no"] == F.col("profit_row")), F.lit(False))
    whole = whole.withColumns({"anchors": F.filter("rows", states), "holders": F.filter("rows", lambda r: r["holder"])})
    letters = F.create_map(*(F.lit(x) for item in HOLDERS.items() for x in item))
    events = F.array_join(F.transform("holders", lambda r: F.element_at(letters, r["concept"])), "")
    whole = whole.withColumns({
        "blocks": F.map_from_arrays(F.transform("holders", lambda r: r["row_no"]), F.transform(_marks(events, HOLDER_BLOCK), lambda m: m["block"])),
        "tci_row": F.array_min(F.transform(F.filter("anchors", lambda a: a["concept"] == TCI), lambda a: a["row_no"])),
        "profit": F.get(F.filter("rows", lambda r: r["row_no"] == F.col("profit_row")), F.lit(0))["figures"],
    })
    # A further profit is per share or repeats the first one; else the first one was that of continuing operations.
    again = lambda r: ~r["per_share"] & r["valued"] & (r["concept"] == PAT) & (r["row_no"] > F.col("profit_row"))
    repeats = lambda r: F.coalesce(F.col("tci_row") < r["row_no"], F.lit(False)) | r["figures"].eqNullSafe(F.col("profit"))
    whole = whole.withColumn("continuing", F.exists("rows", lambda r: F.coalesce(again(r) & ~repeats(r), F.lit(False))))
    flat = whole.select("doc", "statement", "blocks", "anchors", "tci_row", "profit", "profit_row", "continuing", F.explode("rows").alias("r"))
    r = F.col("r")
    anchor = F.get("anchors", F.element_at("blocks", r["row_no"]))
    under_tci = F.coalesce((anchor["concept"] == TCI) & (anchor["row_no"] < r["row_no"]), F.lit(False))
    shares = F.create_map(*(F.lit(x) for item in UNDER_TCI.items() for x in item))
    concept = (
        F.when(r["per_share"], F.lit(None).cast("string"))
        .when(r["holder"] & under_tci, F.element_at(shares, r["concept"]))
        .when(F.coalesce((r["row_no"] == F.col("profit_row")) & F.col("continuing"), F.lit(False)), F.lit(CONTINUING))
        .when(F.coalesce(again(r) & repeats(r), F.lit(False)), F.lit(None).cast("string"))
        .otherwise(r["concept"])
    )
    return flat.where(r["stays"]).select("doc", "statement", r["row_no"].alias("row_no"), r["label"].alias("label"), concept.alias("concept"), r["keys"].alias("keys"), r["figures"].alias("figures"), r["cells"].alias("cells"))


def mapped(lines: DataFrame) -> DataFrame:
    """doc, statement, row_no, label, concept (null: kept without one), figures (a decimal a cell; per-share ones in sen), cells.

    A row that gives basic and diluted earnings at once is returned for each. Rows without a label or figures are left out.
    """
    rows = _sections(_parts_summed(_earnings(_per_share_blocks(_read(lines)))))
    rows = rows.withColumn("key", F.explode_outer("keys"))
    return rows.select("doc", "statement", "row_no", "label", F.coalesce("key", "concept").alias("concept"), "figures", "cells")
