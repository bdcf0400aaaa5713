"""Which pages of a report carry a statement: evidence per page, and the best run of pages by dynamic programming.

A run starts on a page that looks like the statement, and goes on over pages that lean to it. Its score is that of its pages, with a
bonus for each page after the first and one for ending on the statement's last line. The fold over a report's pages keeps one
score for each length of a run that ends on the page, so it is linear in pages and its state doesn't grow.

pages: doc, page, text. A report bounds the pages that are folded together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom.functions.numbers import parse_number
from finloom.functions.words import let, says, spoken, words

#: Phrases of a statement's heading, of its lines, and of its last line.
STATEMENTS = {
    "IS": (["profit or loss", "comprehensive income", "income statement", "income statements"], ["revenue", "cost of sales", "gross profit", "profit before tax", "tax expense", "earnings per share"], ["earnings per share"]),
    "BS": (["financial position", "balance sheet", "balance sheets"], ["property plant and equipment", "inventories", "trade receivables", "total assets", "share capital", "total equity", "borrowings", "total liabilities"], ["total equity and liabilities"]),
    "CF": (["cash flows", "cash flow"], ["operating activities", "investing activities", "financing activities", "dividends paid", "cash and cash equivalents"], ["end of the year", "end of the financial year"]),
    "EQ": (["changes in equity"], ["share capital", "retained earnings", "total comprehensive income", "dividends paid", "total equity"], ["at end of the year"]),
}
#: Heads of pages that are no statement, whatever they hold.
EXCLUDED = ["contents", "notes to the", "financial highlights", "financial summary", "independent auditors"]
#: Lines that count as a page's head; figures that a page needs; pages of a run; a page's score and the bonuses.
HEAD, FIGURES, LONGEST = 4, 6, 3
PER_HIT, HEADED, GOES_ON, ENDS = 10.0, 25.0, 5.0, 15.0


def evidence(pages: DataFrame) -> DataFrame:
    """doc, page, statement, score, starts, leans, ends: what a page says for each statement. Pages of few figures say nothing."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.trim(x) != "")
    marked = pages.select("doc", "page", lines.alias("lines"), "text")
    figures = F.size(F.filter(F.split(F.trim(F.coalesce("text", F.lit(""))), r"\s+"), lambda x: F.when(x.rlike("[0-9]"), parse_number(x).isNotNull()).otherwise(False)))
    marked = marked.select("doc", "page", spoken(words(F.array_join(F.slice("lines", 1, HEAD), " "))).alias("head"), spoken(words(F.coalesce("text", F.lit("")))).alias("line"), figures.alias("figures"))

    def hits(phrases: list[str]) -> Column:
        return sum((says(F.col("line"), [p]).cast("int") for p in phrases), F.lit(0))

    each = F.array(*(F.struct(F.lit(s).alias("statement"), says(F.col("head"), heads).alias("headed"), hits(own).alias("hits"), says(F.col("line"), last).alias("ends")) for s, (heads, own, last) in STATEMENTS.items()))
    marked = marked.where(F.col("figures") >= FIGURES).select("doc", "page", "figures", says(F.col("head"), EXCLUDED).alias("excluded"), each.alias("all"))
    rows = marked.select("doc", "page", "excluded", "all", F.inline("all"))
    rivals = F.filter("all", lambda x: x["statement"] != F.col("statement"))
    rival_hits, rival_headed = F.array_max(F.transform(rivals, lambda x: x["hits"])), F.exists(rivals, lambda x: x["headed"])
    score = PER_HIT * F.col("hits") + F.when(F.col("headed"), HEADED).otherwise(0.0)
    starts = ~F.col("excluded") & F.col("headed") & (F.col("hits") > 0)
    leans = ~F.col("excluded") & (F.col("hits") > rival_hits) & ~(rival_headed & ~F.col("headed"))
    return rows.select("doc", "page", "statement", score.alias("score"), starts.alias("starts"), leans.alias("leans"), "ends")


def best_runs(said: DataFrame, longest: int = LONGEST) -> DataFrame:
    """doc, statement, first_page, last_page, score: the best run of pages; of equals the one that starts first, then the shortest."""
    ordered = F.array_sort(F.collect_list(F.struct("page", "score", "starts", "leans", "ends")))
    reports = said.groupBy("doc", "statement").agg(ordered.alias("pages"))
    none = F.lit(None).cast("double")
    state = F.struct(F.lit(None).cast("int").alias("page"), F.array(*[none] * longest).alias("runs"), none.alias("best"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))

    def step(acc: Column, p: Column) -> Column:
        follows = p["leans"] & (acc["page"] == p["page"] - 1)
        grown = [F.when(p["starts"], p["score"])] + [F.when(follows, F.get(acc["runs"], F.lit(k)) + p["score"] + GOES_ON) for k in range(longest - 1)]
        bonus = F.when(p["ends"], ENDS).otherwise(0.0)
        # Of runs that end here the longest starts first; an earlier run stays unless a later one is better.
        tried = F.array(*(F.struct((grown[k] + bonus).alias("total"), F.lit(k).alias("more")) for k in range(longest)))
        ends = F.array_max(F.filter(tried, lambda t: t["total"].isNotNull()))

        def placed(top: Column) -> Column:
            start = p["page"] - top["more"]
            return F.struct(top["total"].alias("total"), start.alias("start"), (top["total"].isNotNull() & (acc["best"].isNull() | (top["total"] > acc["best"]) | ((top["total"] == acc["best"]) & (start < acc["first"])))).alias("better"))

        def told(t: Column) -> Column:
            pick = lambda new, old: F.when(t["better"], new).otherwise(acc[old]).alias(old)
            return F.struct(p["page"].cast("int").alias("page"), F.array(*grown).alias("runs"), pick(t["total"], "best"), pick(t["start"].cast("int"), "first"), pick(p["page"].cast("int"), "last"))

        # What a step finds is worked out once, not for each of its uses.
        return let(let(ends, placed), told)

    folded = reports.select("doc", "statement", F.aggregate("pages", state, step).alias("r")).where("r.best is not null")
    return folded.select("doc", "statement", F.col("r.first").alias("first_page"), F.col("r.last").alias("last_page"), F.col("r.best").alias("score"))
