"""From the words of a page to blocks, rows and cells: halves of spreads, gutters between panels, columns by right edges.

Words are (doc, page, word_id, text, x0, x1, y0, y1). All steps are windows and groups by page, which bounds them; no step holds the
pages of a document together, but for the width of its narrowest page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.functions.numbers import parse_number
from finloom.operators.layout import with_rows

#: Points: a gap that may be a gutter, and by how much edges of one column or gutter may differ.
GUTTER, TOLERANCE = 20.0, 9.0
#: Rows that a gutter, a panel or a column needs; part of a panel's rows with labels; part of the rows that may cross a gutter.
SUPPORT, LABELLED, CROSSING = 3, 0.5, 0.2
#: A page so many times as wide as the document's narrowest is a spread of two.
SPREAD = 1.8
PAGE = ["doc", "page", "half"]


def halves(words: DataFrame, pages: DataFrame) -> DataFrame:
    """words with half: 1 and 2 of a spread by the middle of the word, 0 on other pages. pages: doc, page, width."""
    narrow = pages.groupBy("doc").agg(F.min("width").alias("narrow"))
    wide = pages.join(narrow, "doc").where(F.col("width") >= SPREAD * F.col("narrow")).select("doc", "page", (F.col("width") / 2).alias("middle"))
    side = F.when(F.col("middle").isNull(), 0).when((F.col("x0") + F.col("x1")) / 2 < F.col("middle"), 1).otherwise(2)
    return words.join(wide, ["doc", "page"], "left").withColumn("half", side).drop("middle")


def _is_label(text: Column) -> Column:
    """A run of three letters in a word that is no figure."""
    return parse_number(text).isNull() & text.rlike("[A-Za-z]{3}")


def gutters(words: DataFrame) -> DataFrame:
    """doc, page, half, low, high: the gap between two panels of a page, for pages that have one.

    words: with half and row_no. Gaps of rows are clustered by where they start; of the clusters that hold up, that of the most rows
    counts, then the widest. A panel needs rows with labels of its own on either side; a column of figures has none.
    """
    in_row = Window.partitionBy(*PAGE, "row_no").orderBy("x0", "word_id")
    gap = words.withColumn("low", F.lag("x1").over(in_row)).where(F.col("x0") - F.col("low") >= GUTTER).select(*PAGE, "row_no", "low", F.col("x0").alias("high"))
    order = Window.partitionBy(*PAGE).orderBy("low", "high")
    opens = F.coalesce((F.col("low") - F.lag("low").over(order) > TOLERANCE).cast("int"), F.lit(0))
    clustered = gap.withColumn("opens", opens).withColumn("cluster", F.sum("opens").over(order))
    spans = clustered.groupBy(*PAGE, "cluster").agg(F.count("*").alias("rows"), F.min(F.col("high") - F.col("low")).alias("width"), F.max("low").alias("low"), F.min("high").alias("high"))
    spans = spans.where((F.col("rows") >= SUPPORT) & (F.col("high") > F.col("low")))
    # A page has a handful of clusters, so each of its words meets those only.
    met = words.join(spans, PAGE)
    side = F.when(F.col("x1") <= F.col("low"), "left").when(F.col("x0") >= F.col("high"), "right")
    met = met.withColumns({"side": side, "crosses": (F.col("x0") < F.col("high")) & (F.col("x1") > F.col("low"))})
    keys = [*PAGE, "cluster"]
    share = met.groupBy(*keys).agg(F.countDistinct(F.when(F.col("crosses"), F.col("row_no"))).alias("crossed"), F.countDistinct("row_no").alias("all_rows"))
    # Each side's rows are swept apart, as those of two panels need not stand level.
    swept = with_rows(met.where("side is not null").drop("row_no"), [*keys, "side"])
    labelled = swept.groupBy(*keys, "side", "row_no").agg(F.max(_is_label(F.col("text"))).alias("labelled"))
    panels = labelled.groupBy(*keys, "side").agg(F.count("*").alias("n"), F.avg(F.col("labelled").cast("int")).alias("part"))
    sound = panels.where((F.col("n") >= SUPPORT) & (F.col("part") >= LABELLED)).groupBy(*keys).agg(F.count("*").alias("sides")).where("sides = 2")
    good = spans.join(share, keys).join(sound, keys).where((F.col("crossed") <= CROSSING * F.col("all_rows")) & (F.col("all_rows") >= 2 * SUPPORT))
    best = F.max_by(F.struct("low", "high"), F.struct("rows", "width", -F.col("cluster")))
    return good.groupBy(*PAGE).agg(best.alias("g")).select(*PAGE, "g.*")


def blocks(words: DataFrame, pages: DataFrame) -> DataFrame:
    """words with half, block (0 what runs across or a page without gutter, 1 left, 2 right) and row_no within the block.

    A row is split only where it has a gap of its own over the gutter; a title that runs across stays whole.
    """
    halved = halves(words, pages)
    naive = with_rows(halved, PAGE)
    marked = naive.join(gutters(naive), PAGE, "left")
    in_row = Window.partitionBy(*PAGE, "row_no").orderBy("x0", "word_id")
    before = F.lag("x1").over(in_row)
    left = (F.col("x1") <= F.col("low")) | ((F.col("x0") < F.col("high")) & (F.col("x0") + F.col("x1") <= F.col("low") + F.col("high")))
    marked = marked.withColumn("gapped", F.coalesce((F.col("x0") - before >= GUTTER) & (before < F.col("high")) & (F.col("x0") > F.col("low")), F.lit(False)))
    split = F.max("gapped").over(Window.partitionBy(*PAGE, "row_no"))
    placed = marked.withColumn("block", F.when(split, F.when(left, 1).otherwise(2)).otherwise(0)).drop("low", "high", "gapped", "row_no")
    return with_rows(placed, [*PAGE, "block"])


def cells(placed: DataFrame, is_figure: Column) -> DataFrame:
    """A row per printed row: doc, page, half, block, row_no, label, cells (array of col and text, from left to right).

    placed: blocks() with a condition for words that are figures. Columns are clusters of the right edges of figures that enough
    words share; what stands in no column is part of the label.
    """
    block = [*PAGE, "block"]
    order = Window.partitionBy(*block, "figure").orderBy("x1", "word_id")
    marked = placed.withColumn("figure", F.coalesce(is_figure, F.lit(False)))
    marked = marked.withColumn("opens", F.coalesce((F.col("x1") - F.lag("x1").over(order) > TOLERANCE).cast("int"), F.lit(0)))
    marked = marked.withColumn("band", F.when(F.col("figure"), F.sum("opens").over(order)))
    marked = marked.withColumn("support", F.count("*").over(Window.partitionBy(*block, "band")))
    col = F.when(F.col("figure") & (F.col("support") >= SUPPORT), F.col("band"))
    grouped = marked.withColumn("col", col).groupBy(*block, "row_no").agg(
        F.array_sort(F.collect_list(F.when(F.col("col").isNull(), F.struct("x0", "word_id", "text")))).alias("said"),
        F.array_sort(F.collect_list(F.when(F.col("col").isNotNull(), F.struct("col", "x0", "text")))).alias("figures"),
    )
    joined = F.array_join(F.transform("said", lambda w: w["text"]), " ")
    return grouped.select(*block, "row_no", joined.alias("label"), F.transform("figures", lambda w: F.struct(w["col"].alias("col"), w["text"].alias("text"))).alias("cells"))
