"""Five-year summaries: from the rows of a page to figures by concept and year.

A row of four to six consecutive years heads the columns below it, until another such row. A label that is wrapped over two rows
belongs to the row with the figures. Each row has a unit of its own: money takes the page's scale unless its label names one, figures
per share are in sen or ringgit. Of several figures of one concept and year the first counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.functions.numbers import detect_scale, mentions_per_share, parse_number
from finloom.functions.words import let, says, spoken, words
from finloom.operators.page_tables import PAGE

#: How summaries word the lines that they are compared on.
SUMMARY_LABELS = {
    "is.revenue": ["revenue", "turnover", "group revenue", "total revenue", "operating revenue", "sales"],
    "is.profit_before_tax": ["profit before tax", "profit before taxation", "pbt", "pre-tax profit", "profit before income tax"],
    "is.profit_for_period": ["profit after tax", "profit after taxation", "pat", "net profit after tax", "profit for the year", "profit for the financial year", "net profit for the year"],
    "is.pat_owners": ["patami", "net earnings", "profit attributable to owners", "profit attributable to owners of the company", "profit attributable to owners of the parent", "profit attributable to shareholders", "profit attributable to equity holders"],
    "bs.total_assets": ["total assets", "total assets employed"],
    "bs.total_liabilities": ["total liabilities"],
    "bs.total_equity": ["total equity"],
    "bs.equity_owners": ["shareholders equity", "shareholders funds", "equity attributable to owners of the company"],
}
#: Concepts per share, by phrases of their label, and the unit in which they are held.
PER_SHARE = [("is.eps_basic", ["earnings per share", "eps"], "sen"), ("bs.nta_per_share", ["assets per share", "nta per share"], "RM"), ("x.dividend_per_share", ["dividend per share", "dividends per share"], "sen")]
YEARS, LEAST, MOST = (1980, 2049), 4, 6


def year_of(text: Column) -> Column:
    """The year that a column's heading names ('2021', 'FY2021', '2021*', '31.3.2025', '2025/26'), or null."""
    bare = F.regexp_replace(F.lower(text), r"[*()#]|restated", "")
    digits = F.regexp_replace(F.trim(bare), r"^fye? *", "")
    year = F.when(digits.rlike(r"^[0-9]{4}$"), digits).when(digits.rlike(r"^[0-9]{4}/[0-9]{2}$"), (F.substring(digits, 1, 4).try_cast("int") + 1).cast("string")).when(digits.rlike(r"^[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}$"), F.substring(digits, -4, 4))
    number = year.try_cast("int")
    return F.when(number.between(*YEARS), number)


def is_figure(text: Column) -> Column:
    """Whether a word stands in a column of a summary: a number, a dash, or a year's heading."""
    return parse_number(text).isNotNull() | F.trim(text).isin("-", "–", "—") | year_of(text).isNotNull()


def concept_of(label: Column) -> Column:
    """The concept that a summary's label names, or null; units in brackets don't count."""
    said = F.regexp_replace(label, r"\([^)]*\)", " ")

    def read(line: Column) -> Column:
        out = F.lit(None).cast("string")
        for concept, labels in reversed(SUMMARY_LABELS.items()):
            out = F.when(line.isin([" " + " ".join(x.replace("-", " ").split()) + " " for x in labels]), concept).otherwise(out)
        for concept, phrases, _ in reversed(PER_SHARE):
            out = F.when(says(line, phrases), concept).otherwise(out)
        return out

    return let(spoken(words(F.coalesce(said, F.lit("")))), read)


def _heading(cells: Column) -> Column:
    """Column to year, where all cells of a row are consecutive years; else null."""
    years = F.transform(cells, lambda c: F.struct(c["col"].alias("col"), year_of(c["text"]).alias("year")))
    consecutive = lambda ys: (F.size(ys) == F.size(F.array_distinct(ys))) & (F.array_max(ys) - F.array_min(ys) == F.size(ys) - 1)
    fits = lambda found: F.size(found).between(LEAST, MOST) & F.forall(found, lambda y: y["year"].isNotNull()) & consecutive(F.transform(found, lambda y: y["year"]))
    return let(years, lambda found: F.when(fits(found), F.map_from_arrays(F.transform(found, lambda y: y["col"]), F.transform(found, lambda y: y["year"]))))


def summary_values(rows: DataFrame) -> DataFrame:
    """doc, concept, fiscal_year, value (in ringgit, or the concept's unit per share), printed, page, row_no.

    rows: page_tables.cells() with is_figure() as the condition for figures.
    """
    block = Window.partitionBy(*PAGE, "block").orderBy("row_no")
    page = Window.partitionBy(*PAGE)
    # Captions above a table may stand in the page's shared block.
    captions = F.when(F.size("cells") == 0, F.col("label"))
    marked = rows.withColumns({"heading": _heading(F.col("cells")), "caption": F.array_join(F.collect_list(captions).over(page), " ")})
    marked = marked.withColumn("years", F.last("heading", ignorenulls=True).over(block))
    wrapped = F.when((F.lag(F.size("cells")).over(block) == 0) & F.lag("years").over(block).isNotNull(), F.lag("label").over(block))
    own, both = concept_of(F.col("label")), concept_of(F.concat_ws(" ", "wrapped", "label"))
    data = marked.withColumn("wrapped", wrapped).where("heading is null and years is not null and size(cells) > 0").withColumn("full", F.concat_ws(" ", "wrapped", "label"))
    data = data.withColumns({"own": own, "both": both}).withColumn("concept", F.coalesce("own", "both")).where("concept is not null")
    each = data.select("doc", *PAGE[1:], "block", "row_no", "concept", F.when(F.col("own").isNull(), F.col("full")).otherwise(F.col("label")).alias("label"), "caption", "years", F.inline("cells"))
    each = each.withColumns({"fiscal_year": F.element_at("years", F.col("col")), "figure": parse_number(F.col("text")).cast("double")}).where("fiscal_year is not null and figure is not null")
    shares = {concept: unit for concept, _, unit in PER_SHARE}
    line = spoken(words(F.col("label")))
    wanted = F.when(F.col("concept").isin([c for c, unit in shares.items() if unit == "sen"]), "sen").when(F.col("concept").isin(list(shares)), "RM")
    named = F.when(says(line, ["sen", "cent", "cents"]), "sen").when(says(line, ["rm", "ringgit"]), "RM").otherwise(wanted)
    factor = F.when((named == "RM") & (wanted == "sen"), 100.0).when((named == "sen") & (wanted == "RM"), 0.01).otherwise(1.0)
    own_scale, page_scale = detect_scale(F.col("label")), detect_scale(F.col("caption"))
    money = F.when(own_scale["token"].isNotNull(), own_scale["multiplier"]).otherwise(page_scale["multiplier"])
    per_share = F.col("concept").isin(list(shares)) | mentions_per_share(F.col("label"))
    each = each.withColumn("value", F.col("figure") * F.when(per_share, factor).otherwise(money))
    first = F.min_by(F.struct("value", F.col("text").alias("printed"), "page", "row_no"), F.struct("page", "half", "block", "row_no", "col"))
    return each.groupBy("doc", "concept", "fiscal_year").agg(first.alias("f")).select("doc", "concept", "fiscal_year", "f.*")
