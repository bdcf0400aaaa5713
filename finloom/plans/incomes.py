"""Printed income statements with their notes on earnings per share, over the supplied tables: one for each company and year.

A statement prints its own year and the one before. Of eight kinds, by company and year, half state both subtotals before their
holders; others print earnings per share in ringgit or over two lines, a profit of continuing operations first, parts of the
owners' share, or a subtotal whose label is cut. Of six kinds of notes, one has no unit, one components in millions, one another
figure than the statement, one no profit, and one no years over its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.operators.income_rows import BASIC, CONTINUING, DILUTED, PAT, TCI
from finloom.plans.book import WITH_BOOK, _views
from finloom.plans.matrices import _printed, _thousands

OWN, NCI, TCI_OWN, TCI_NCI = "is.pat_owners", "is.pat_nci", "is.tci_owners", "is.tci_nci"
#: rev, pbt, pat, nci and oci in thousands, eps in hundredths of a sen; _p: of the year before. v, w: kinds of the statement and note.
INCOMES = f"""measured as (
    select company_id, fy, shares, {_thousands("revenue")} as rev, {_thousands("pbt")} as pbt, {_thousands("pat")} as pat, {_thousands("coalesce(nci_pat, 0)")} as nci, {_thousands("revenue / 100e0")} as oci from parts
), sen as (
    select *, cast(floor((pat - nci) * 1e7 / shares + 0.5) as bigint) as eps from measured
), paired as (
    select *, {", ".join(f"lag({x}) over (partition by company_id order by fy) as {x}_p" for x in ("fy", "rev", "pbt", "pat", "nci", "oci", "eps"))} from sen
), incomes as (
    select *, company_id * 10000 + fy as doc, (company_id * 5 + fy) % 8 as v, (company_id + fy) % 6 as w from paired where fy_p = fy - 1
)"""
#: Number, label, concept by the label alone, concepts in the statement (none: left out), figure (null: none printed), unit, kinds.
#: Units: m money, e hundredths of a sen, r the same in ringgit.
ROWS = [
    (10, "Revenue", "is.revenue", ["is.revenue"], "rev{}", "m", "true"),
    (20, "Profit before taxation", "is.profit_before_tax", ["is.profit_before_tax"], "pbt{}", "m", "true"),
    (30, "Taxation", "is.tax_expense", ["is.tax_expense"], "(pat{} - pbt{})", "m", "true"),
    (40, "Profit for the year from continuing operations", PAT, [CONTINUING], "(pat{} - 3)", "m", "v = 4"),
    (41, "Profit from discontinued operation", None, [None], "3", "m", "v = 4"),
    (50, "Profit for the financial year", PAT, [PAT], "pat{}", "m", "true"),
    (60, "Taxation", "is.tax_expense", [None], "2", "m", "true"),
    (70, "Owners of the Company", OWN, [OWN], "(pat{} - nci{})", "m", "v in (1, 3, 7)"),
    (70, "Owners of the Company", OWN, [OWN], None, "m", "v = 5"),
    (71, "- from continuing operations", None, [], "(pat{} - nci{} - 4)", "m", "v = 5"),
    (72, "- from discontinued operations", None, [], "4", "m", "v = 5"),
    (73, "Non-controlling interests", NCI, [NCI], "nci{}", "m", "v % 2 = 1"),
    (80, "Total comprehensive income for the financial year", TCI, [TCI], "(pat{} + oci{})", "m", "v <> 7"),
    (80, "for the financial year", None, [TCI], "(pat{} + oci{})", "m", "v = 7"),
    (90, "Owners of the Company", OWN, [OWN], "(pat{} - nci{})", "m", "v % 2 = 0"),
    (91, "Non-controlling interests", NCI, [NCI], "nci{}", "m", "v % 2 = 0"),
    (92, "Owners of the Company", OWN, [TCI_OWN], "(pat{} + oci{} - nci{})", "m", "true"),
    (93, "Non-controlling interests", NCI, [TCI_NCI], "nci{}", "m", "true"),
    (100, "Earnings per share attributable to owners of the Company (sen):", None, [], None, "e", "v in (0, 1, 2, 4, 5)"),
    (100, "Earnings per share (RM)", None, [], None, "e", "v = 3"),
    (100, "Basic/diluted earnings per", None, [], None, "e", "v = 6"),
    (101, "share (sen)", None, [BASIC, DILUTED], "eps{}", "e", "v = 6"),
    (102, "Basic earnings per share from continuing operations (sen)", None, [None], "(eps{} - 1)", "e", "v = 7"),
    (103, "Earnings per share (sen)", None, [BASIC], "eps{}", "e", "v = 7"),
    (104, "- Basic", None, [BASIC], "eps{}", "e", "v in (0, 1, 2, 4, 5)"),
    (104, "- Basic", None, [BASIC], "eps{}", "r", "v = 3"),
    (105, "- Diluted", None, [DILUTED], "(eps{} - 2)", "e", "v in (0, 1, 2, 4, 5)"),
    (105, "- Diluted", None, [DILUTED], "(eps{} - 2)", "r", "v = 3"),
]
#: The same for notes: number, label, figure, unit (t: thousands with three decimals as millions), kinds.
NOTE_ROWS = [
    (1, "Profit attributable to owners of the Company", "(pat{} - nci{})", "m", "w not in (1, 4)"),
    (1, "Profit attributable to owners of the Company", "((pat{} - nci{}) * 1000)", "m", "w = 1"),
    (2, "Weighted average number of ordinary", None, "m", "w = 1"),
    (3, "shares in issue", "shares", "m", "w = 1"),
    (4, "Number of ordinary shares in issue at 1 January (million)", "(shares / 1000 - 7)", "t", "w = 2"),
    (5, "Effect of shares issued (million)", "7", "t", "w = 2"),
    (6, "Weighted average number of ordinary shares (million)", "(shares / 1000)", "t", "w = 2"),
    (7, "Weighted average number of ordinary shares in issue ('000)", "(shares / 1000)", "m", "w not in (1, 2)"),
    (8, "Basic earnings per share (sen)", "eps{}", "e", "w <> 3"),
    (8, "Basic earnings per share (sen)", "(eps{} * 2 + 100)", "e", "w = 3"),
]


def _split(x: str, scale: int) -> str:
    """x / 10 ** scale with brackets for a minus."""
    size = 10**scale
    shown = f"cast(cast(floor(abs({x}) / {size}e0) as bigint) as varchar(20)) || '.' || lpad(cast(cast(abs({x}) as bigint) % {size} as varchar(4)), {scale}, '0')"
    return f"case when {x} < 0 then '(' || {shown} || ')' else {shown} end"


PRINTERS = {"m": lambda x: _printed(f"cast({x} as bigint)"), "e": lambda x: _split(x, 2), "r": lambda x: _split(x, 4), "t": lambda x: _split(x, 3)}


def _sql(text: str | None) -> str:
    return "cast(null as varchar(60))" if text is None else f"'{text}'"


def _cells(figure: str | None, unit: str) -> str:
    return ", ".join("cast(null as varchar(30))" if figure is None else PRINTERS[unit](figure.replace("{}", s)) for s in ("", "_p"))


def _line(no: int, label: str, concept: str | None, figure: str | None, unit: str, kinds: str) -> str:
    quoted = label.replace("'", "\\'")
    return f"case when {kinds} then struct({no} as row_no, '{quoted}' as label, {_sql(concept)} as concept, array({_cells(figure, unit)}) as cells) end"


def _lines(spark: SparkSession, sf_dir: str, lines: list[str]) -> DataFrame:
    _views(spark, sf_dir, "supplier", "nation", "region", "lineitem")
    each = spark.sql(f"{WITH_BOOK}, {INCOMES} select doc, array({', '.join(lines)}) as lines from incomes")
    return each.select("doc", F.explode(F.array_compact("lines")).alias("x")).select("doc", "x.*")


def income_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, statement, row_no, label, concept, cells."""
    rows = _lines(spark, sf_dir, [_line(no, label, concept, figure, unit, kinds) for no, label, concept, _, figure, unit, kinds in ROWS])
    return rows.select("doc", F.lit("IS").alias("statement"), "row_no", "label", "concept", "cells")


def note_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, row_no, label, cells."""
    return _lines(spark, sf_dir, [_line(no, label, None, figure, unit, kinds) for no, label, figure, unit, kinds in NOTE_ROWS]).drop("concept")


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, col, year (of the statement), note_year (null where the note prints none), header (of the note), scale."""
    _views(spark, sf_dir, "supplier", "nation", "region", "lineitem")
    both = spark.sql(f"{WITH_BOOK}, {INCOMES} select doc, cast(fy as int) as fy, w, explode(array(0, 1)) as col from incomes")
    year = F.col("fy") - F.col("col")
    return both.select("doc", "col", year.alias("year"), F.when(F.col("w") != 5, year).alias("note_year"), F.when(F.col("w") == 1, "RM").otherwise("RM'000").alias("header"), F.lit(1000).alias("scale"))
