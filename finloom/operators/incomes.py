"""Registered queries over printed income statements and their notes, with DuckDB twins that share the figures of the books only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.functions.numbers import parse_number
from finloom.operators import income_rows, share_notes
from finloom.plans import incomes
from finloom.plans.book import WITH_BOOK
from finloom.plans.stored import stored


def income_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of every statement with the concept that it has there, of its own year and the one before."""
    rows = income_rows.mapped(incomes.income_lines(spark, sf_dir))
    figure = lambda k: F.get("figures", F.lit(k)).cast("double")
    return rows.select("doc", "row_no", "concept", figure(0).alias("current"), figure(1).alias("prior"))


def face_columns(rows: DataFrame, columns: DataFrame) -> DataFrame:
    """doc, col, year, basis, eps (sen), places, patami of a statement's columns, from its mapped rows. columns: doc, col, year, scale."""
    kept = rows.where(F.col("concept").isin(income_rows.BASIC, "is.pat_owners"))
    each = kept.select("doc", "concept", F.posexplode(F.arrays_zip("figures", "cells")).alias("col", "z"))
    value, printed = F.col("z.figures").cast("double"), F.col("z.cells")
    # Figures printed in ringgit have two decimals fewer in sen.
    converted = F.coalesce((value != 0) & (value == parse_number(printed).cast("double") * 100), F.lit(False))
    places = F.greatest(share_notes.decimals(printed) - F.when(converted, 2).otherwise(0), F.lit(0))
    basic, owners = F.col("concept") == income_rows.BASIC, F.col("concept") == "is.pat_owners"
    faces = each.groupBy("doc", "col").agg(F.max(F.when(basic, value)).alias("eps"), F.max(F.when(basic, places)).alias("places"), F.max(F.when(owners, value)).alias("patami"))
    joined = columns.join(faces, ["doc", "col"], "left")
    return joined.select("doc", "col", "year", F.lit(None).cast("string").alias("basis"), "eps", "places", (F.col("patami") * F.col("scale")).alias("patami"))


def weighted_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weighted share count of each statement's columns, read from its note, with the confidence it has."""
    columns = incomes.columns(spark, sf_dir)
    face = stored(face_columns(income_rows.mapped(incomes.income_lines(spark, sf_dir)), columns), "face_columns")
    own = columns.select("doc", "col", F.col("note_year").alias("year"), F.lit(None).cast("string").alias("basis"), "header", "scale")
    notes = stored(share_notes.share_counts(incomes.note_lines(spark, sf_dir), own, face), "share_notes")
    return share_notes.aligned(notes, face).select("doc", "col", "note_col", "shares", F.col("multiplier").cast("int").alias("multiplier"), "confidence", "note_eps", "face_eps")


def _expected() -> str:
    out = []
    for no, _, _, concepts, figure, unit, kinds in incomes.ROWS:
        if figure is None and "is.pat_owners" in concepts:
            figure = "(pat{} - nci{})"
        cells = ", ".join(f"{figure.replace('{}', s)}::double / {1 if unit == 'm' else 100}" for s in ("", "_p")) if figure else ""
        for concept in concepts:
            out.append(f"select doc, {no} as row_no, {'null' if concept is None else repr(concept)} as concept, {cells} from incomes where {kinds}")
    return " union all ".join(out)


#: Each kind of row on its own, with the concept and figures that it was made from.
INCOME_FACTS_SQL = f"{WITH_BOOK}, {incomes.INCOMES}, facts(doc, row_no, concept, current, prior) as ({_expected()}) select doc, row_no, concept, current, prior from facts"
#: In hundredths of a sen: what the note prints, what profit and shares give, and what the statement prints.
WEIGHTED_SHARES_SQL = f"""{WITH_BOOK}, {incomes.INCOMES}, col as (
    select doc, w, 0 as col, shares, eps as face, eps_p as other, (pat - nci) * 1e7 / shares as exact from incomes
    union all
    select doc, w, 1, shares, eps_p, eps, (pat_p - nci_p) * 1e7 / shares from incomes
), noted as (
    select *, case when w = 3 then face * 2 + 100 else face end as note, case w when 1 then 1 when 2 then 1000000 else 1000 end as multiplier from col
), judged as (
    select *, abs(note - face) <= 0.51 as same, abs(exact - note) <= greatest(0.5, abs(note) * 0.006) + 0.01 as proved from noted
    where abs(note) <= 500000 and not (w = 5 and face = other)
)
select doc, col, col as note_col, shares::double as shares, multiplier, case when same and proved then 1.0 when same or proved then 0.8 else 0.5 end::double as confidence,
    note::double / 100 as note_eps, face::double / 100 as face_eps
from judged
"""
FRAMES = {f.__name__: f for f in (income_facts, weighted_shares)}
SQL = {"income_facts": INCOME_FACTS_SQL, "weighted_shares": WEIGHTED_SHARES_SQL}
