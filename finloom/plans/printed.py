"""Pages of words over the supplied tables: five-year summaries of the companies, as a printer would place them.

A page has a title, a caption with the unit, a row of years, and rows of a label and right-aligned figures; one label is wrapped over
two lines. Of five kinds, by company, one has a second panel beside the table, one is a spread of two pages, one prints years as
FY1998 or 1998*, and one prints them in ascending order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finloom.plans.book import WITH_BOOK, _views
from finloom.plans.stored import stored

#: Label, concept, printed figure over a book's year (in thousands, sen or ringgit), by row from 3 on; a label may be wrapped.
ITEMS = [
    (3, ["Revenue"], "is.revenue", "is_revenue / 1000"),
    (4, ["Profit before taxation"], "is.profit_before_tax", "is_profit_before_tax / 1000"),
    (5, ["Profit after taxation"], "is.profit_for_period", "is_profit_for_period / 1000"),
    (7, ["Profit attributable to owners", "of the Company"], "is.pat_owners", "is_pat_owners / 1000"),
    (8, ["Total assets"], "bs.total_assets", "bs_total_assets / 1000"),
    (9, ["Total equity"], "bs.total_equity", "bs_total_equity / 1000"),
    (10, ["Basic earnings per share (sen)"], "is.eps_basic", "is_eps_basic * 100"),
    (11, ["Net assets per share (RM)"], "bs.nta_per_share", "bs_nta_per_share"),
]
PANEL = ["Shareholding spread", "Institutional holders", "Foreign holders", "Public float", "Treasury units", "Directors", "Nominees", "Pension funds", "Insurers", "Other holders"]
#: Points from the left: labels, the first figure's right edge, between figures, the panel; from the top: a row.
LEFT, EDGE, STEP, BESIDE, LINE = 40, 260, 70, 660, 16


def _placed(row: str, first: int, text: str, x0: int, kind: str) -> list[str]:
    """Words of a text set from x0 on, as rows of a constant table (row, number, word, x0, x1, kind)."""
    out = []
    for n, word in enumerate(text.split()):
        out.append(f"({row}, {first + n}, '{word}', {x0}.0, {x0 + 5 * len(word)}.0, '{kind}')".replace("'RM000'", "'RM''000'"))
        x0 += 5 * len(word) + 3
    return out


_LABELS = _placed("0", 1, "Five-Year Financial Highlights", LEFT, "table") + _placed("1", 1, "Amounts in RM000 unless stated", LEFT, "table")
for _row, _label, *_ in ITEMS:
    for _back, _part in enumerate(reversed(_label)):
        _LABELS += _placed(str(_row - _back), 1, _part, LEFT, "table")
for _n, _text in enumerate(PANEL):
    _LABELS += _placed(str(2 + _n), 50, _text, BESIDE, "panel") + _placed(str(2 + _n), 60, str(11 + 7 * _n), BESIDE + 160, "panel")
_FIGURE = "case i.no " + " ".join(f"when {row} then {figure}" for row, *_, figure in ITEMS) + " end"
_DECIMALS = "case when i.no >= 10 then 2 else 0 end"


def _digits(x: str) -> str:
    """A figure with brackets for a minus: whole thousands, or two decimals from row 10 on."""
    whole = f"cast(cast(floor(abs({x})) as bigint) as varchar(20))"
    hundredths = f"cast(cast(floor(abs({x}) * 100) as bigint) % 100 as varchar(2))"
    part = f"case when i.no >= 10 then '.' || lpad({hundredths}, 2, '0') else '' end"
    return f"case when {x} is null then '-' when {x} < 0 then '(' || {whole} || {part} || ')' else {whole} || {part} end"


FIVE = """recent as (
    select *, max(fy) over (partition by company_id) - fy as back, count(*) over (partition by company_id) as n_years, company_id % 5 as v from book
), five as (
    select *, case when v = 3 then 4 - back else back end as col from recent where back < 5 and n_years >= 5
)"""
WORDS = f"""item as (select * from (values {", ".join(f"({row}, '{concept}')" for row, _, concept, _ in ITEMS)}) as t(no, concept)),
glyph as (select * from (values {", ".join(_LABELS)}) as t(line, word_no, word, x0, x1, kind)),
figure as (
    select company_id, v, fy, col, i.no as line, i.concept, {_digits(f"({_FIGURE})")} as word from five cross join item i
), word as (
    select company_id, line, 20 + col as word_no, word, {EDGE}.0 + {STEP} * col + company_id % 3 - 5 * length(word) as x0, {EDGE}.0 + {STEP} * col + company_id % 3 as x1, 'table' as kind, v from figure
    union all
    select company_id, 2, 20 + col, word, {EDGE}.0 + {STEP} * col - 5 * length(word), {EDGE}.0 + {STEP} * col, 'table', v
    from (select company_id, col, v, case when v = 2 and company_id % 2 = 0 then 'FY' || cast(fy as varchar(4)) when v = 2 then cast(fy as varchar(4)) || '*' else cast(fy as varchar(4)) end as word from five) y
    union all
    select company_id, line, word_no, word, x0 + case when v = 1 and kind = 'panel' then 120 else 0 end, x1 + case when v = 1 and kind = 'panel' then 120 else 0 end, kind, v
    from glyph cross join (select distinct company_id, v from five) c where kind = 'table' or v in (0, 1)
), words as (
    select company_id as doc, 1 as page, line * 100 + word_no as word_id, word as text, cast(x0 as double) as x0, cast(x1 as double) as x1,
        cast({LINE} * line + case when kind = 'panel' then 2 else 0 end as double) as y0, cast({LINE} * line + 10 + case when kind = 'panel' then 2 else 0 end as double) as y1, kind, v
    from word
)"""
WITH_PRINTED = f"{WITH_BOOK}, {FIVE}, {WORDS}"
#: Widths of pages; a spread is twice as wide as the document's cover.
PAGE_SQL = "select doc, page, cast(case when page = 0 or v <> 1 then 700 else 1400 end as double) as width from (select distinct company_id as doc, v from five) d cross join (values (0), (1)) as p(page)"


def printed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Words (doc, page, word_id, text, x0, x1, y0, y1) and pages (doc, page, width), each written once."""
    _views(spark, sf_dir, "supplier", "nation", "region", "lineitem")
    stored(spark.sql(f"{WITH_BOOK}, {FIVE} select * from five"), "five-years").createOrReplaceTempView("five")
    words = spark.sql(f"with {WORDS} select doc, page, word_id, text, x0, x1, y0, y1 from words")
    return stored(words, "words"), stored(spark.sql(PAGE_SQL), "pages")
