"""Registered queries over printed statements, with DuckDB twins that share the printed text only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finloom.operators import equity, five_year, page_runs, page_tables
from finloom.plans import matrices, printed, reports
from finloom.plans.stored import stored


def equity_matrix_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equity.equity_facts(matrices.statement_lines(spark, sf_dir), matrices.statement_heads(spark, sf_dir))


def equity_matrix_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equity.refusals(matrices.statement_lines(spark, sf_dir), matrices.statement_heads(spark, sf_dir))


def _number(c: str) -> str:
    return f"(case when {c} like '(%' then -(trim({c}, '()')::double) else {c}::double end)"


#: Blocks by self-joins: each closing with the last balance before it.
EQUITY_BLOCKS = f"""{matrices.WITH_MATRICES}, head as (
    select doc_id, company_id, group_has_nci as wide, v, header, strptime(regexp_extract(header, 'ended ([0-9]+ [A-Za-z]+ [0-9]+)', 1), '%d %B %Y')::date as stated from heads
), h as (
    select h.*, coalesce(g.fye, month(stated)) as fye from head h join heads g using (doc_id)
), cell as (
    select doc_id, row_no, label, concept, {', '.join(f'{_number(c)} as {c}' for c in ('capital', 'retained', 'attributable', 'others', 'total'))} from lines
), dated as (
    select doc_id, row_no, unnest(regexp_extract_all(label, '[0-9]+ [A-Z][a-z]+ [0-9]+')) as written from cell where label similar to '(At|Balance) .*'
), balance as (
    select doc_id, row_no, strptime(written, '%d %B %Y')::date as on_day from dated
), event as (
    select doc_id, row_no, on_day, case when on_day = last_day(on_day) and month(on_day) = fye then 'close' when day(on_day) = 1 and month(on_day) = fye % 12 + 1 then 'open' end as kind from balance join h using (doc_id)
    union all
    select doc_id, row_no, case when concept like '%opening%' then last_day(stated - interval 12 month) + 1 else stated end, case when concept like '%opening%' then 'open' else 'close' end
    from cell join h using (doc_id) where concept is not null and doc_id not in (select doc_id from balance)
), lost as (
    select distinct doc_id from event where kind is null
), placed as (
    select e.*, year(on_day) + case when month(on_day) > fye then 1 else 0 end as fy, row_no * 2 + case when kind = 'open' then 1 else 0 end as place from event e join h using (doc_id) where doc_id not in (select doc_id from lost)
), paired as (
    select c.doc_id, c.fy, c.row_no as to_row, c.on_day, (select max(place) from placed p where p.doc_id = c.doc_id and p.place < c.place) as prior from placed c where kind = 'close'
), block as (
    select b.doc_id, b.fy, b.to_row, b.on_day, p.row_no as from_row from paired b join placed p on p.doc_id = b.doc_id and p.place = b.prior where p.fy + case p.kind when 'close' then 1 else 0 end = b.fy
), ends as (
    select b.*, o.total as opens, c.total as closes, abs(o.attributable + o.others - o.total) > 1 or abs(c.attributable + c.others - c.total) > 1 as gap,
        abs(o.capital + o.retained - o.total) <= 1 and abs(c.capital + c.retained - c.total) <= 1 as adds
    from block b join cell o on o.doc_id = b.doc_id and o.row_no = from_row join cell c on c.doc_id = b.doc_id and c.row_no = to_row
), judged as (
    select h.doc_id, case when header not like '%CHANGES IN EQUITY%' then 'no heading of changes in equity' when header like '%months ended%' then 'not a year'
        when doc_id in (select doc_id from lost) then 'a balance is not dated on the ends of the fiscal year'
        when v = 11 and (wide or not coalesce((select bool_and(adds) from ends e where e.doc_id = h.doc_id), false)) then 'no one column of total equity'
        when doc_id not in (select doc_id from ends) then 'no complete block of the statement''s years'
        when wide and (select bool_or(gap) from ends e where e.doc_id = h.doc_id) then 'attributable and others'' share are not the total' end as reason
    from h
), chained as (
    select b.*, not exists (select 1 from ends a where a.doc_id = b.doc_id and a.fy = b.fy - 1 and a.closes <> b.opens) as follows from ends b
)"""
EQUITY_FACTS_SQL = f"""{EQUITY_BLOCKS}, held as (
    select c.*, company_id, case when wide or header not like '%The Company%' then 'CONSOLIDATED' else 'COMPANY' end as basis, case when wide then 4 else 2 end as col, fye
    from chained c join judged j using (doc_id) join h using (doc_id) where reason is null and follows
), span as (
    select *, (last_day(make_date(fy, fye, 1) - interval 12 month) + 1)::date as period_start from held
), told as (
    select doc_id, fy, 'eq.opening_balance' as concept, period_start as instant, opens as value from span union all select doc_id, fy, 'eq.closing_balance', on_day, closes from span
    union all
    select s.doc_id, s.fy, case when lower(label) like 'other comprehensive %' then 'eq.other_comprehensive_income' when lower(label) like '%dividend%' then 'eq.dividends' when lower(label) like '%profit%' then 'eq.profit_for_year' end, null, total
    from span s join cell c on c.doc_id = s.doc_id and row_no > from_row and row_no < to_row
), summed as (
    select doc_id, fy, concept, instant, sum(value) * 1000 as value, count(*) as n_rows from told where concept is not null group by all
)
select doc_id, company_id, basis, col, fy as fiscal_year, period_start, on_day as period_end, concept, instant, value, n_rows
from summed join span using (doc_id, fy) where n_rows = 1 or concept = 'eq.dividends'
"""
EQUITY_REFUSALS_SQL = f"""{EQUITY_BLOCKS}
select doc_id, coalesce(reason, 'blocks do not chain') as reason from judged where reason is not null or doc_id in (select doc_id from chained where not follows)
"""

def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each word of the printed summaries with its half of a spread, its block and its row."""
    words, pages = printed.printed(spark, sf_dir)
    return page_tables.blocks(words, pages).select("doc", "page", "word_id", "half", "block", "row_no")


def five_year_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures read from the printed summaries."""
    words, pages = printed.printed(spark, sf_dir)
    placed = stored(page_tables.blocks(words, pages), "blocks")
    rows = stored(page_tables.cells(placed, five_year.is_figure(F.col("text"))), "page-rows")
    return five_year.summary_values(rows).select("doc", "concept", "fiscal_year", F.round("value", 2).alias("value"))


#: Where the printer put each word: a panel beside the table makes two blocks below the shared title, a spread two halves.
PAGE_BLOCKS_SQL = f"""{printed.WITH_PRINTED}, placed as (
    select doc, page, word_id, word_id // 100 as line, case when v <> 1 then 0 when kind = 'table' then 1 else 2 end as half,
        case when v <> 0 or word_id // 100 < 2 then 0 when kind = 'panel' then 2 else 1 end as block
    from words
)
select doc, page, word_id, half, block, dense_rank() over (partition by doc, page, half, block order by line) - 1 as row_no from placed
"""
#: The figures as they were printed, whole thousands and two decimals.
FIVE_YEAR_SQL = f"""{printed.WITH_PRINTED}
select company_id as doc, concept, fy as fiscal_year,
    round((case when word like '(%' then -1 else 1 end) * trim(word, '()')::double * case when line < 10 then 1000 else 1 end, 2) as value
from figure where word <> '-'
"""

def statement_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run of pages of each report that carries each statement."""
    return page_runs.best_runs(page_runs.evidence(reports.report_pages(spark, sf_dir)))


def _says(text: str, phrases: list[str]) -> str:
    return "(" + " or ".join(f"{text} like '% {p} %'" for p in phrases) + ")"


def _flat(text: str) -> str:
    return f"' ' || trim(regexp_replace(replace(lower({text}), chr(39), ''), '[^a-z0-9]+', ' ', 'g')) || ' '"


def _of_statement(name: str) -> str:
    heads, own, last = page_runs.STATEMENTS[name]
    hits = " + ".join(f"(line like '% {p} %')::int" for p in own)
    return f"select doc, page, '{name}' as statement, excluded, {_says('head', heads)} as headed, {hits} as hits, {_says('line', last)} as ends from kept"


#: All runs by self-joins, then the best of each report and statement.
STATEMENT_PAGES_SQL = f"""{reports.WITH_REPORTS}, flat as (
    select doc, page, {_flat("text")} as line, {_flat(f"array_to_string(string_split(text, chr(10))[1:{page_runs.HEAD}], ' ')")} as head,
        len(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda w: regexp_matches(w, '^-?[0-9]+([.][0-9]+)?$'))) as n_figures
    from pages
), kept as (
    select *, {_says("head", page_runs.EXCLUDED)} as excluded from flat where n_figures >= {page_runs.FIGURES}
), judged as (
    {" union all ".join(map(_of_statement, page_runs.STATEMENTS))}
), said as (
    select j.doc, j.page, j.statement, {page_runs.PER_HIT} * j.hits + case when j.headed then {page_runs.HEADED} else 0 end as score, not j.excluded and j.headed and j.hits > 0 as starts,
        not j.excluded and j.hits > max(r.hits) and not (bool_or(r.headed) and not j.headed) as leans, j.ends
    from judged j join judged r on r.doc = j.doc and r.page = j.page and r.statement <> j.statement group by j.doc, j.page, j.statement, j.hits, j.headed, j.excluded, j.ends
), run as (
    select a.doc, a.statement, a.page as first_page, b.page as last_page, sum(m.score) + {page_runs.GOES_ON} * (b.page - a.page) + case when b.ends then {page_runs.ENDS} else 0 end as score
    from said a join said b on b.doc = a.doc and b.statement = a.statement and b.page between a.page and a.page + {page_runs.LONGEST - 1}
    join said m on m.doc = a.doc and m.statement = a.statement and m.page between a.page and b.page
    where a.starts group by a.doc, a.statement, a.page, b.page, b.ends having count(*) = b.page - a.page + 1 and bool_and(m.page = a.page or m.leans)
)
select doc, statement, first_page::int as first_page, last_page::int as last_page, score::double as score from run
qualify row_number() over (partition by doc, statement order by score desc, first_page, last_page) = 1
"""

FRAMES = {f.__name__: f for f in (equity_matrix_facts, equity_matrix_refusals, page_blocks, five_year_values, statement_pages)}
SQL = {"equity_matrix_facts": EQUITY_FACTS_SQL, "equity_matrix_refusals": EQUITY_REFUSALS_SQL, "page_blocks": PAGE_BLOCKS_SQL, "five_year_values": FIVE_YEAR_SQL, "statement_pages": STATEMENT_PAGES_SQL}
