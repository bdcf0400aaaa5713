"""Links, word layout, page scores and best documents, as SQL that Spark and DuckDB both read."""

from __future__ import annotations

from finloom.operators.checks import matches

#: Words of a page: orders stand for pages, suppliers for documents; figures end at a column's right edge, a few points off.
WORDS = "word as (select l_suppkey as doc, l_linestatus as page, 200 + 80 * (l_linenumber % 4) + cast(floor(l_quantity) as int) % 6 + case when l_orderkey % 40 = 0 then 37 else 0 end as x1 from lineitem)"
KEYWORDS = ["the", "and", "der", "que", "los", "is", "of", "en"]


def _links(d: str) -> str:
    # Double quotes, single quotes (chr 39) or none, in any case.
    value = "[\"' || chr(39) || ']?([^\"' || chr(39) || ' >]*)"
    pattern = f"'(?i)<a[ ][^>]*?href ?= ?{value}'"
    found = f"explode(regexp_extract_all(html, {pattern}, 1))" if d == "spark" else f"unnest(regexp_extract_all(html, {pattern}, 1))"
    return f"with a as (select page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) as site, {found} as href from pages where html is not null), b as (select page_id, case when {matches('href', '^https?:', d)} then href when {matches('href', '^/', d)} then site || href else site || '/' || href end as target, href from a)"


def _score(d: str) -> str:
    return "case when " + matches("lower(href)", "annual|report|investor", d) + " then 3 when " + matches("lower(href)", "financ|result|news", d) + " then 2 when " + matches("lower(href)", "(19|20)[0-9][0-9]|archive|page", d) + " then 1 else 0 end"


def _page_scores(d: str) -> str:
    size = "size(split(text, ' '))" if d == "spark" else "len(string_split(text, ' '))"
    numbers = "size(regexp_extract_all(text, '([0-9]+)', 1))" if d == "spark" else "len(regexp_extract_all(text, '([0-9]+)', 1))"
    hits = " + ".join(f"case when lower(text) like '%{k} %' then 1 else 0 end" for k in KEYWORDS)
    return f"with s as (select doc_id, source, {hits} as hits, {numbers} as numbers, {size} as words from documents where text is not null), t as (select *, 10 * hits + numbers / cast(words as double) as score from s), r as (select *, row_number() over (partition by source order by score desc, doc_id) as place from t) select doc_id, source, hits, numbers, round(score, 6) as score, place from r where place <= 10"


QUERIES = {
    "nav_links": lambda d: _links(d) + f" select page_id, target, max({_score(d)}) as score, count(*) as n from b group by page_id, target",
    "link_years": lambda d: _links(d) + " select page_id, regexp_extract(href, '((19|20)[0-9][0-9])', 1) as link_year, count(*) as n from b group by 1, 2",
    "column_bands": lambda d: f"with {WORDS}, edge as (select *, case when x1 - lag(x1) over (partition by doc, page order by x1) > 9 then 1 else 0 end as opens from word), isl as (select doc, page, x1, sum(opens) over (partition by doc, page order by x1) as band from edge) select doc, page, band, min(x1) as left_edge, max(x1) as right_edge, count(*) as support from isl group by doc, page, band having count(*) >= 3",
    "page_scores": _page_scores,
    "best_document": lambda d: "with s as (select doc_id, source, lang, coalesce(length(text), 0) as chars, coalesce(length(text) - length(replace(text, chr(10), '')), 0) as breaks from documents), r as (select *, row_number() over (partition by source, lang order by breaks desc, chars desc, doc_id) as place from s) select source, lang, doc_id, breaks, chars from r where place = 1",
}
