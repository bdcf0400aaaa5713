"""Document versions, derivation, accounting identities, reconciliation, feed, calendar, counts and data quality."""

from __future__ import annotations

from finloom.plans.facts import BASE, COMPANY, REPORTED, median, months_after

FULL = BASE + ", " + REPORTED
CURRENT = ", ranked as (select *, row_number() over (partition by company_id, concept, fy order by filed desc nulls last, hint desc nulls last, doc_id desc) as rn from reported), current_facts as (select company_id, fy, concept, value, doc_id from ranked where rn = 1)"
QUARTERS = ", q as (select company_id, fy, cast(floor(month_no / 3) as int) + 1 as quarter, cast(sum(sold) as double) / 100 as revenue from line group by 1, 2, 3)"
SHIPS = "ships as (select distinct cast(l_shipdate as date) as day, l_suppkey % 4 as k from lineitem), dated as (select day, case k when 0 then 12 when 1 then 3 when 2 then 6 else 9 end as fye from ships)"


def matches(x: str, pattern: str, d: str) -> str:
    return f"{x} rlike '{pattern}'" if d == "spark" else f"regexp_matches({x}, '{pattern}')"


QUERIES = {
    "facts_current": lambda d: FULL + CURRENT + " select company_id, fy, concept, round(value, 2) as value, doc_id from current_facts",
    "fact_query_prefix": lambda d: FULL + " select company_id, fy, concept, doc_id, filed, round(value, 2) as value from reported where concept like 'is.%' and filed is not null",
    "stale_facts": lambda d: FULL + CURRENT + " select r.company_id, r.fy, r.concept, r.doc_id from reported r left join current_facts c on r.company_id = c.company_id and r.fy = c.fy and r.concept = c.concept and r.doc_id = c.doc_id where c.doc_id is null",
    "comparative": lambda d: FULL + """, v as (select *, first_value(value) over (partition by company_id, concept, fy order by doc_id) as original, row_number() over (partition by company_id, concept, fy order by doc_id) as rn from reported)
        select company_id, concept, fy, doc_id, round(value - original, 2) as delta, case when value = original then 'MATCH' when abs(value - original) <= 1000 and abs(value - original) <= 0.02 * abs(original) then 'ROUNDING' else 'RESTATEMENT' end as class from v where rn > 1""",
    "rules_q4": lambda d: BASE + QUARTERS + " select q.company_id, q.fy, count(*) as quarters, abs(sum(q.revenue) - max(a.revenue)) <= 1 as passed, round(max(case when quarter = 4 then q.revenue end), 2) as q4 from q join annual a on a.company_id = q.company_id and a.fy = q.fy group by q.company_id, q.fy having count(*) = 4",
    "five_year_shift": lambda d: BASE + """, printed as (select company_id, fy + case when company_id % 5 = 0 then 1 else 0 end as fy, revenue from annual), hits as (select p.company_id, s.shift, count(*) as n from printed p join (select -1 as shift union all select 0 union all select 1) s on 1 = 1 join annual a on a.company_id = p.company_id and a.fy = p.fy + s.shift and abs(a.revenue - p.revenue) <= 0.01 * abs(a.revenue) group by 1, 2),
        w as (select company_id, coalesce(max(case when shift = 0 then n end), 0) as base, coalesce(max(case when shift = -1 then n end), 0) as back, coalesce(max(case when shift = 1 then n end), 0) as ahead from hits group by company_id) select company_id, case when back >= 3 and back > 2 * base and back >= ahead then -1 when ahead >= 3 and ahead > 2 * base then 1 end as shift from w""",
    "deadlines": lambda d: f"with {COMPANY}, m as (select company_id, fye, market, x.n, {months_after('make_date(2024, 10, 1)', 'x.n')} as ended from company join (" + " union all ".join(f"select {n} as n" for n in range(-5, 3)) + f") x on 1 = 1), e as (select *, (month(ended) - fye + 12) % 12 as gap from m), f as (select *, case when gap = 0 then {months_after('ended', '4')} else {months_after('ended', '2')} end as due from e where gap % 3 = 0 and (gap = 0 or market <> 'LEAP')) select company_id, ended, due, case when gap = 0 then 'annual' else 'quarterly' end as kind, year(ended) + case when month(ended) > fye then 1 else 0 end as fy from f where due >= make_date(2024, 10, 22) and due <= make_date(2024, 12, 6)",
    "fiscal_calendar": lambda d: f"with {SHIPS} select day, fye, year(day) + case when month(day) > fye then 1 else 0 end as fy, cast(floor((month(day) - fye + 23) % 12 / 3) as int) + 1 as quarter, {months_after('day', '-12')} as month_end_before from dated",
    "period_bounds": lambda d: f"with {SHIPS}, ends as (select distinct last_day(day) as ended, fye from dated) select ended, fye, {months_after('ended', '-3')} as before_quarter, {months_after('ended', '-6')} as before_half, {months_after('ended', '-((month(ended) - fye + 23) % 12 + 1)')} as before_year from ends",
    "status_counts": lambda d: "select event_type, count(*) as n, count(distinct user_id) as users, max(ts) as last_seen from events group by event_type",
    "activity_windows": lambda d: "select cast(ts as date) as day, hour(ts) as hour, event_type, count(*) as n, round(sum(cast(floor(value * 1000) as bigint)) / cast(1000 as double), 3) as total from events group by 1, 2, 3",
    "coverage_by_company": lambda d: BASE + " select company_id, min(fy) as first_fy, max(fy) as last_fy, count(*) as years, max(fy) - min(fy) + 1 - count(*) as missing_years, count(dividends) as with_dividends from annual group by company_id",
    "funnel": lambda d: BASE + ", f as (select c.company_id, count(a.fy) as years, count(a.dividends) as divs, max(case when a.pat > 0 then 1 else 0 end) as profit from company c left join annual a on a.company_id = c.company_id group by c.company_id) select count(*) as companies, count(*) filter (where years > 0) as with_facts, count(*) filter (where years >= 5) as five_years, count(*) filter (where divs > 0) as with_dividends, count(*) filter (where profit = 1) as profitable from f",
    "review_facets": lambda d: "select source, lang, count(*) as n, count(*) filter (where quality = 0) as poor, count(*) filter (where l.doc_id is null) as unlabelled from documents d left join labels l on l.doc_id = d.doc_id group by source, lang",
    "company_doc_counts": lambda d: BASE + ", " + REPORTED.split("), by_doc")[0] + ") select c.company_id, c.name, count(d.doc_id) as documents, count(d.filed) as dated from company c left join docs d on d.company_id = c.company_id group by c.company_id, c.name",
    "doc_fingerprint_dups": lambda d: "select " + ("sha1" if d == "spark" else "sha1") + "(coalesce(text, '')) as fingerprint, count(*) as n, min(doc_id) as first_doc, max(doc_id) as last_doc from documents where length(text) >= 500 group by 1 having count(*) > 1",
    "ingest_dedupe": lambda d: "with h as (select doc_id, sha" + ("2(text, 256)" if d == "spark" else "256(text)") + " as digest from documents where text is not null), r as (select *, row_number() over (partition by digest order by doc_id) as rn from h) select doc_id, digest, rn = 1 as created, substr(digest, 1, 2) || '/' || substr(digest, 3, 2) || '/' || digest || '.pdf' as storage_key from r",
    "concept_lookup": lambda d: "with words as (select distinct p_type as label, split_part(lower(p_type), ' ', 1) as head from part), own as (select label, 'own:' || head as concept from words where length(head) > 5), all_labels as (select label, 'any:' || head as concept from words) select a.label, coalesce(o.concept, a.concept) as concept from all_labels a left join own o on o.label = a.label",
}
