"""Result rows and observations, flags, votes, scales, digests, pages of lists and exports, each for all companies at once."""

from __future__ import annotations

from finloom.operators.analysis import DIVIDENDS, PEERS
from finloom.operators.checks import FULL, QUERIES as CHECKS
from finloom.plans.facts import BASE, COMPANY

#: Every fourth company prints thousands, every seventh millions; hits count the years that a unit explains.
UNITS = """, printed as (select company_id, fy, revenue, case when company_id % 7 = 0 then revenue / 1000000 when company_id % 4 = 0 then revenue / 1000 else revenue end as shown from annual),
units as (select 1 as unit union all select 1000 union all select 1000000), hits as (select company_id, unit, count(*) filter (where abs(shown * unit - revenue) <= 0.01 * abs(revenue)) as n from printed join units on 1 = 1 group by company_id, unit),
placed as (select *, max(case when unit = 1 then n end) over (partition by company_id) as baseline, row_number() over (partition by company_id order by n desc, unit) as place from hits)"""
#: Statements vote on the month a fiscal year ends; every fifth names another month, and only the last 730 days count.
VOTES = """, vote as (select company_id, case when (company_id + fy) % 5 = 0 then 7 else fye end as month_no, hint from (select distinct company_id, fy, fye, last_day(make_date(cast(fy as int), cast(fye as int), 1)) as hint from docs) s),
latest as (select company_id, max(hint) as last_hint from vote group by company_id), counted as (select v.company_id, v.month_no, count(*) as votes from vote v join latest l on v.company_id = l.company_id and v.hint >= l.last_hint - interval 730 day group by v.company_id, v.month_no),
totals as (select *, sum(votes) over (partition by company_id) as of_all from counted)"""
CURRENT_DOC = "row_number() over (partition by company_id, concept, fy order by filed desc nulls last, hint desc nulls last, doc_id desc)"


QUERIES = {
    "annual_facts_pruned": lambda d: BASE + " select company_id, fy, revenue, pat from annual where fy >= 1997 and company_id in (select company_id from company where sector in ('ASIA', 'EUROPE'))",
    "sector_counts": lambda d: f"with {COMPANY} select sector, profile, count(*) as n, count(*) filter (where market = 'MAIN') as main_market, count(distinct fye) as year_ends from company group by sector, profile",
    "sector_rollup": lambda d: f"with {COMPANY} select coalesce(sector, 'all') as sector, coalesce(market, 'all') as market, count(*) as n from company group by rollup (sector, market)",
    "review_page": lambda d: "select d.doc_id, d.source, d.lang, d.n_chars from documents d join labels l on l.doc_id = d.doc_id where l.quality = 0 order by d.n_chars desc nulls last, d.doc_id limit 20 offset 20",
    "recent_runs": lambda d: "select user_id, max(ts) as last_seen, count(*) as n, count(*) filter (where event_type = 'purchase') as purchases from events where user_id is not null group by user_id order by last_seen desc, user_id limit 15",
    "eps_consistency": lambda d: BASE + ", e as (select company_id, fy, pat, shares, floor(pat / shares * 100) as eps_sen from annual) select company_id, fy, eps_sen, round(eps_sen * shares / 100 - pat, 4) as delta, abs(eps_sen * shares / 100 - pat) <= case when shares / 200 > 1 then shares / 200 else 1 end as passed from e",
    "five_year_units": lambda d: BASE + UNITS + " select company_id, n as hits, baseline, case when n >= 2 and n > baseline then unit end as unit from placed where place = 1",
    "brief_digest": lambda d: f"with dl as ({CHECKS['deadlines'](d)}), sized as (select s_suppkey as company_id, s_acctbal as size from supplier), r as (select dl.due, dl.kind, dl.company_id, row_number() over (partition by dl.due order by size desc nulls last, dl.company_id) as place from dl left join sized s on s.company_id = dl.company_id) select due, count(*) as n, count(*) filter (where kind = 'annual') as annual, count(*) filter (where kind = 'quarterly') as quarterly, max(case when place = 1 then company_id end) as largest, max(case when place = 2 then company_id end) as second, max(case when place = 3 then company_id end) as third from r group by due",
    "fy_end_votes": lambda d: FULL + VOTES + " select company_id, month_no, votes, of_all from totals where votes >= 2 and 2 * votes > of_all",
    "roll_forward": lambda d: BASE + ", p as (select company_id, fy, equity, pat, dividends, lag(equity) over w as opening, lag(fy) over w as fy_before from annual window w as (partition by company_id order by fy)) select company_id, fy, round(equity - (opening + pat + coalesce(dividends, 0)), 4) as delta, abs(equity - (opening + pat + coalesce(dividends, 0))) <= 1 as passed from p where fy_before = fy - 1",
    "listing_status": lambda d: f"with {COMPANY}, listed as (select c_custkey as code, r_name as sector from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey) select company_id, case when code is null then 'UNLISTED' when l.sector = c.sector then 'OK' else 'OTHER_ISSUER' end as status from company c left join listed l on l.code = c.company_id * 3",
    "prune_candidates": lambda d: "with r as (select doc_id, source, coalesce(length(text), 0) >= 500 as relevant from documents), w as (select *, sum(case when relevant then 1 else 0 end) over (partition by source) as good from r) select doc_id, source from w where not relevant and good > 0",
    "snapshot_export": lambda d: FULL + f", r as (select *, {CURRENT_DOC} as rn from reported) select r.company_id, c.name, c.sector, c.market, r.fy, r.concept, r.doc_id, r.filed, r.hint, round(r.value, 2) as value, r.rn = 1 as is_current from r join company c on c.company_id = r.company_id",
    "coverage_matrix": lambda d: FULL + " select company_id, fy, count(distinct concept) as concepts, max(case when concept like 'is.%' then 1 else 0 end) as has_is, max(case when concept like 'bs.%' then 1 else 0 end) as has_bs, count(distinct doc_id) as documents from reported group by company_id, fy",
    "comparative_counts": lambda d: f"with c as ({CHECKS['comparative'](d)}) select company_id, count(*) filter (where class = 'MATCH') as matched, count(*) filter (where class = 'ROUNDING') as rounded, count(*) filter (where class = 'RESTATEMENT') as restated, round(count(*) filter (where class = 'MATCH') / cast(count(*) as double), 6) as agreement from c group by company_id",
}
