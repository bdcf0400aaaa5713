"""DuckDB twins of the catalogue: what each query must return, said in SQL of its own over the same books."""

from __future__ import annotations

from finloom.plans.book import CONCEPTS, WITH_BOOK
from finloom.plans.facts import COMPANY

B = WITH_BOOK
PAIR = "case when is_pat_owners is not null and bs_equity_owners > 0 then {0} when is_profit_for_period is not null and bs_total_equity > 0 then {1} end"
PAT, EQUITY = PAIR.format("is_pat_owners", "is_profit_for_period"), PAIR.format("bs_equity_owners", "bs_total_equity")
EBIT = "coalesce(is_profit_before_tax + abs(is_finance_costs), is_operating_profit)"
PATAMI = "coalesce(is_pat_owners, is_profit_for_period)"
PAIRED = f", paired as (select *, {PAT} as pat, {EQUITY} as equity, {EBIT} as ebit from book)"
VALUED = f""", by_cash as (
    select *, {EBIT} as ebit, case when cf_profit_before_tax is not null and cf_operating_before_wc - is_profit_before_tax >= 0 then cf_operating_before_wc - is_profit_before_tax else abs(is_depreciation_amortisation) end as dep_amort,
        case when -is_tax_expense / nullif(is_profit_before_tax, 0) between 0 and 0.6 then -is_tax_expense / is_profit_before_tax end as tax_rate, abs(cf_purchase_of_ppe) as capex,
        coalesce(cf_changes_in_receivables + cf_changes_in_inventories + cf_changes_in_payables, cf_working_capital_changes) as wc_change,
        abs(coalesce(bs_borrowings_total, bs_lt_borrowings + bs_st_borrowings, bs_lt_borrowings, bs_st_borrowings)) - bs_cash_and_equivalents as net_debt
    from book
), valued as (
    select company_id, fy, period_end, ebit, tax_rate, dep_amort, capex, wc_change, net_debt, ebit + dep_amort as ebitda, ebit * (1 - tax_rate) as nopat, cf_net_operating - capex as fcfe,
        ebit * (1 - tax_rate) + dep_amort - capex - coalesce(wc_change, 0) as fcff
    from by_cash
)"""
SHARES = "case when is_weighted_avg_shares > 0 then is_weighted_avg_shares when is_pat_owners / nullif(is_eps_basic / 100, 0) > 0 then is_pat_owners / (is_eps_basic / 100) end"
CLOSES = """, closes as (select user_id as company_id, cast(ts as date) as day, max(value) as close from events where event_type = 'purchase' and user_id is not null group by all),
targets as (select company_id, make_date(2024, 1, cast(5 + company_id % 26 as int)) as target from company),
priced as (select t.company_id, t.target, case when c.day >= t.target - interval 10 day then c.day end as day, case when c.day >= t.target - interval 10 day then c.close end as close from targets t asof left join closes c on c.company_id = t.company_id and c.day <= t.target)"""
DIVIDENDS = f""", trusts as (select company_id from company where profile = 'reit' union select company_id from book where is_dpu is not null),
base as (
    select b.*, b.company_id in (select company_id from trusts) as reit, coalesce(abs(cf_dividends_paid), abs(eq_dividends)) as dividends, case when cf_dividends_paid is not null then 'cash' when eq_dividends is not null then 'equity' end as basis,
        {SHARES} as shares, case when is_weighted_avg_shares > 0 then is_weighted_avg_shares end as reported, case when is_pat_owners / nullif(is_eps_basic / 100, 0) > 0 then is_pat_owners / (is_eps_basic / 100) end as implied
    from book b
), dps as (select *, coalesce(case when reit then is_dpu end, dividends / nullif(shares, 0) * 100) as dps_sen, case when reit then is_dpu end as dpu from base),
paid as (
    select *, case when dividends is not null or dps_sen is not null then coalesce(dividends, 0) <> 0 or coalesce(dps_sen, 0) <> 0 end as paid,
        case when dividends is not null and is_pat_owners is not null then case when is_pat_owners > 0 then dividends / is_pat_owners end when is_eps_basic > 0 then dpu / is_eps_basic end as payout
    from dps
), grown as (
    select p.*, case when q.dps_sen <> 0 then p.dps_sen / q.dps_sen - 1 end as growth, case when q.shares > 0 then p.shares / q.shares end as share_ratio
    from paid p left join paid q on q.company_id = p.company_id and q.fy = p.fy - 1
), dividend_year as (
    select company_id, fy, dividends, basis, shares, dps_sen, paid, payout, 1 / nullif(payout, 0) as cover, growth, share_ratio, concat_ws(',',
        case when cf_dividends_paid > 0 then 'cash_inflow' end, case when basis = 'equity' then 'from_equity_statement' end, case when is_weighted_avg_shares <= 0 then 'shares_not_positive' end,
        case when abs(implied - reported) / reported > 0.2 then 'shares_disagree' end, case when reported is null and implied is not null then 'shares_implied' end,
        case when is_pat_owners <= 0 and dividends > 0 then 'paid_in_loss_year' end, case when is_eps_basic > 0 and dps_sen > 3 * is_eps_basic then 'dps_above_eps' end,
        case when payout > 3 then 'payout_implausible' end, case when share_ratio > 1.3 or share_ratio < 1 / cast(1.3 as double) then 'shares_jumped' end, case when growth < -0.9 or growth > 10 then 'growth_unusual' end) as flags
    from grown
)"""
HISTORY = """, known as (select company_id, max(case when paid is not null then fy end) as streak_end from dividend_year group by company_id),
islands as (select company_id, fy, payout, dps_sen, fy - row_number() over (partition by company_id order by fy) as island from dividend_year where paid),
runs as (select company_id, island, count(*) as years, max(fy) as last_fy from islands group by company_id, island),
history as (
    select k.company_id, coalesce(max(r.years) filter (where r.last_fy = k.streak_end), 0) as streak, k.streak_end, coalesce(max(r.years), 0) as longest_streak
    from known k left join runs r on r.company_id = k.company_id group by k.company_id, k.streak_end
), in_streak as (select h.company_id, median(d.payout) filter (where d.payout <= 3) as median_payout, max(d.dps_sen) filter (where d.fy = h.streak_end) as last_dps_sen from history h join dividend_year d on d.company_id = h.company_id and d.fy > h.streak_end - h.streak and d.fy <= h.streak_end group by h.company_id),
flagged as (select company_id, sum(case when flags = '' then 0 else length(flags) - length(replace(flags, ',', '')) + 1 end) as n_flags from dividend_year group by company_id),
full_history as (select h.*, s.median_payout, f.n_flags, s.last_dps_sen from history h join flagged f using (company_id) left join in_streak s using (company_id))"""


def without_negative_zeros(sql: str) -> str:
    """Every round(...) plus zero."""
    out, at = [], 0
    while (found := sql.find("round(", at)) >= 0:
        end, depth = found + 6, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        out += [sql[at:found], "(round(", without_negative_zeros(sql[found + 6 : end]), " + 0)"]
        at = end
    return "".join(out) + sql[at:]


def _cagr(x: str) -> str:
    return f"(select case when o.v > 0 and y.{x} > 0 then power(y.{x} / o.v, 1 / cast(3 as double)) - 1 end from (select company_id, fy, {x} as v from yearly) o where o.company_id = y.company_id and o.fy = y.fy - 3)"


METRICS = {
    "revenue": ("revenue", None), "patami": ("patami", None), "roe": ("pat / equity", (-2, 2)), "roa": ("case when bs_total_assets > 0 then patami / bs_total_assets end", (-1, 1)), "net_margin": ("patami / sales", (-1, 1)), "operating_margin": ("ebit / sales", (-1, 1)),
    "asset_turnover": ("case when bs_total_assets > 0 then sales / bs_total_assets end", (0, 10)), "equity_multiplier": ("case when equity > 0 then bs_total_assets / equity end", (0, 50)), "revenue_cagr_3y": ("revenue_cagr_3y", (-0.9, 3)), "earnings_cagr_3y": ("earnings_cagr_3y", (-0.9, 5)),
    "net_debt_ebitda": ("case when ebitda > 0 then net_debt / ebitda end", (-20, 20)), "fcf_margin": ("fcfe / sales", (-2, 2)),
}
BARRED = {m: ["bank"] for m in ("revenue", "net_margin", "operating_margin", "asset_turnover", "revenue_cagr_3y")} | {m: ["bank", "insurance"] for m in ("net_debt_ebitda", "fcf_margin")}
DOUBTED = ["patami", "roa", "net_margin", "earnings_cagr_3y"]


def _metric(name: str) -> str:
    x, bounds = METRICS[name]
    barred = f"profile in ({', '.join(repr(p) for p in BARRED[name])})" if name in BARRED else "false"
    odd = "false" if bounds is None else f"coalesce(v < {bounds[0]} or v > {bounds[1]}, false)"
    doubt = "coalesce(is_pat_owners / nullif(is_profit_for_period, 0) < 0.2 or is_pat_owners / nullif(is_profit_for_period, 0) > 2, false) and v is not null"
    extra = f" or ({doubt})" if name in DOUBTED else f" or ({doubt} and bs_equity_owners is not null)" if name == "roe" else ""
    return f"select company_id, sector, profile, fy, '{name}' as metric, v as value, {barred} as not_applicable, {odd}{extra} as flagged from (select *, case when {barred} then null else {x} end as v from chosen) x"


SNAPSHOT = (
    VALUED
    + f""", yearly as (select *, is_revenue as revenue, {PATAMI} as patami from book),
ended as (select y.*, p.period_end as before_end, case when y.is_revenue > 0 then y.is_revenue end as sales, {PAT.replace("is_", "y.is_").replace("bs_", "y.bs_")} as pat, {EQUITY.replace("is_", "y.is_").replace("bs_", "y.bs_")} as equity, v.ebit, v.ebitda, v.net_debt, v.fcfe,
    {_cagr("revenue")} as revenue_cagr_3y, {_cagr("patami")} as earnings_cagr_3y
    from yearly y join valued v on v.company_id = y.company_id and v.fy = y.fy left join yearly p on p.company_id = y.company_id and p.fy = y.fy - 1),
picked as (select company_id, coalesce(max(fy) filter (where patami is not null and (before_end is null or period_end - before_end >= 330)), max(fy)) as fy from ended group by company_id),
chosen as (select e.*, c.sector, c.profile from ended e join picked p on p.company_id = e.company_id and p.fy = e.fy join company c on c.company_id = e.company_id),
metric as ({" union all ".join(_metric(m) for m in METRICS)})"""
)
CHANGE = "case when {0} is null or {1} is null then 'none' when {1} > 0 and {0} > 0 then 'growth' when {1} <= 0 and {0} > 0 then 'turnaround' when {1} > 0 and {0} <= 0 then 'to_loss' when {1} = 0 then 'none' when {0} > {1} then 'loss_narrowed' else 'loss_widened' end"
GROWN = "case when {0} > 0 and {1} > 0 then {0} / {1} - 1 end"
ROWS = {"revenue": 0, "gross_profit": 0, "pbt": 0, "patami": 0, "eps_sen": 0, "gross_margin": 1, "pbt_margin": 1, "net_margin": 1, "roe": 1, "tax_rate": 1, "ocf": 0, "capex": 0, "fcf": 0, "net_debt": 0, "gearing": 1, "dps_sen": 0, "payout": 1}
FIGURES = (
    DIVIDENDS
    + f""", plain as (
    select b.company_id, b.fy, b.period_end, is_revenue as revenue, is_gross_profit as gross_profit, is_profit_before_tax as pbt, abs(is_tax_expense) as tax, {PATAMI} as patami, is_eps_basic as eps_sen, cf_net_operating as ocf, abs(cf_purchase_of_ppe) as capex,
        cf_net_operating - abs(cf_purchase_of_ppe) as fcf, coalesce(bs_equity_owners, bs_total_equity) as equity, d.dps_sen, d.payout,
        abs(coalesce(bs_borrowings_total, abs(bs_lt_borrowings) + abs(bs_st_borrowings), abs(bs_lt_borrowings), abs(bs_st_borrowings))) - bs_cash_and_equivalents as net_debt
    from book b join dividend_year d on d.company_id = b.company_id and d.fy = b.fy
), figure as (
    select *, case when revenue > 0 then gross_profit / revenue end as gross_margin, case when revenue > 0 then pbt / revenue end as pbt_margin, case when revenue > 0 then patami / revenue end as net_margin, case when equity > 0 then patami / equity end as roe,
        case when pbt > 0 then tax / pbt end as tax_rate, case when equity > 0 then net_debt / equity end as gearing
    from plain
), side as (
    select f.*, b.fy is not null and b.period_end - coalesce(z.period_end, b.period_end - 400) >= 330 and f.period_end - b.period_end between 330 and 400 as comparable, b.fy is null or f.period_end - b.period_end >= 330 as full_year
    from figure f left join figure b on b.company_id = f.company_id and b.fy = f.fy - 1 left join figure z on z.company_id = f.company_id and z.fy = f.fy - 2
), pair as (select s.*, {", ".join(f"b.{m} as {m}_b" for m in ROWS)} from side s left join figure b on s.comparable and b.company_id = s.company_id and b.fy = s.fy - 1)"""
)


def _headline(m: str, points: int) -> str:
    now, before = m, f"{m}_b"
    change = f"({now} - {before}) * 100" if points else GROWN.format(now, before)
    kind = f"case when {now} is null or {before} is null then 'none' else 'pp' end" if points else CHANGE.format(now, before)
    return f"select company_id, fy, '{m}' as measure, {now} as current_value, {before} as value_before, {change} as change, {kind} as kind from pair where {now} is not null or {before} is not null"


REV, PAT_GROWTH, KIND = GROWN.format("revenue", "revenue_b"), GROWN.format("patami", "patami_b"), CHANGE.format("patami", "patami_b")
OBSERVED = f""", known as (select company_id, fy, revenue, row_number() over (partition by company_id order by fy) as r from pair where revenue <> 0),
steady as (
    select p.company_id, p.fy, power(l.revenue / f.revenue, 1 / cast(3 as double)) - 1 as average
    from pair p join known l on l.company_id = p.company_id and l.fy = (select max(k.fy) from known k where k.company_id = p.company_id and k.fy <= p.fy) join known f on f.company_id = l.company_id and f.r = l.r - 3
    where l.fy - f.fy = 3 and f.revenue > 0 and l.revenue > 0 and f.fy >= coalesce((select min(w.fy) from (select q.fy, row_number() over (order by q.fy desc) as w from pair q where q.company_id = p.company_id and q.fy <= p.fy) w where w <= 6), f.fy)
), seen as (
    select p.*, s.average, case when patami > 0 then ocf / patami end as cash, net_margin - net_margin_b as margin, {REV} as rev, {PAT_GROWTH} as prof, {KIND} as kind from pair p left join steady s on s.company_id = p.company_id and s.fy = p.fy
)"""
OBSERVATIONS = [
    ("weak_cash_conversion", "cash < 0.5", "cash"), ("strong_cash_conversion", "cash > 1.5", "cash"), ("negative_free_cash", "fcf < 0 and patami > 0", "fcf"), ("margin_expansion", "margin * 100 >= 3", "margin"), ("margin_compression", "margin * 100 <= -3", "margin"),
    ("profit_outpaces_revenue", "prof - rev >= 0.25", "prof - rev"), ("profit_lags_revenue", "prof - rev <= -0.25", "prof - rev"), ("back_in_profit", "kind = 'turnaround'", "patami"), ("swung_to_loss", "kind = 'to_loss'", "patami"), ("high_gearing", "gearing > 1", "gearing"),
    ("net_debt_rising", "coalesce(gearing, 0) <= 1 and net_debt_b > 0 and net_debt > 1.25 * net_debt_b and net_debt - net_debt_b > 10000000", "net_debt"), ("dividends_above_earnings", "payout > 1", "payout"), ("unusual_tax_rate", "tax_rate < 0.1 or tax_rate > 0.4", "tax_rate"),
    ("growth_accelerating", "rev - average >= 0.1", "rev - average"), ("growth_slowing", "rev - average <= -0.1", "rev - average"),
]
FEED = f""", item as (
    select company_id, fy, period_end, year(period_end) * 100 + month(period_end) as cohort, revenue, patami, patami_b, {KIND} as kind, {PAT_GROWTH} as growth, {REV} as rev_growth, coalesce(revenue between 100000 and 500000000000, false) as plausible, comparable from pair where full_year
), toned as (
    select *, case when not comparable then 'new' when kind in ('turnaround', 'loss_narrowed') then 'up' when kind in ('to_loss', 'loss_widened') then 'down' when case when kind = 'growth' then growth else rev_growth end >= 0.05 then 'up' when case when kind = 'growth' then growth else rev_growth end <= -0.05 then 'down' else 'flat' end as tone from item
)"""
RULES = {
    "bs_balances": ("bs_total_assets", "bs_total_liabilities + bs_total_equity", 90), "bs_footing": ("bs_total_equity_and_liabilities", "bs_total_assets", 90), "bs_assets_split": ("bs_total_assets", "bs_total_non_current_assets + bs_total_current_assets", 70),
    "bs_liabilities_split": ("bs_total_liabilities", "bs_total_non_current_liabilities + bs_total_current_liabilities", 70), "bs_equity_split": ("bs_total_equity", "bs_equity_owners + bs_nci", 60), "cf_net_change": ("cf_net_change_in_cash", "cf_net_operating + cf_net_investing + cf_net_financing", 80),
    "eq_closing_matches_bs": ("eq_closing_balance", "bs_total_equity", 80), "cf_cash_roll": ("cf_cash_end", "cf_cash_beginning + cf_net_change_in_cash + coalesce(cf_forex_effect, 0)", 80),
    "is_gross_profit": ("is_gross_profit", "is_revenue + case when abs(is_gross_profit - is_revenue - is_cost_of_sales) <= abs(is_gross_profit - is_revenue + is_cost_of_sales) then is_cost_of_sales else -is_cost_of_sales end", 70),
    "is_pbt_to_pat": ("is_profit_for_period", "is_profit_before_tax + case when abs(is_profit_for_period - is_profit_before_tax - is_tax_expense) <= abs(is_profit_for_period - is_profit_before_tax + is_tax_expense) then is_tax_expense else -is_tax_expense end", 80),
    "is_pat_split": ("is_profit_for_period", "is_pat_owners + is_pat_nci", 80), "eps_consistency": ("is_pat_owners", "is_eps_basic / 100 * nullif(is_weighted_avg_shares, 0)", 75),
}


def _rule(name: str) -> str:
    actual, expected, severity = RULES[name]
    within = "greatest(1, is_weighted_avg_shares / 200)" if name == "eps_consistency" else "1"
    return f"select company_id, fy, '{name}' as rule_key, abs(round({actual} - round({expected}, 4), 4)) <= {within} as passed, round({expected}, 4) as expected, {actual} as actual, round({actual} - round({expected}, 4), 4) as delta, {severity} as severity from book where {actual} is not null and {expected} is not null"


OUTCOMES = ", outcome as (" + " union all ".join(_rule(r) for r in RULES) + ")"
DERIVED = """, d1 as (select *, coalesce(bs_total_assets, bs_total_equity_and_liabilities) as a from book),
d2 as (select *, coalesce(bs_total_equity, a - bs_total_liabilities, bs_total_equity_and_liabilities - bs_total_liabilities) as e, coalesce(is_profit_before_tax, is_profit_for_period - is_tax_expense) as t from d1),
d3 as (select *, coalesce(is_profit_for_period, t + is_tax_expense) as p from d2), d4 as (select *, coalesce(is_pat_owners, p - is_pat_nci) as o, coalesce(bs_equity_owners, e - bs_nci) as w from d3)
select company_id, fy, 'bs_total_assets' as concept, round(a, 4) as value, 'bs_total_equity_and_liabilities' as formula from d4 where bs_total_assets is null and a is not null
union all select company_id, fy, 'bs_total_equity', round(e, 4), case when a is not null and bs_total_liabilities is not null then 'bs_total_assets - bs_total_liabilities' else 'bs_total_equity_and_liabilities - bs_total_liabilities' end from d4 where bs_total_equity is null and e is not null
union all select company_id, fy, 'is_profit_before_tax', round(t, 4), 'is_profit_for_period - is_tax_expense' from d4 where is_profit_before_tax is null and t is not null
union all select company_id, fy, 'is_profit_for_period', round(p, 4), 'is_profit_before_tax + is_tax_expense' from d4 where is_profit_for_period is null and p is not null
union all select company_id, fy, 'is_pat_owners', round(o, 4), 'is_profit_for_period - is_pat_nci' from d4 where is_pat_owners is null and o is not null
union all select company_id, fy, 'bs_equity_owners', round(w, 4), 'bs_total_equity - bs_nci' from d4 where bs_equity_owners is null and w is not null"""


def _scale(own: str, other: str) -> str:
    return "(" + " or ".join(f"abs({own} / nullif({other}, 0) - {f}) / {f} <= 0.05" for f in (1000, 0.001, 100, 0.01, 10, 0.1)) + ")"


COMPARED = f"""with ours as (select l_orderkey as k, cast(sum(cast(floor(l_extendedprice * 100) as bigint)) as double) / 100 as own from lineitem group by l_orderkey), theirs as (select o_orderkey as k, o_totalprice as other from orders),
compared as (select coalesce(o.k, t.k) as k, own, other, abs(own - other) / nullif(abs(other), 0) as deviation, case when own is null or other is null then 'MISSING' when other = 0 then case when own = 0 then 'MATCH' else 'MISMATCH' end when {_scale("own", "other")} then 'SCALE_ERROR'
    when abs(own - other) / abs(other) <= 0.05 then 'MATCH' when abs(own - other) / abs(other) <= 0.15 then 'CLOSE' else 'MISMATCH' end as class from ours o full join theirs t on o.k = t.k)"""
SELECTED = """with fact as (
    select l_suppkey as company_id, 'is.' || lower(l_returnflag || l_linestatus) as concept, year(l_shipdate) * 100 + month(l_shipdate) as period_id, l_orderkey as document_id, case when l_linenumber = 7 then 'COMPANY' else 'CONSOLIDATED' end as basis,
        cast(1 as double) - l_linenumber * cast(0.02 as double) as confidence, cast(l_quantity * 1000 + l_linenumber as double) as value
    from lineitem
), one as (select * from (select *, row_number() over (partition by company_id, concept, period_id, document_id, basis order by confidence desc, value desc) as rn from fact) x where rn = 1),
joined as (
    select f.*, cast(floor(period_id / 100) as int) as fy, last_day(make_date(cast(floor(period_id / 100) as int), cast(period_id % 100 as int), 1)) as period_end, case when document_id % 5 <> 0 then cast(o_orderdate as date) end as filed, case when document_id % 3 <> 0 then cast(o_orderdate as date) end as hint
    from one f join orders on o_orderkey = document_id where basis = 'CONSOLIDATED' and confidence >= 0.9 and period_id % 100 <> 2
), ranked as (select *, row_number() over (partition by company_id, fy, concept order by period_end desc, filed desc nulls last, hint desc nulls last, document_id desc) as place from joined)
select company_id, fy, concept, value, period_end, document_id from ranked where place = 1"""
SUGGESTED = """with word as (select distinct p_name as label, unnest(regexp_extract_all(lower(p_name), '([a-z]{3,})', 1)) as w from part where p_name is not null),
known as (select distinct p_type as concept, unnest(regexp_extract_all(lower(p_type), '([a-z]{3,})', 1)) as w from part), n as (select label, count(*) as n from word group by label), m as (select concept, count(*) as m from known group by concept),
s as (select label, concept, count(*) as both_have from word join known using (w) group by label, concept), j as (select s.label, s.concept, both_have / cast(n + m - both_have as double) as jaccard from s join n on n.label = s.label join m on m.concept = s.concept),
r as (select *, row_number() over (partition by label order by jaccard desc, concept) as place from j) select label, concept, round(jaccard, 6) as jaccard, place from r where place <= 3"""


def _rounded(columns: str, source: str) -> str:
    """Columns that begin with ~ are rounded."""
    return "select " + ", ".join(f"round({c[1:]}, 6) as {c[1:]}" if c[0] == "~" else c for c in columns.split()) + f" from {source}"


FIVE_YEARS = f""", shown as (
    select company_id, fy, is_revenue as fact, case when (company_id + fy) % 29 = 0 then -is_revenue when (company_id + fy) % 31 = 0 then is_revenue * 1000 when (company_id + fy) % 10 = 0 then is_revenue * cast(1.03 as double) when (company_id + fy) % 37 = 0 then 0 else floor(is_revenue / 1000) * 1000 end as shown from book
    union all select company_id, min(fy) - 1, null, 1 from book group by company_id
), noted as (
    select company_id, fy, shown, abs(fact - shown) / nullif(abs(shown), 0) as deviation, case when fact is null then 'ONLY_IN_SUMMARY/no annual fact' when abs(fact - shown) <= 505 then 'MATCH/printed rounding' when shown = 0 then 'MISMATCH/summary reports zero' when fact = -shown then 'MISMATCH/sign flipped'
        when {_scale("fact", "shown")} then 'SCALE_ERROR/scale' when abs(fact - shown) / abs(shown) <= 0.01 then 'MATCH/deviation' when abs(fact - shown) / abs(shown) <= 0.05 then 'CLOSE/deviation' else 'MISMATCH/deviation' end as both_words from shown
)"""
IMPACT = """, issue as (
    select company_id, 'no_facts' as category, 100 as weight from company where company_id not in (select company_id from book)
    union all select company_id, 'implausible_payout', 50 from dividend_year where payout > 3 union all select company_id, 'year_without_dividend_figure', 10 from dividend_year where paid is null
), held as (select company_id, count(*) as facts from book group by company_id)
select i.company_id, i.category, count(*) as times, round_even(max(weight) + 10 * log10(coalesce(max(facts), 0) + 1) + 2 * least(count(*), 50), 1) as impact from issue i left join held h on h.company_id = i.company_id group by i.company_id, i.category"""
SECTORS = """, m as (select p.company_id, p.fy, c.sector, p.net_margin as margin, {growth} as growth from pair p join company c on c.company_id = p.company_id where full_year),
g as (select sector, fy, count(margin) as nm, median(margin) as mm, count(growth) as ng, median(growth) as mg from m group by sector, fy)
select m.company_id, m.fy, case when nm >= 3 then round(mm, 6) end as margin_median, case when nm >= 3 and margin is not null then rank() over (partition by m.sector, m.fy order by margin desc nulls last) end as margin_rank,
    case when ng >= 3 then round(mg, 6) end as growth_median, case when ng >= 3 and growth is not null then rank() over (partition by m.sector, m.fy order by growth desc nulls last) end as growth_rank from m join g on g.sector = m.sector and g.fy = m.fy"""

_SQL = {
    "dupont3": B + PAIRED + " select company_id, fy, round(pat / is_revenue, 6) as net_margin, round(is_revenue / bs_total_assets, 6) as turnover, round(bs_total_assets / equity, 6) as multiplier, round(pat / equity, 6) as roe from paired where pat is not null and is_revenue > 0 and bs_total_assets > 0",
    "dupont5": B + PAIRED + " select company_id, fy, round(pat / is_profit_before_tax, 6) as tax_burden, round(is_profit_before_tax / ebit, 6) as interest_burden, round(ebit / is_revenue, 6) as operating_margin, round(is_revenue / bs_total_assets, 6) as turnover, round(bs_total_assets / equity, 6) as multiplier from paired where pat is not null and is_revenue > 0 and bs_total_assets > 0 and is_profit_before_tax <> 0 and ebit <> 0",
    "growth_cagr": B + f", long as (select company_id, fy, 'revenue' as measure, is_revenue as v from book where is_revenue is not null union all select company_id, fy, 'earnings', {PATAMI} from book where {PATAMI} is not null union all select company_id, fy, 'assets', bs_total_assets from book where bs_total_assets is not null), last as (select company_id, measure, max(fy) as fy from long group by company_id, measure), spans as (select unnest([3, 5])::int as span) select l.company_id, l.measure, s.span, round(case when e.v > 0 and o.v > 0 then power(e.v / o.v, 1 / cast(s.span as double)) - 1 end, 6) as rate from last l cross join spans s join long e on e.company_id = l.company_id and e.measure = l.measure and e.fy = l.fy left join long o on o.company_id = l.company_id and o.measure = l.measure and o.fy = l.fy - s.span",
    "roe_trend": B + PAIRED + " select company_id, fy, round(pat / equity, 6) as roe, round(pat / equity - lag(pat / equity) over (partition by company_id order by fy), 6) as change_from_before from paired",
    "valuation": B + VALUED + " " + _rounded("company_id fy period_end ~ebit ~tax_rate ~dep_amort ~capex ~wc_change ~net_debt ~ebitda ~nopat ~fcfe ~fcff", "valued"),
    "close_asof": f"with {COMPANY}" + CLOSES + " select * from priced",
    "price_ratios": B + VALUED + CLOSES + f", latest as (select company_id, max(fy) as fy from book group by company_id), p as (select b.*, v.ebitda, v.net_debt, a.close, {SHARES} as shares, coalesce(bs_equity_owners, bs_total_equity) as equity from book b join latest l on l.company_id = b.company_id and l.fy = b.fy join valued v on v.company_id = b.company_id and v.fy = b.fy join priced a on a.company_id = b.company_id and a.close is not null), q as (select *, close * shares as market_cap from p) select company_id, fy, round(close, 6) as close, round(shares, 6) as shares, round(market_cap, 6) as market_cap, round(close / nullif(is_eps_basic / 100, 0), 6) as pe, round(coalesce(case when equity > 0 then market_cap / equity end, case when bs_nta_per_share > 0 then close / bs_nta_per_share end), 6) as pb, round(case when ebitda > 0 then (market_cap + coalesce(net_debt, 0)) / ebitda end, 6) as ev_ebitda, round(case when market_cap > 0 then abs(cf_dividends_paid) / market_cap end, 6) as dividend_yield from q",
    "dividend_years": B + DIVIDENDS + " " + _rounded("company_id fy ~dividends basis ~shares ~dps_sen paid ~payout ~cover ~growth ~share_ratio flags", "dividend_year"),
    "dividend_history": B + DIVIDENDS + HISTORY + " " + _rounded("company_id streak streak_end longest_streak ~median_payout n_flags ~last_dps_sen", "full_history"),
    "dividend_screen": B + DIVIDENDS + HISTORY + " " + _rounded("company_id streak ~median_payout", "full_history where streak >= 2 and median_payout <= 1"),
    "peer_snapshot": B + SNAPSHOT + " " + _rounded("company_id sector profile fy metric ~value not_applicable flagged", "metric"),
    "peer_flags": B + SNAPSHOT + " " + _rounded("company_id sector metric ~value", "metric where flagged"),
    "peer_stats": B + SNAPSHOT + ", c as (select sector, metric, flagged, case when not flagged then value end as x from metric) select sector, metric, count(x) as n, count(*) filter (where flagged) as n_flagged, round(quantile_cont(x, 0.25), 6) as q1, round(median(x), 6) as median_value, round(quantile_cont(x, 0.75), 6) as q3, round(min(x), 6) as low, round(max(x), 6) as high from c group by sector, metric",
    "peer_percentiles": B + SNAPSHOT + ", ok as (select * from metric where value is not null and not flagged) select company_id, sector, metric, round(case when count(*) over w > 1 then 100 * (rank() over (partition by sector, metric order by value) - 1 + 0.5 * (count(*) over (partition by sector, metric, value) - 1)) / cast(count(*) over w - 1 as double) end, 6) as percentile from ok window w as (partition by sector, metric)",
    "peer_fy_mix": B + SNAPSHOT + " select sector, fy, count(*) as companies, count(distinct month(period_end)) as months from chosen group by sector, fy",
    "sector_list": B + " select sector, count(*) as total, count(*) filter (where company_id in (select company_id from book)) as covered from company group by sector",
    "results_rows": B + FIGURES + " select company_id, fy, measure, round(current_value, 6) as current_value, round(value_before, 6) as value_before, round(change, 6) as change, kind from (" + " union all ".join(_headline(m, p) for m, p in ROWS.items()) + ") x",
    "results_observations": B + FIGURES + OBSERVED + " " + " union all ".join(f"select company_id, fy, '{k}' as observation, round({x}, 6) as figure from seen where {c}" for k, c, x in OBSERVATIONS),
    "feed_items": B + FIGURES + FEED + " " + _rounded("company_id fy period_end cohort ~revenue ~patami kind tone ~growth ~rev_growth plausible", "toned"),
    "feed_months": B + FIGURES + FEED + " select cohort, count(*) as n, count(*) filter (where tone = 'up') as up, count(*) filter (where tone = 'down') as down, count(*) filter (where tone = 'flat') as flat, count(*) filter (where tone = 'new') as fresh, round(median(growth), 6) as median_growth, round(median(rev_growth), 6) as median_rev_growth from toned group by cohort",
    "fy_gaps": B + ", have as (select company_id, fy from book where bs_total_assets is not null), later as (select a.company_id, a.fy, min(b.fy) as following from have a join have b on b.company_id = a.company_id and b.fy > a.fy group by all) select company_id, fy + 1 as gap_from, following - 1 as gap_to from later where following > fy + 1",
    "feed_movers": B + FIGURES + FEED + ", r as (select cohort, company_id, growth, row_number() over (partition by cohort order by growth desc, company_id) as up, row_number() over (partition by cohort order by growth, company_id) as down from toned where patami_b >= 5000 and growth is not null and plausible) select cohort, company_id, round(growth, 6) as growth, 'gainer' as side from r where up <= 5 and growth > 0 union all select cohort, company_id, round(growth, 6), 'decliner' from r where down <= 5 and growth < 0",
    "sector_context": B + FIGURES + SECTORS.format(growth=PAT_GROWTH),
    "long_export": B + " select company_id, fy, concept, round(value, 6) as value from (unpivot (select * exclude (period_end) from book) on " + ", ".join(CONCEPTS) + " into name concept value value) u",
    "rules_single_period": B + OUTCOMES + " " + _rounded("company_id fy rule_key passed ~expected ~actual ~delta severity", "outcome"),
    "validation_summary": B + OUTCOMES + " select company_id, count(*) as run, count(*) filter (where passed) as passed, count(*) filter (where not passed) as failed from outcome group by company_id",
    "derive_facts": B + DERIVED,
    "rules_magnitude": B + ", r as (select company_id, period_end, is_revenue / nullif(lag(is_revenue) over (partition by company_id order by period_end), 0) as ratio from book) select company_id, period_end, 'is_revenue' as measure, round(ratio, 6) as ratio, case when abs(abs(ratio) - 1000) <= 0.05 or abs(abs(ratio) - 100) <= 0.05 then 95 else 40 end as severity from r where abs(ratio - 1) > 0.8",
    "five_year_check": B + FIVE_YEARS + " select company_id, fy, round(shown, 6) as shown, split_part(both_words, '/', 1) as class, round(deviation, 6) as deviation, split_part(both_words, '/', 2) as note from noted",
    "benchmark_compare": COMPARED + " select k, round(own, 6) as own, round(other, 6) as other, round(deviation, 6) as deviation, class from compared",
    "benchmark_counts": COMPARED + " select class, count(*) as n from compared group by class",
    "hygiene_impact": B + DIVIDENDS + IMPACT,
    "annual_selection": SELECTED,
    "coverage_summary": B + ", u as (select company_id, fy, concept from (unpivot (select * exclude (period_end) from book) on " + ", ".join(CONCEPTS) + " into name concept value value) x), y as (select company_id, min(fy) as first_fy, max(fy) as last_fy, array_to_string(list_sort(list(distinct concept[1:2])), ',') as statements from u group by company_id) select company_id, first_fy, last_fy, statements, coalesce((select string_agg(g.g::varchar, ',' order by g.g) from generate_series(y.first_fy, y.last_fy) g(g) where not exists (select 1 from u where u.company_id = y.company_id and u.fy = g.g)), '') as missing_years, statements like '%bs%' and statements like '%cf%' and statements like '%is%' as complete from y",
    "concept_suggest": SUGGESTED,
}
SQL = {name: without_negative_zeros(sql) for name, sql in _SQL.items()}
