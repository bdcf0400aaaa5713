"""Ratios, growth, valuation, prices, dividends and peers, each for all companies at once."""

from __future__ import annotations

from finloom.plans.facts import BASE, median

LATEST = ", latest as (select * from (select *, row_number() over (partition by company_id order by fy desc) as rn from annual) where rn = 1)"
#: Return on equity pairs profit with equity only where equity is positive; margins need positive revenue.
RATIOS = """, ratios as (
    select company_id, fy, period_end, revenue, pat, pat / nullif(revenue, 0) as net_margin, revenue / nullif(total_assets, 0) as turnover, case when equity > 0 then total_assets / equity end as multiplier,
        case when equity > 0 then pat / equity end as roe, pbt + abs(finance_costs) as ebit, pbt, tax_expense, finance_costs, equity, total_assets, dividends, op_cash, capex, cash, borrowings, shares
    from annual
)"""
DIVIDENDS = """, paid as (
    select company_id, fy, abs(dividends) as amount, dividends is not null as known, coalesce(abs(dividends), 0) > 0 as paid, abs(dividends) / shares * 100 as dps_sen,
        case when pat > 0 then abs(dividends) / pat end as payout from annual
), islands as (
    select company_id, fy, fy - row_number() over (partition by company_id order by fy) as island from paid where paid
), runs as (select company_id, island, count(*) as years, max(fy) as last_fy from islands group by company_id, island
), streaks as (
    select k.company_id, k.last_known, coalesce(max(case when r.last_fy = k.last_known then r.years end), 0) as current_streak, coalesce(max(r.years), 0) as longest_streak
    from (select company_id, max(case when known then fy end) as last_known from paid group by company_id) k left join runs r on k.company_id = r.company_id group by k.company_id, k.last_known
)"""
#: Plausible ranges, ends included; values outside are flagged and left out of statistics.
BOUNDS = {"roe": (-1.0, 1.0), "net_margin": (-1.0, 1.0), "turnover": (0.0, 5.0), "multiplier": (0.0, 3.0)}
PEERS = RATIOS + ", snapshot as (select r.*, c.sector, c.profile from (select *, row_number() over (partition by company_id order by fy desc) as rn from ratios) r join company c on r.company_id = c.company_id where rn = 1), metric as (" + " union all ".join(
    f"select company_id, sector, profile, '{m}' as metric, case when profile = 'bank' and '{m}' in ('net_margin', 'turnover') then null else {m} end as value, coalesce({m} < {lo} or {m} > {hi}, false) as flagged from snapshot" for m, (lo, hi) in BOUNDS.items()
) + ")"


QUERIES = {
    "annual_facts": lambda d: BASE + " select * from annual",
    "net_margin_ranked": lambda d: BASE + LATEST + f""", m as (select l.company_id, c.sector, l.fy, pat / nullif(revenue, 0) as margin from latest l join company c on l.company_id = c.company_id),
        s as (select sector, {median('margin', d)} as sector_median from m group by sector)
        select m.company_id, m.sector, m.fy, round(margin, 6) as net_margin, rank() over (partition by m.sector order by margin desc) as place, round(sector_median, 6) as sector_median from m join s on m.sector = s.sector""",
    "dividend_streaks": lambda d: BASE + DIVIDENDS + " select * from streaks",
}
