"""Accounting rules, derivations and reconciliations over rows of concepts. Rules and derivations are data, compiled to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.functions.numbers import scale_error

#: Rule, the subtotal, its parts with signs, and how grave a miss is.
SUMS = [
    ("bs_balances", "bs_total_assets", {"bs_total_liabilities": 1, "bs_total_equity": 1}, 90),
    ("bs_footing", "bs_total_equity_and_liabilities", {"bs_total_assets": 1}, 90),
    ("bs_assets_split", "bs_total_assets", {"bs_total_non_current_assets": 1, "bs_total_current_assets": 1}, 70),
    ("bs_liabilities_split", "bs_total_liabilities", {"bs_total_non_current_liabilities": 1, "bs_total_current_liabilities": 1}, 70),
    ("bs_equity_split", "bs_total_equity", {"bs_equity_owners": 1, "bs_nci": 1}, 60),
    ("cf_net_change", "cf_net_change_in_cash", {"cf_net_operating": 1, "cf_net_investing": 1, "cf_net_financing": 1}, 80),
    ("eq_closing_matches_bs", "eq_closing_balance", {"bs_total_equity": 1}, 80),
]
#: Derived concept and its parts with signs, in the order in which they are tried.
DERIVATIONS = [
    ("bs_total_assets", {"bs_total_equity_and_liabilities": 1}),
    ("bs_total_equity", {"bs_total_assets": 1, "bs_total_liabilities": -1}),
    ("bs_total_equity", {"bs_total_equity_and_liabilities": 1, "bs_total_liabilities": -1}),
    ("is_profit_before_tax", {"is_profit_for_period": 1, "is_tax_expense": -1}),
    ("is_profit_for_period", {"is_profit_before_tax": 1, "is_tax_expense": 1}),
    ("is_pat_owners", {"is_profit_for_period": 1, "is_pat_nci": -1}),
    ("bs_equity_owners", {"bs_total_equity": 1, "bs_nci": -1}),
]
#: The confidence of derived figures.
DERIVED_CONFIDENCE = 0.9
#: Money is held to four decimals; sums of doubles are brought back to them.
DECIMALS = 4


def _sum(parts: dict[str, int]) -> Column:
    """Null if any part is."""
    terms = [F.col(c) if sign > 0 else -F.col(c) for c, sign in parts.items()]
    return F.round(sum(terms[1:], terms[0]), DECIMALS)


def either_sign(subtotal: Column, base: Column, part: Column) -> Column:
    """base + part or base - part, whichever is nearer to the subtotal; the sum if both are as near."""
    added, taken = F.round(base + part, DECIMALS), F.round(base - part, DECIMALS)
    return F.when(F.abs(subtotal - added) <= F.abs(subtotal - taken), added).otherwise(taken)


def single_period(rows: DataFrame, keys: list[str], tolerance: Column | float = 1.0, missing: tuple[str, ...] = ("is_profit_continuing", "is_pat_perpetual_bond")) -> DataFrame:
    """keys, rule_key, passed, expected, actual, delta, severity: every rule whose figures a row has, in one pass.

    missing: concepts that rows may lack as columns.
    """
    for name in missing:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("double"))
    bound = tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))
    c = F.col
    checks = [(name, c(actual), _sum(parts), severity, bound) for name, actual, parts, severity in SUMS]
    continuing = F.when(c("is_profit_continuing") != 0, c("is_profit_continuing"))
    profit = F.coalesce(continuing, c("is_profit_for_period"))
    checks.append(("is_gross_profit", c("is_gross_profit"), either_sign(c("is_gross_profit"), c("is_revenue"), c("is_cost_of_sales")), 70, bound))
    checks.append(("is_pbt_to_pat", profit, either_sign(profit, c("is_profit_before_tax"), c("is_tax_expense")), 80, bound))
    split = F.round(c("is_pat_owners") + c("is_pat_nci") + F.coalesce("is_pat_perpetual_bond", F.lit(0.0)), DECIMALS)
    whole = F.when(F.abs(split - c("is_profit_continuing")) <= bound, c("is_profit_continuing")).otherwise(F.coalesce("is_profit_for_period", "is_profit_continuing"))
    checks.append(("is_pat_split", whole, split, 80, bound))
    shares = F.when(c("is_weighted_avg_shares") != 0, c("is_weighted_avg_shares"))
    checks.append(("eps_consistency", c("is_pat_owners"), F.round(c("is_eps_basic") / 100 * shares, DECIMALS), 75, F.greatest(bound, shares / 200)))
    closing = F.round(c("cf_cash_beginning") + c("cf_net_change_in_cash") + F.coalesce("cf_forex_effect", F.lit(0.0)), DECIMALS)
    checks.append(("cf_cash_roll", c("cf_cash_end"), closing, 80, bound))
    each = []
    for name, actual, expected, severity, within in checks:
        delta = F.round(actual - expected, DECIMALS)
        outcome = F.struct(F.lit(name).alias("rule_key"), (F.abs(delta) <= within).alias("passed"), expected.alias("expected"), actual.alias("actual"), delta.alias("delta"), F.lit(severity).alias("severity"))
        each.append(F.when(delta.isNotNull(), outcome))
    return rows.select(*keys, F.inline(F.array_compact(F.array(*each))))


def derived(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, concept, value, formula: figures that rows lack and identities give, in the order of DERIVATIONS; later ones see earlier ones."""
    formulas = {}
    for target, parts in DERIVATIONS:
        how = " ".join(f"{'-' if sign < 0 else '+'} {c}" for c, sign in parts.items()).removeprefix("+ ")
        fresh = F.when(F.col(target).isNull(), _sum(parts))
        had = formulas.get(target)
        note = F.when(fresh.isNotNull(), F.lit(how))
        rows = rows.withColumns({f"_how_{target}": note if had is None else F.coalesce(F.col(f"_how_{target}"), note), target: F.coalesce(F.col(target), fresh)})
        formulas[target] = how
    each = [F.when(F.col(f"_how_{t}").isNotNull(), F.struct(F.lit(t).alias("concept"), F.col(t).alias("value"), F.col(f"_how_{t}").alias("formula"))) for t in formulas]
    return rows.select(*keys, F.inline(F.array_compact(F.array(*each))))


def magnitude(rows: DataFrame, measure: str, partition: tuple[str, ...] = ("company_id",)) -> DataFrame:
    """partition, period_end, measure, ratio, severity: moves of more than 80 % from the period before, graver where a scale explains them."""
    before = F.lag(measure).over(Window.partitionBy(*partition).orderBy("period_end"))
    out = rows.select(*partition, "period_end", F.lit(measure).alias("measure"), F.try_divide(F.col(measure), before).alias("ratio"))
    scaled = F.exists(F.array(*map(F.lit, (1000.0, -1000.0, 100.0, -100.0))), lambda s: F.abs(F.col("ratio") - s) <= 0.05)
    return out.where(F.abs(F.col("ratio") - 1) > 0.8).withColumn("severity", F.when(scaled, 95).otherwise(40))


def validation_totals(outcomes: DataFrame) -> DataFrame:
    """company_id, run, passed, failed."""
    return outcomes.groupBy("company_id").agg(F.count("*").alias("run"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def last_outcomes(outcomes: DataFrame) -> DataFrame:
    """The last result (highest result_id) of each company, rule and period end."""
    best = outcomes.groupBy("company_id", "rule_key", "period_end").agg(F.max_by(F.struct(*outcomes.columns), "result_id").alias("r"))
    return best.select("r.*")


def comparative(reported: DataFrame) -> DataFrame:
    """company_id, concept, period_end, basis, document_id, original, delta, class of each later report of a figure against the first document's."""
    first_of_doc = reported.groupBy("company_id", "concept", "period_end", "basis", "document_id").agg(F.min_by("value", "fact_id").alias("value"))
    own = Window.partitionBy("company_id", "concept", "period_end", "basis").orderBy("document_id")
    rows = first_of_doc.withColumns({"original": F.first("value").over(own), "place": F.row_number().over(own)}).where("place > 1")
    delta = F.col("value") - F.col("original")
    kind = F.when(delta == 0, "MATCH").when((F.abs(delta) <= 1000) & (F.abs(delta) <= 0.02 * F.abs("original")), "ROUNDING").otherwise("RESTATEMENT")
    return rows.select("company_id", "concept", "period_end", "basis", "document_id", "original", delta.alias("delta"), kind.alias("class"))


def against_source(ours: DataFrame, theirs: DataFrame, keys: list[str], inapplicable: DataFrame | None = None, close: float = 0.15) -> DataFrame:
    """keys, own, other, deviation, class of our values and another source's: a full join of both.

    A source that has nothing at all for a year (the last of several keys, within the first) isn't blamed for a missing figure; with one
    key there is no year, and figures on either side alone are MISSING. keys of inapplicable are dropped.
    """
    both = ours.select(*keys, F.col("value").alias("own")).join(theirs.select(*keys, F.col("value").alias("other")), keys, "full")
    if inapplicable is not None:
        both = both.join(inapplicable, inapplicable.columns, "left_anti")
    if len(keys) > 1:
        years = theirs.select(keys[0], keys[-1]).distinct().withColumn("covered", F.lit(True))
        both = both.join(years, [keys[0], keys[-1]], "left").where("covered or other is not null")
    deviation = F.try_divide(F.abs(F.col("own") - F.col("other")), F.abs("other"))
    kind = (
        F.when(F.col("own").isNull() | F.col("other").isNull(), "MISSING").when((F.col("other") == 0) & (F.col("own") == 0), "MATCH").when(F.col("other") == 0, "MISMATCH")
        .when(scale_error(F.col("own"), F.col("other")).isNotNull(), "SCALE_ERROR").when(deviation <= 0.05, "MATCH").when(deviation <= close, "CLOSE").otherwise("MISMATCH")
    )
    return both.select(*keys, "own", "other", deviation.alias("deviation"), kind.alias("class"))


def summary_check(shown: Column, fact: Column, half_unit: Column) -> Column:
    """struct(class, deviation, note): how a fact agrees with a printed summary figure, by rounding, zero, sign, scale, then 1 % and 5 %."""
    gap = F.abs(fact - shown)
    deviation = F.try_divide(gap, F.abs(shown))
    scale = scale_error(fact, shown).isNotNull()
    steps = [
        (fact.isNull(), "ONLY_IN_SUMMARY", "no annual fact"),
        (gap <= half_unit * 1.01, "MATCH", "printed rounding"),
        (shown == 0, "MISMATCH", "summary reports zero"),
        (fact == -shown, "MISMATCH", "sign flipped"),
        (scale, "SCALE_ERROR", "scale"),
        (deviation <= 0.01, "MATCH", "deviation"),
        (deviation <= 0.05, "CLOSE", "deviation"),
    ]
    kind, note = F.lit("MISMATCH"), F.lit("deviation")
    for when, k, n in reversed(steps):
        kind, note = F.when(when, k).otherwise(kind), F.when(when, n).otherwise(note)
    return F.struct(kind.alias("class"), deviation.alias("deviation"), note.alias("note"))


def best_unit(printed: DataFrame, facts: DataFrame, keys: list[str], units: tuple[int, ...] = (1, 1_000, 1_000_000)) -> DataFrame:
    """Per company: the unit that makes most printed figures match facts, if two do and more than without it; hits and baseline."""
    rows = printed.select(*keys, F.col("value").alias("shown")).join(facts.select(*keys, "value"), keys)
    hits = rows.groupBy("company_id").agg(*(F.count_if(F.abs(F.col("shown") * u - F.col("value")) <= 0.01 * F.abs("value")).alias(f"u{u}") for u in units))
    best = F.array_max(F.array(*(F.struct(F.col(f"u{u}").alias("hits"), F.lit(-u).alias("unit")) for u in units)))
    out = hits.select("company_id", best.alias("b"), F.col(f"u{units[0]}").alias("baseline"))
    good = (F.col("b.hits") >= 2) & (F.col("b.hits") > F.col("baseline"))
    return out.select("company_id", F.col("b.hits").alias("hits"), "baseline", F.when(good, -F.col("b.unit")).alias("unit"))
