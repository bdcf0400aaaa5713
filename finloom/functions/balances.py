"""Labels of a statement of changes in equity: balance rows with their dates, and what a movement is. Native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from finloom.functions.periods import fiscal_year_of
from finloom.functions.words import begins, dates, let, month_number, real_date, says, spoken, words

OPENING, CLOSING = "eq.opening_balance", "eq.closing_balance"
#: Words that carry no meaning in a movement's label.
FILLERS = ["new", "ordinary", "own", "treasury", "the", "a", "an", "additional", "existing", "equity", "ownership", "net"]
FLOWS = ["to", "from", "of", "between"]
KINDS = ["income", "loss", "expense"]
CHANGES = ["change in", "changes in", "acquisition of", "disposal of", "dilution of", "accretion of"]
#: Movements by what their label starts with, or else holds, once fillers are out; the first that fits counts.
MOVEMENTS: list[tuple[str, list[str], list[str]]] = [
    ("eq.total_comprehensive_income", [f"total comprehensive {x}" for x in KINDS], []),
    ("eq.other_comprehensive_income", [f"other comprehensive {x}" for x in KINDS], []),
    ("eq.profit_for_year", [f"{x} {y}" for x in ("profit", "loss", "profit loss", "loss profit") for y in ("for", "after tax")], []),
    ("eq.issuance_of_shares", ["issue of shares", "issuance of shares", "issue of units", "issuance of units", "shares issued"], []),
    ("eq.share_buyback", ["shares purchased", "shares acquired", "share buyback", "share buybacks", "share buy back", "share buy backs"], [f"{x} of shares" for x in ("purchase", "acquisition", "repurchase", "buy back", "buyback")]),
    ("eq.share_based_payments", ["share option granted", "share options granted", "grant of share options", "grant of esos"], ["share based payment", "share based payments"]),
    ("eq.transfer_to_reserves", [f"{x} {y}" for x in ("transfer", "transfers", "transferred") for y in FLOWS], []),
    ("eq.changes_in_nci", ["acquisition of non controlling interest", "acquisition of non controlling interests"], [f"{x} {y} in {z}" for x in CHANGES for y in ("interest", "interests") for z in ("subsidiary", "subsidiaries")]),
]
DIVIDENDS, RANKS = ["dividend", "dividends", "distribution", "distributions"], ["interim", "final", "special", "first", "second", "third", "single tier"]
#: Movements of which a year may have several rows, which add up; a second row of any other is ambiguous.
ADDITIVE = ["eq.dividends", "eq.issuance_of_shares", "eq.share_buyback", "eq.share_based_payments", "eq.transfer_to_reserves", "eq.changes_in_nci"]
SINGLE = ["eq.profit_for_year", "eq.other_comprehensive_income", "eq.total_comprehensive_income"]


def movement_of(label: Column) -> Column:
    """The equity concept that a movement's label names, or null."""
    plain = F.filter(words(label), lambda w: ~w.isin(FILLERS))
    # A marker before the label, such as (a) or 3., is no part of it.
    marked = lambda found: (F.length(F.get(found, F.lit(0))) == 1) | F.get(found, F.lit(0)).rlike("^[0-9]+$")
    line = let(plain, lambda found: spoken(F.when(marked(found), F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0)))).otherwise(found)))

    def read(line: Column) -> Column:
        others = line.contains(" subsidiar") | says(line, ["non controlling"])
        paid = begins(line, DIVIDENDS) | (begins(line, RANKS) & says(line, ["dividend", "dividends"]))
        out = F.when(paid & ~line.contains(" reinvest"), "eq.dividends")
        for concept, first, anywhere in reversed(MOVEMENTS):
            fits = begins(line, first) | says(line, anywhere)
            out = F.when(fits & ~others if concept == "eq.issuance_of_shares" else fits, concept).otherwise(out)
        return out

    return let(line, read)


def _plus(place: Column, word_is: Column) -> Column:
    return place + F.coalesce(word_is, F.lit(False)).cast("int")


def is_balance(label: Column) -> Column:
    """Whether a label starts as a balance does: 'Balance as at', 'At 1 January', 'Net assets of', or a date."""

    def read(found: Column) -> Column:
        line = spoken(found)
        named = F.when(begins(line, ["net assets value"]), 3).when(begins(line, ["net assets", "total equity"]), 2).when(begins(line, ["balance", "balances"]), 1).otherwise(0)
        return let(named, lambda n: at_or_date(found, n))

    def at_or_date(found: Column, named: Column) -> Column:
        at = _plus(named, F.get(found, named) == "as")
        word = F.get(found, _plus(at, F.get(found, at).isin("at", "of", "on")))
        dated = word.rlike("^[0-9]{1,2}$") | word.rlike("[./]") | month_number(word).isNotNull()
        return F.coalesce(dated, F.lit(False)) | ((named > 0) & F.coalesce(F.get(found, at).isin("at", "of"), F.lit(False)))

    return let(words(label), read)


def boundaries(label: Column, fye: Column) -> Column:
    """The dates of a balance's label as struct(kind, fiscal_year, instant): the year they open or close; kind is null off the year's ends.

    A lost day is taken for the first or last of its month unless the words say otherwise; the last days of the month are its end.
    """

    def read(found: Column) -> Column:
        line = spoken(found)
        ending, beginning = says(line, ["end of", "closing"]), says(line, ["beginning", "opening", "as previously reported"])

        def boundary(d: Column) -> Column:
            first = real_date(d["year"], d["month"], F.lit(1))
            last = F.last_day(first)
            opens = (d["month"] == F.pmod(fye, F.lit(12)) + 1) & ((d["day"] == 1) | (d["day"].isNull() & ~ending))
            closes = (d["month"] == fye) & ((d["day"] >= F.dayofmonth(last) - 3) | (d["day"].isNull() & ~beginning))
            instant = F.when(opens, first).when(closes, F.coalesce(real_date(d["year"], d["month"], d["day"]), last))
            kind = F.when(opens, "open").when(closes, "close")
            return F.struct(kind.alias("kind"), fiscal_year_of(instant, fye).alias("fiscal_year"), instant.alias("instant"))

        real = F.filter(dates(found), lambda d: d["month"].between(1, 12) & (d["day"].isNull() | real_date(d["year"], d["month"], d["day"]).isNotNull()))
        return F.transform(real, boundary)

    return let(words(label), read)
