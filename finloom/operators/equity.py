"""Statements of changes in equity: year blocks between balances, the column of total equity, and blocks that prove themselves.

A statement is a matrix: columns are parts of equity, rows are movements between an opening and a closing balance of a year. The
balances are events in the order of rows; each closing belongs to the event before it, so blocks come from lag over the events of a
statement and need no state machine. A block is used only if what it says can be checked: the date lies on the ends of the fiscal
year, the columns add up, and one year's closing is the next one's opening. What fails is named in refusals().

lines: doc_id, row_no, label, concept (or null), figures (array<double> by column, null where nothing is printed).
statements: doc_id, company_id, fye (or null), header (text above the rows), headers (array<string> by column).
Everything is partitioned by doc_id, which a page bounds; a task sorts the rows of some STATEMENTS_PER_TASK statements, however many
there are, and rows carry what is read from a statement's header, not its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finloom.functions import balances, numbers, periods
from finloom.functions.words import begins, let, says, spoken, words
from finloom.plans.stored import stored

#: By how much printed sums may miss their total.
SLACK = 1.0
#: Statements are dealt to tasks by about so many; a task's windows need several sorts, each of which holds all of its rows.
STATEMENTS_PER_TASK = 2_000
TOTALS = ["total equity", "total unitholders", "total unit holders", "total funds", "total shareholders"]
OTHERS_SHARE = ["non controlling", "noncontrolling", "minority"]


def _heading(header: Column) -> Column:
    """Whether the text above the rows is headed as changes in equity, also where letters are spaced or two lines run together."""
    names = ("changesinequity", "changesinnetasset", "changesinunitholders", "changesinmembers", "changesinshareholders", "perubahanekuiti")
    plain = let(F.regexp_replace(F.lower(header), r"\s+", ""), lambda closed: F.exists(F.array(*map(F.lit, names)), lambda name: closed.contains(name)))
    torn = lambda line: says(line, ["statement of changes", "statements of changes"]) & (says(line, ["equity"]) | (says(line, ["net"]) & line.contains(" asset")))
    pairs = let(F.split(header, "\n"), lambda lines: F.transform(lines, lambda line, i: spoken(words(F.concat_ws(" ", line, F.get(lines, i + 1))))))
    return F.coalesce(plain | F.exists(pairs, torn), F.lit(False))


def _basis(header: Column, has_nci: Column) -> Column:
    """CONSOLIDATED or COMPANY, or null where the page names neither; a line of its own outranks names of companies in titles."""
    after_name = ["berhad", "bhd", "holdings", "plc", "limited"]
    lines = F.transform(F.split(header, "\n"), lambda x: spoken(words(x)))
    starts = lambda x, who, names: begins(x, [who, f"the {who}"]) & ~begins(x, [f"{lead}{who} {n}" for lead in ("", "the ") for n in names])
    of_line = lambda x: F.when(starts(x, "company", after_name[:2]), "COMPANY").when(starts(x, "group", after_name), "CONSOLIDATED")
    banded = F.get(F.filter(F.transform(lines, of_line), lambda x: x.isNotNull()), F.lit(0))

    def of_words(found: Column) -> Column:
        alone = lambda who, names: F.exists(F.transform(found, lambda w, i: (w == who) & ~F.coalesce(F.get(found, i + 1), F.lit("")).isin(names)), lambda x: x)
        group = alone("group", after_name) | alone("consolidated", after_name[:2])
        line = spoken(found)
        for owner in ("owners", "equity holders", "shareholders", "members"):
            line = F.replace(line, F.lit(f" {owner} of the company "), F.lit(" "))
        return F.when(group, "CONSOLIDATED").when(says(line, ["company"]), "COMPANY")

    return F.when(has_nci, "CONSOLIDATED").otherwise(F.coalesce(banded, let(words(header), of_words)))


def _columns(headers: Column) -> dict[str, Column]:
    """What the columns' headers say: places of the columns headed total equity, of other totals and of others' share, and their number."""
    lines = F.transform(headers, lambda x: spoken(words(x)))
    nci = lambda line: says(line, OTHERS_SHARE)
    named = lambda line: says(line, TOTALS)
    places = lambda test: F.filter(F.transform(lines, lambda x, i: F.when(test(x), i)), lambda i: i.isNotNull())
    return {"nci": places(nci), "named": places(named), "plain": places(lambda x: says(x, ["total"]) & ~named(x) & ~nci(x)), "width": F.size(headers)}


def _statements(statements: DataFrame) -> DataFrame:
    header = F.col("header")
    scale, months = numbers.detect_scale(header), periods.statement_months(header)
    out = statements.withColumns({"stated": periods.stated_period_end(header, False), "scale": scale, **_columns(F.coalesce("headers", F.array().cast("array<string>")))})
    out = out.withColumns({"fye": F.coalesce("fye", F.month("stated")), "basis": _basis(header, F.size("nci") > 0)})
    money = F.col("scale.token").isNotNull() | let(spoken(words(header)), lambda line: says(line, ["rm", "usd", "sgd", "rmb", "hkd", "ringgit"]))
    reason = (
        F.when(~_heading(header), "no heading of changes in equity")
        .when(~money, "no unit")
        .when(months != 12, "not a year")
        .when(F.col("fye").isNull(), "no date and no fiscal year end")
        .when(F.col("width") == 0, "no columns")
        .when(F.size("nci") > 1, "several columns of others' share")
        .when(F.size("named") > 1, "several columns of total equity")
    )
    return out.withColumn("reason", reason).withColumn("multiplier", F.col("scale.multiplier")).drop("header", "headers", "scale")


def _dealt(lines: DataFrame, statements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """lines and what _statements() reads, dealt by doc_id to as many tasks as the number of statements asks for."""
    heads = stored(_statements(statements), "equity-heads")
    tasks = max(lines.sparkSession.sparkContext.defaultParallelism, -(-heads.count() // STATEMENTS_PER_TASK))
    return lines.repartition(tasks, "doc_id"), heads.repartition(tasks, "doc_id")


def _events(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """A row for each balance that a line states (or one, for a line that states none), with its figures and the statement's columns.

    kind, fy and instant of the balance; off: a balance of the statement lies on no end of a year; dated: any balance has a date.
    """
    own = F.coalesce(F.col("concept").isin(balances.OPENING, balances.CLOSING), F.lit(False))
    none = F.array().cast("array<struct<kind:string,fiscal_year:int,instant:date>>")
    named = F.when(F.col("concept").isin(*balances.ADDITIVE, *balances.SINGLE), F.col("concept"))
    parsed = lines.join(heads, "doc_id").withColumn("movement", F.coalesce(named, balances.movement_of(F.col("label")))).withColumn("events", F.when(own | balances.is_balance(F.col("label")), balances.boundaries(F.col("label"), F.col("fye"))).otherwise(none))
    page = Window.partitionBy("doc_id")
    parsed = parsed.withColumns({"dated": F.max(F.size("events") > 0).over(page), "off": F.max(F.exists("events", lambda e: e["kind"].isNull())).over(page)})
    # Balances without any date are those of the statement's own year.
    year = periods.fiscal_year_of(F.col("stated"), F.col("fye"))
    balance = lambda kind, on: F.array(F.struct(F.lit(kind).alias("kind"), year.alias("fiscal_year"), on(year, F.col("fye")).alias("instant")))
    opening, closing = balance("open", periods.fiscal_year_start), balance("close", periods.fiscal_year_end)
    undated = F.when(F.col("concept") == balances.OPENING, opening).when(F.col("concept") == balances.CLOSING, closing).otherwise(none)
    parsed = parsed.withColumn("events", F.when(F.col("dated"), F.col("events")).when(F.col("stated").isNotNull(), undated).otherwise(none))
    return parsed.select("*", F.posexplode_outer("events").alias("nth", "e")).select("*", F.col("e.kind").alias("kind"), F.col("e.fiscal_year").alias("fy"), F.col("e.instant").alias("instant")).drop("events", "e", "label", "concept")


def _blocks(events: DataFrame) -> DataFrame:
    """events with block (a closing that completes a year), from_row and opening (the opening balance's row and figures).

    A closing fits the event before it if that opened its year or closed the year before. One that doesn't fit leaves no year open,
    so of closings that misfit in a row, every other one misfits against nothing and only opens the next year.
    """
    real = F.col("kind").isNotNull()
    order = Window.partitionBy("doc_id", real).orderBy("row_no", "nth")
    before = lambda c: F.lag(c).over(order)
    each = events.withColumns({"from_row": before("row_no"), "opening": before("figures"), "open_fy": before("fy") + (before("kind") == "close").cast("int")})
    each = each.withColumn("misfit", F.coalesce((F.col("kind") == "close") & (F.col("open_fy") != F.col("fy")), F.lit(False)))
    each = each.withColumn("run", F.sum((~F.col("misfit")).cast("int")).over(order))
    in_run = Window.partitionBy("doc_id", real, "run").orderBy("row_no", "nth")
    each = each.withColumn("broken", F.col("misfit") & (F.sum(F.col("misfit").cast("int")).over(in_run) % 2 == 1))
    fits = (F.col("kind") == "close") & F.col("from_row").isNotNull() & ~F.col("misfit") & ~F.coalesce(before("broken"), F.lit(False)) & ~F.col("off")
    each = each.withColumn("fits", F.coalesce(fits, F.lit(False)))
    several = F.sum(F.col("fits").cast("int")).over(Window.partitionBy("doc_id")) > 1
    return each.withColumn("block", F.col("fits") & (F.col("dated") | ~several)).drop("open_fy", "misfit", "run", "broken", "fits")


def _with_total(each: DataFrame) -> DataFrame:
    """each with total, attributable and nci_at: places of columns, by headers, else by sums that prove the last column the total."""
    page = Window.partitionBy("doc_id")
    last = lambda of: F.get(of, F.size(of) - 1)
    parts = lambda of: F.filter(F.slice(of, 1, F.greatest(F.size(of) - 1, F.lit(0))), lambda x: x.isNotNull())
    adds_up = lambda of: (F.size(parts(of)) >= 2) & (F.abs(F.aggregate(parts(of), F.lit(0.0), lambda a, x: a + x) - last(of)) <= SLACK)
    both = [F.col("opening"), F.col("figures")]
    shown = sum(F.when(F.col("block") & (F.col("width") > 1), last(x).isNotNull().cast("int")).otherwise(0) for x in both)
    sound = sum(F.when(F.col("block") & last(x).isNotNull(), adds_up(x).cast("int")).otherwise(0) for x in both)
    proved = (F.sum(shown).over(page) >= 2) & (F.sum(shown).over(page) == F.sum(sound).over(page))
    nci, end = F.get("nci", F.lit(0)), F.col("width") - 1
    has, left, right = F.size("nci") > 0, F.filter("plain", lambda i: i < nci), F.filter("plain", lambda i: i > nci)
    by_header = (
        F.when(F.size("named") == 1, F.get("named", F.lit(0)))
        .when(has & (F.size(right) == 1), F.get(right, F.lit(0)))
        .when(~has & (F.size("plain") == 1) & (F.get("plain", F.lit(0)) == end), end)
    )
    out = each.withColumn("proved", proved)
    out = out.withColumn("total", F.coalesce(by_header, F.when(F.col("proved"), end)))
    attributable = F.when(has & (F.size(left) == 1), F.get(left, F.lit(0)))
    return out.withColumns({"attributable": F.when(attributable < F.col("total"), attributable), "nci_at": nci}).drop("proved", "named", "plain", "nci")


def _judged(lines: DataFrame, statements: DataFrame) -> DataFrame:
    """Every event of every statement with held (a block that proves itself) and refused (why the statement has none).

    One pass: all windows are over doc_id, so lines are shuffled once.
    """
    each = _with_total(_blocks(_events(*_dealt(lines, statements))))
    page, so_far = Window.partitionBy("doc_id"), Window.partitionBy("doc_id").orderBy("row_no", "nth").rowsBetween(Window.unboundedPreceding, 0)
    # A year that comes again starts a second matrix; nothing from there on counts.
    of_year = Window.partitionBy("doc_id", "block", "fy").orderBy("row_no", "nth")
    each = each.withColumn("repeat", F.col("block") & (F.row_number().over(of_year) > 1))
    year = periods.fiscal_year_of(F.coalesce("stated", F.max(F.when(F.col("block"), F.col("instant"))).over(page)), F.col("fye"))
    each = each.withColumns({"again": F.max("repeat").over(so_far), "year": year})
    each = each.withColumn("kept", F.coalesce(F.col("block") & ~F.col("again") & F.col("fy").between(F.col("year") - 1, F.col("year")), F.lit(False)))
    figure = lambda of, place: F.get(of, F.col(place))
    gap = lambda of: F.abs(figure(of, "attributable") + F.coalesce(figure(of, "nci_at"), F.lit(0.0)) - figure(of, "total"))
    wrong = F.col("kept") & (F.coalesce(gap("opening") > SLACK, F.lit(False)) | F.coalesce(gap("figures") > SLACK, F.lit(False)))
    each = each.withColumns({"wrong": F.max(wrong).over(page), "any": F.max("kept").over(page), "opens": figure("opening", "total"), "closes": figure("figures", "total")})
    # One year's closing is the other's opening, whichever stands first.
    blocks = Window.partitionBy("doc_id", "kept").orderBy("row_no", "nth")
    prior = lambda c: F.lag(c).over(blocks)
    chained = F.when(prior("fy").isNull(), True).when(F.col("fy") == prior("fy") + 1, prior("closes") == F.col("opens")).when(F.col("fy") == prior("fy") - 1, F.col("closes") == prior("opens"))
    each = each.withColumn("chained", F.coalesce(chained, F.lit(False)))
    each = each.withColumn("chain", F.min("chained").over(blocks.rowsBetween(Window.unboundedPreceding, 0)))
    refused = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("off"), "a balance is not dated on the ends of the fiscal year")
        .when(F.col("total").isNull(), "no one column of total equity")
        .when(F.col("total") < F.col("nci_at"), "total equity stands left of others' share")
        .when(~F.col("any"), "no complete block of the statement's years")
        .when(F.col("wrong"), "attributable and others' share are not the total")
        .when(F.col("basis").isNull(), "names neither group nor company")
    )
    each = each.withColumn("refused", refused)
    return each.withColumn("held", F.col("kept") & F.col("chain") & F.col("refused").isNull())


def equity_facts(lines: DataFrame, statements: DataFrame) -> DataFrame:
    """doc_id, company_id, basis, col, fiscal_year, period_start, period_end, concept, instant, value (in base units), n_rows.

    Balances are instants, on the first day of the year and on the closing date; movements cover the year. Rows of an additive movement
    are summed; a second row of another makes it ambiguous, and it is left out.
    """
    each = _judged(lines, statements)
    start = periods.fiscal_year_start(F.col("fy"), F.col("fye"))
    block = F.struct("held", "from_row", F.col("fy").alias("fiscal_year"), start.alias("period_start"), F.col("instant").alias("period_end"))
    # A movement belongs to the balance after it, if that closes a block which opened before it.
    later = Window.partitionBy("doc_id").orderBy("row_no", "nth").rowsBetween(1, Window.unboundedFollowing)
    each = each.withColumns({"own": block, "next": F.first(F.when(F.col("kind").isNotNull(), block), ignorenulls=True).over(later)})
    inside = F.col("kind").isNull() & F.col("movement").isNotNull() & F.col("next.held") & (F.col("row_no") > F.col("next.from_row"))
    fact = lambda concept, on, value: F.struct(concept.alias("concept"), on.alias("instant"), value.alias("figure"))
    ends = F.array(fact(F.lit(balances.OPENING), F.col("own.period_start"), F.col("opens")), fact(F.lit(balances.CLOSING), F.col("own.period_end"), F.col("closes")))
    move = F.array(fact(F.col("movement"), F.lit(None).cast("date"), F.get("figures", F.col("total"))))
    told = each.withColumn("told", F.when(F.col("held"), ends).when(inside, move)).withColumn("of", F.when(F.col("held"), F.col("own")).otherwise(F.col("next")))
    keys = ["doc_id", "company_id", "basis", "col", "fiscal_year", "period_start", "period_end"]
    rows = told.select("doc_id", "company_id", "basis", F.col("total").alias("col"), "of.fiscal_year", "of.period_start", "of.period_end", "multiplier", F.inline("told")).where("figure is not null")
    summed = rows.groupBy(*keys, "multiplier", "concept", "instant").agg(F.sum("figure").alias("value"), F.count("*").alias("n_rows"))
    sure = (F.col("n_rows") == 1) | F.col("concept").isin(balances.ADDITIVE)
    return summed.where(sure).withColumn("value", F.col("value") * F.col("multiplier")).drop("multiplier")


def refusals(lines: DataFrame, statements: DataFrame) -> DataFrame:
    """doc_id and reason of each statement of which blocks were left out, all of them or those after a break of the chain."""
    broken = F.max(F.col("kept") & ~F.col("chain"))
    seen = _judged(lines, statements).groupBy("doc_id").agg(F.coalesce(F.first("refused"), F.when(broken, "blocks do not chain")).alias("reason"), F.lit(True).alias("read"))
    out = statements.select("doc_id").join(seen, "doc_id", "left")
    return out.withColumn("reason", F.when(F.col("read").isNull(), "no rows").otherwise(F.col("reason"))).where("reason is not null").select("doc_id", "reason")
