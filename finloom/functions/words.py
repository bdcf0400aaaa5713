"""Texts as arrays of lower-case words, numbers and dates in digits, and phrases and positions in them. Native expressions.

Punctuation and case are gone after words(), so rules over captions and labels are set tests and neighbours, not patterns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A date in digits stays one word; else runs of letters (with the dollar sign of a currency) and runs of digits.
WORD = r"[0-9]+[./][0-9]+[./][0-9]+|[a-z]+[$]?|[0-9]+"
#: Names of months and of numbers of months.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
NUMBERS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text in order; apostrophes join what they stand between."""
    return F.regexp_extract_all(F.regexp_replace(F.lower(text), "['‘’]", ""), F.lit(WORD), F.lit(0))


def spoken(found: Column) -> Column:
    """The words as one text with a blank on either side of each."""
    return F.concat(F.lit(" "), F.array_join(found, " "), F.lit(" "))


def says(line: Column, phrases: Iterable[str]) -> Column:
    """Whether a spoken() line holds any of the phrases, as whole words."""
    out = F.lit(False)
    for phrase in phrases:
        out = out | line.contains(f" {phrase} ")
    return out


def begins(line: Column, phrases: Iterable[str]) -> Column:
    """Whether a spoken() line starts with any of the phrases, as whole words."""
    out = F.lit(False)
    for phrase in phrases:
        out = out | line.startswith(f" {phrase} ")
    return out


def _lookup(of: dict[str, int], word: Column) -> Column:
    pairs = [F.lit(x) for item in of.items() for x in item]
    return F.element_at(F.create_map(*pairs), F.coalesce(word, F.lit("")))


#: Months by their names, first three letters, and sept.
MONTH_WORDS = {**{m: i for i, m in enumerate(MONTHS, 1)}, **{m[:3]: i for i, m in enumerate(MONTHS, 1)}, "sept": 9}


def month_number(word: Column) -> Column:
    """1 to 12 of a month's name, null for other words."""
    return _lookup(MONTH_WORDS, word)


def small_number(word: Column) -> Column:
    """1 to 12 of digits or a number's name, null for other words."""
    digits = word.try_cast("int")
    return F.coalesce(F.when(digits.between(1, 12), digits), _lookup({name: i for i, name in enumerate(NUMBERS, 1)}, word))


def _number(word: Column, least: int, most: int) -> Column:
    """A word of so many digits as a number."""
    return F.when(F.length(word).between(least, most), word.try_cast("int"))


def real_date(year: Column, month: Column, day: Column) -> Column:
    """The date, or null where the calendar has none."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int")))


def dates(found: Column) -> Column:
    """Dates among words: array of struct(form, at, day, month, year) by place.

    form: 1 day, month, year; 2 month, day, year; 3 in digits; 4 month and year alone (day is null). at: the first word's place.
    A form's parts are checked for their shape only.
    """

    def here(word: Column, i: Column) -> Column:
        after = lambda k: F.get(found, i + k)
        day, month, year = _number(word, 1, 2), month_number(after(1)), _number(after(2), 4, 4)
        first = month_number(word)
        second, third = _number(after(1), 1, 2), _number(after(2), 4, 4)
        alone = F.when(_number(F.get(found, i - 1), 1, 2).isNull(), _number(after(1), 4, 4))
        parts = F.split(word, "[./]")
        d, n, y = (_number(F.get(parts, F.lit(k)), *size) for k, size in enumerate(((1, 2), (1, 2), (4, 4))))
        date = lambda form, *of: F.struct(F.lit(form).alias("form"), i.alias("at"), *(x.alias(c) for x, c in zip(of, ("day", "month", "year"))))
        return (
            F.when(day.isNotNull() & month.isNotNull() & year.isNotNull(), date(1, day, month, year))
            .when(first.isNotNull() & second.isNotNull() & third.isNotNull(), date(2, second, first, third))
            .when(d.isNotNull() & n.isNotNull() & y.isNotNull(), date(3, d, n, y))
            .when(first.isNotNull() & alone.isNotNull(), date(4, F.lit(None).cast("int"), first, alone))
        )

    return F.filter(F.transform(found, here), lambda x: x.isNotNull())
