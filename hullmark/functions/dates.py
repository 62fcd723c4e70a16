"""Partial ISO dates as text: '', YYYY, YYYY-MM, YYYY-MM-DD, and -YYYY for years BC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hullmark.functions.text import clean, let

# The months.
MONTHS = "january february march april may june july august september october november december".split()
_SHORT = {w: i + 1 for i, m in enumerate(MONTHS) for w in (m, m[:3], *(["sept"] if m == "september" else []))}
def format_date(y: Column, m: Column | None = None, d: Column | None = None) -> Column:
    """The ISO text; '' without a year, and a day only with a month."""
    no = F.lit(None).cast("int")
    m, d = no if m is None else m, no if d is None else d
    year = F.when(y < 0, F.concat(F.lit("-"), F.lpad(F.abs(y).cast("string"), 4, "0"))).otherwise(F.lpad(y.cast("string"), 4, "0"))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.when(y.isNull(), F.lit("")).when(m.isNotNull() & d.isNotNull(), F.concat_ws("-", year, two(m), two(d))).when(m.isNotNull(), F.concat_ws("-", year, two(m))).otherwise(year)


def _tokens(text: Column) -> Column:
    """The words, numbers and signs of a text in lower case: a word keeps its point, letters and digits run together are neither."""
    return F.regexp_extract_all(F.lower(clean(text)), F.lit(r"\d+(?=(?:bce?|ad|ce)\b)|[a-z]+\.?(?![a-z0-9])|[a-z0-9]+|[^\sa-z0-9]"), F.lit(0))


def _at(tokens: Column, i: Column) -> Column:
    """The token at a place counted from 1; '' beyond either end."""
    return F.coalesce(F.when(i > 0, F.try_element_at(tokens, i)), F.lit(""))


def _month(token: Column) -> Column:
    """The number of the month that a token names, in full or by its first letters."""
    numbers = F.create_map(*[F.lit(x) for pair in _SHORT.items() for x in pair])
    return F.try_element_at(numbers, F.rtrim(token, F.lit(".")))


def _digits(token: Column, most: int) -> Column:
    """The number a token is, if it has so many digits at most."""
    return F.when(token.rlike(rf"^\d{{1,{most}}}$"), token.cast("int"))


def _year(tokens: Column, i: Column) -> Column:
    """The year a number at a place means, with the era after it."""
    y = _digits(_at(tokens, i), 4)
    return F.when(_at(tokens, i + 1).isin("bc", "bce"), -y).otherwise(y)


def _first(tokens: Column, fits: Callable[[Column], Column]) -> Column:
    """The first place that fits; 0 if none does."""
    return F.coalesce(F.try_element_at(F.filter(F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1))), fits), F.lit(1)), F.lit(0))


def parse_date(text: Column, default_year: Column | None = None, default_month: Column | None = None) -> Column:
    """A partial ISO date from free text.

    The text is cut into words and numbers, and months look at their neighbours. In this order:
    a month with a day before it, with a day after it, with a year after it, a month alone, the
    first number of three or four digits if it can be a year, a number with an era, the defaults.
    A day outside 1..31 is no day.
    """
    no = F.lit(None).cast("int")
    dy, dm = no if default_year is None else default_year.cast("int"), no if default_month is None else default_month.cast("int")

    def decide(t: Column) -> Column:
        month, day = (lambda i: _month(_at(t, i))), (lambda i: _digits(_at(t, i), 2))
        return let(F.struct(
            _first(t, lambda i: month(i).isNotNull() & day(i - 1).isNotNull()).alias("after"), _first(t, lambda i: month(i).isNotNull() & day(i + 1).isNotNull()).alias("before"),
            _first(t, lambda i: month(i).isNotNull() & _digits(_at(t, i + 1), 4).isNotNull()).alias("dated"), _first(t, lambda i: _at(t, i).rlike(r"^\d{3,4}$")).alias("long"),
            _first(t, lambda i: _digits(_at(t, i), 4).isNotNull() & _at(t, i + 1).isin("bc", "bce")).alias("old"),
        ), lambda p: chosen(t, p["after"], p["before"], p["dated"], p["long"], p["old"]))

    def chosen(t: Column, after: Column, before: Column, dated: Column, long: Column, old: Column) -> Column:
        month, day = (lambda i: _month(_at(t, i))), (lambda i: _digits(_at(t, i), 2))
        told = F.coalesce(_year(t, after + F.when(_at(t, after + 1) == ",", 2).otherwise(1)), dy)
        behind = F.coalesce(F.when(_at(t, before + 2) == ",", _year(t, before + 3)), dy)
        era, number = _at(t, long + 1).isin("bc", "bce", "ad", "ce"), _digits(_at(t, long), 4)
        return (
            F.when((after > 0) & day(after - 1).between(1, 31), format_date(told, month(after), day(after - 1)))
            .when((before > 0) & day(before + 1).between(1, 31), format_date(behind, month(before), day(before + 1)))
            .when(dated > 0, format_date(_year(t, dated + 1), month(dated)))
            .when((F.size(t) == 1) & month(F.lit(1)).isNotNull(), format_date(dy, month(F.lit(1))))
            .when((long > 0) & (era | number.between(100, 2100)), format_date(_year(t, long)))
            .when(old > 0, format_date(_year(t, old)))
            .otherwise(format_date(dy, dm))
        )

    return let(_tokens(text), decide)


def _period(title: Column) -> Column:
    """Year and month of a page on a month or a year: what follows the word "in"."""

    def told(t: Column) -> Column:
        place = _first(t, lambda i: (_at(t, i) == "in") & _month(_at(t, i + 1)).isNotNull() & _at(t, i + 2).rlike(r"^\d{4}$"))
        last = F.when((_at(t, F.size(t) - 1) == "in") & _at(t, F.size(t)).rlike(r"^\d{3,4}$"), _digits(_at(t, F.size(t)), 4))
        return let(place, lambda i: F.struct(F.when(i > 0, _digits(_at(t, i + 2), 4)).otherwise(last).alias("year"), F.when(i > 0, _month(_at(t, i + 1))).alias("month")))

    return let(_tokens(title), told)


def page_year(title: Column) -> Column:
    return _period(title)["year"]


def page_month(title: Column) -> Column:
    return _period(title)["month"]


def year_key(date: Column) -> Column:
    """The year part of a partial date, '' if there is none."""
    d = F.coalesce(date, F.lit(""))
    return F.when(F.startswith(d, F.lit("-")), F.regexp_replace(F.substring(d, 1, 5), "-+$", "")).otherwise(F.substring(d, 1, 4))


def compact_date(text: Column) -> Column:
    """YYYYMMDD, YYYYMM or YYYY to a partial ISO date; '' for anything else."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return (
        F.when(t.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2)))
        .when(t.rlike(r"^\d{6}$"), F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2)))
        .when(t.rlike(r"^\d{4}$"), t).otherwise(F.lit(""))
    )
