"""Date helpers: month calendars, first-of-month periods, period from a name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spanish month names, January to December, as they appear in
# statement file names ("<mes> - <yyyy>.pdf").
SPANISH_MONTHS = [
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
]

# File-name pattern: "<word> - <4 digits>.pdf" at the end; (?U) makes \w
# Unicode-aware as in Python.
PERIOD_IN_NAME = r"(?U)(\w+) - (\d{4})\.pdf$"
#: Characters at a name's end that tell its period: " - ", the year, ".pdf", a line end and more letters than any month has.
PERIOD_CHARS = 24


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_number(name) -> Column:
    """Spanish month name (any case) -> 1..12, NULL when unknown."""
    m = F.create_map(*[x for i, n in enumerate(SPANISH_MONTHS) for x in (F.lit(n), F.lit(i + 1))])
    return F.try_element_at(m, F.lower(_c(name)))


def month_name(d) -> Column:
    """Date -> Spanish month name."""
    arr = F.array(*[F.lit(n) for n in SPANISH_MONTHS])
    return F.get(arr, F.month(_c(d)) - 1)


def period_from_name(path) -> Column:
    """``'... mayo - 2024.pdf'`` -> ``DATE '2024-05-01'``; NULL when the name
    has no period or the month is unknown."""
    # what the pattern finds, once and from the end only, as it would try every letter of the path as the word's first:
    # a word that is cut there is too long for a month with what is left of it
    found = F.regexp_extract(F.substring(_c(path), -PERIOD_CHARS, PERIOD_CHARS), PERIOD_IN_NAME, 0)

    def period(m: Column) -> Column:
        month = month_number(F.substring(m, F.lit(1), F.length(m) - len(" - 2024.pdf")))
        year = F.substring(m, -len("2024.pdf"), 4).cast("int")
        return F.transform(F.array(month), lambda k: F.when(k.isNotNull(), F.make_date(year, k, F.lit(1))))[0]

    return F.transform(F.array(found), period)[0]


def first_of_month(d) -> Column:
    """Date/timestamp -> the first day of its month, as a DATE."""
    return F.trunc(_c(d).cast("date"), "month")


def first_of_month_text(d) -> Column:
    """Date/timestamp -> ``'yyyy-MM-01'`` text."""
    return F.date_format(_c(d), "yyyy-MM-01")


def month_calendar(bounds: DataFrame, start: str, end: str, out: str = "periodo") -> DataFrame:
    """One row per month start from ``start``'s month to ``end``'s month.

    ``bounds`` is a DataFrame whose columns ``start``/``end`` hold the range
    (usually a one-row aggregate such as ``min``/``max`` of a date column, so
    the calendar is derived on the cluster without a driver round trip).
    Months after ``end`` are not included; a partial last month is.
    """
    return bounds.select(
        F.explode(
            F.sequence(first_of_month(F.col(start)), first_of_month(F.col(end)), F.expr("INTERVAL 1 MONTH"))
        ).alias(out)
    )


def trailing_days(ts, ref, days: int) -> Column:
    """``ts >= ref - days AND ts <= ref`` (``ref`` a date or timestamp)."""
    r = _c(ref)
    return (_c(ts) >= F.date_sub(r, days)) & (_c(ts) <= r)


def last_calendar_week(ts, ref) -> Column:
    """Monday..Sunday of the week before ``ref``'s week: half-open
    ``[monday_before, monday_of_ref_week)``."""
    monday = F.date_trunc("week", _c(ref).cast("timestamp"))
    t = _c(ts).cast("timestamp")
    return (t >= monday - F.expr("INTERVAL 7 DAYS")) & (t < monday)
