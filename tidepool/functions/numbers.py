"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x, scale: int = 2) -> Column:
    """``round(x, scale)`` as a double: one step, half away from zero on the
    shortest decimal text of the value (1.005 gives 1.01, 0.0049999996 gives 0.0)."""
    return F.round(_c(x).cast("double"), scale)


def ratio(a, b, scale: int = 2) -> Column:
    """``round(a / b, scale)``; NULL instead of an error when ``b`` is 0
    (Spark's ANSI mode raises on division by zero)."""
    return round_half_up(F.try_divide(_c(a).cast("double"), _c(b).cast("double")), scale)


def money(x) -> Column:
    """Amount as ``decimal(18,2)``: sums of money are exact, not float sums."""
    return _c(x).cast("decimal(18,2)")


def avg_exact(x, scale: int = 2) -> Column:
    """Average of an amount, computed from an exact decimal sum, rounded."""
    s = F.sum(money(x)).cast("double")
    return round_half_up(s / F.count(_c(x)), scale)


def truncate_int(x) -> Column:
    """Toward-zero integer part of a double (Python ``int(x)``)."""
    return _c(x).cast("int")
