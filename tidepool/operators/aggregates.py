"""Aggregation operators.

All aggregates here are algebraic (count/sum/avg/max, or per-group arrays of
bounded size), so Spark runs them as a partial aggregate before the shuffle
and a final one after it: a hot group key costs one row per task on the wire.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.windows import row_number_by_key


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sum_or_zero(x) -> Column:
    """``coalesce(sum(x), 0)``: zero instead of NULL over no rows.
    (``sum(nvl(x, 0))`` is still NULL over no rows.)"""
    return F.coalesce(F.sum(_c(x)), F.lit(0))


def collect_ordered(
    df: DataFrame, keys: str | Sequence[str], position: str, value: str, out: str
) -> DataFrame:
    """Per group, the values ordered by ``position`` as an array.

    Bare ``collect_list`` has no order guarantee after a shuffle; collecting
    ``struct(position, value)`` and sorting makes it deterministic (equal
    positions are ordered by value).  Use it for
    groups of bounded size only (the lines of one order, the pixels of one
    image row): the whole group is materialised in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    arr = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(value).alias("v"))))
    return df.groupBy(*keys).agg(F.transform(arr, lambda s: s["v"]).alias(out))


def collect_segments(
    df: DataFrame, keys: str | Sequence[str], order: Sequence[str], value: str, size: int, out: str, segment: str = "segment"
) -> DataFrame:
    """Per group, the values in ``order`` as arrays of at most ``size``: one row per
    (group, segment), numbered from 0, which together are the group's whole order.

    Positions come from :func:`row_number_by_key`, so a group of any length is
    spread over its segments and never meets in one row or task."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    placed = row_number_by_key(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, out="__tp_at")
    parts = placed.withColumn(segment, F.floor((F.col("__tp_at") - 1) / size).cast("bigint"))
    return collect_ordered(parts, [*keys, segment], "__tp_at", value, out)


def distinct_rows(df: DataFrame) -> DataFrame:
    """``SELECT DISTINCT *``."""
    return df.distinct()


def duplicate_groups(df: DataFrame, columns: Sequence[str] | None = None, out: str = "copies") -> DataFrame:
    """Duplicate check: groups of identical rows (over ``columns``, default
    all) that occur more than once, with their multiplicity."""
    cols = list(columns or df.columns)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset) if subset else None)
