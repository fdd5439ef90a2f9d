"""Key marks: bitmaps of bounded size that tell which rows may have a key.

A key sets the bit its hash points at.  A row whose bit is set may have the
key, a row whose bit is not set has none.  The bitmap is a table of 4 KB rows
made by Spark's own bitmap aggregates and joined by broadcast, so neither rows
nor keys move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mark_bit(keys: Sequence[str | Column], bits: int) -> Column:
    """The bit of a key in a bitmap of ``bits`` bits; NULL parts count as any value."""
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def key_marks(keys: DataFrame, bit: Column, by: Sequence[str] = (), **extra: Column) -> DataFrame:
    """``marks_no, marks`` (and the columns ``by``): bitmaps with the bits of all keys
    set; ``extra`` are further aggregates, told with each of them."""
    named = keys.withColumn("__bit", bit)
    return named.groupBy(*by, F.bitmap_bucket_number("__bit").alias("marks_no")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__bit")).alias("marks"), *[c.alias(n) for n, c in extra.items()])


def bit_is_set(marks: str, bit: str) -> Column:
    """Whether column ``bit`` is set in its 4 KB bitmap ``marks`` (False without one)."""
    at = f"bitmap_bit_position({bit})"
    byte = f"cast(conv(hex(substr({marks}, cast({at} div 8 as int) + 1, 1)), 16, 10) as int)"
    return F.expr(f"coalesce({byte} & shiftleft(1, cast({at} % 8 as int)) <> 0, false)")


def with_mark(rows: DataFrame, marks: DataFrame, bit: Column, flag: str) -> DataFrame:
    """Rows with ``flag``: whether their bit is set in the landed ``marks``."""
    joined = rows.withColumn("__bit", bit).join(F.broadcast(marks), F.bitmap_bucket_number("__bit") == F.col("marks_no"), "left")
    return joined.withColumn(flag, bit_is_set("marks", "__bit")).drop("__bit", "marks", "marks_no")
