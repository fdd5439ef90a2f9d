"""Window operators: consecutive change, row numbers, running counts, carry-forward, row buckets.

Skew.  A plain ``Window.partitionBy(key)`` sends every row of one key to one
task; a key holding a third of all rows would then be sorted by one task.
Here a bounded sample of (key, order) finds the keys with more than a range's
share of the rows and cuts each of them, at quantiles of its order, into as
many *ranges* as it has shares.  The window runs per ``(key, range)``; what
crosses from one range of a key into the next (its last value, its count) is a
prefix scan over one edge row per range, at most ``MAX_RANGES`` in all, that is
landed and joined by broadcast.  The big side is read once and exchanged once,
and a hot (key, instant) is spread like any other as long as ``order`` is total.

Numbers over a whole table (no key) come from a range exchange: position in
the partition plus the counts of the partitions before it.

NULL keys form one key, NULL order values come first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.session import landed

_RANGE, _SPLITS = "__tp_range", "__tp_splits"
#: Most ranges in all (a power of two), and rows of the sample that finds them.
MAX_RANGES = 4096
SAMPLE_ROWS = 16 * MAX_RANGES


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def _same(a: Sequence[str], b: Sequence[str]) -> Column:
    same = F.lit(True)
    for x, y in zip(a, b, strict=True):
        same = same & F.col(x).eqNullSafe(F.col(y))
    return same


def _with_small(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Rows plus the columns of a landed table of at most ``MAX_RANGES`` rows; NULL keys match."""
    names = [f"__tp_k{i}" for i in range(len(keys))]
    named = table.withColumnsRenamed(dict(zip(keys, names, strict=True)))
    return rows.join(F.broadcast(named), _same(keys, names), how).drop(*names)


def key_splits(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int) -> DataFrame:
    """Landed ``keys, splits``: for each key with more than a range's share of the
    rows, the sorted order values at which its ranges begin."""
    n = df.count()
    place = F.struct(*order)
    sample = df.select(*keys, place.alias("__tp_o")).sample(min(1.0, SAMPLE_ROWS / max(1, n)), 7)
    own = Window.partitionBy(*keys)
    ranked = sample.select("*", F.row_number().over(own.orderBy("__tp_o")).alias("__tp_n"), F.count("*").over(own).alias("__tp_c"))
    step = max(1, -(-min(n, SAMPLE_ROWS) // ranges))
    cuts = ranked.where((F.col("__tp_n") % step == 0) & (F.col("__tp_n") < F.col("__tp_c"))).groupBy(*keys) \
        .agg(F.array_sort(F.collect_set("__tp_o")).alias(_SPLITS))
    return landed(df.sparkSession, cuts, "window-splits")


def _range_of(place: Column) -> Column:
    """How many of the sorted splits are at or before ``place``, by halving."""
    halves = F.array(*[F.lit(MAX_RANGES >> k) for k in range(MAX_RANGES.bit_length())])
    splits = F.col(_SPLITS)

    def step(at: Column, half: Column) -> Column:
        return F.when((at + half <= F.size(splits)) & (F.get(splits, at + half - 1) <= place), at + half).otherwise(at)

    return F.when(splits.isNull(), F.lit(0)).otherwise(F.aggregate(halves, F.lit(0), step))


def _ranged(df: DataFrame, keys: list[str], order: list[str], ranges: int | None, edge: Column,
            scan: Callable[[Window], dict[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows with their range and, from the ranges of their key before it, the columns
    of ``scan`` over the edge rows (``__tp_edge`` is ``edge`` aggregated per range)."""
    spark = df.sparkSession
    if ranges is None:
        ranges = min(MAX_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    splits = key_splits(df, keys, order, min(ranges, MAX_RANGES))
    ranged = lambda how: _with_small(df, splits, keys, how).withColumn(_RANGE, _range_of(F.struct(*order))).drop(_SPLITS)
    edges = ranged("inner").groupBy(*keys, _RANGE).agg(edge.alias("__tp_edge"))  # rows of split keys only: one per range
    before = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = landed(spark, edges.select(*keys, _RANGE, *[c.alias(n) for n, c in scan(before).items()]), "window-edges")
    return ranged("left"), carried


def lag_by_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "prev_value",
    has_prev: str = "has_prev",
    ranges: int | None = None,
) -> DataFrame:
    """``lag(value)`` per key in ``order``, with hot keys cut into ranges.

    Adds ``out`` (the previous row's value, NULL if that value is NULL) and
    ``has_prev`` (False only for the first row of each key), so the caller can
    tell "no predecessor" from "predecessor with NULL value".
    ``order`` must be a total order within a key (add a unique tie-break).
    """
    keys, order = _cols(keys), _cols(order)
    rows, carried = _ranged(df, keys, order, ranges, F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)),
                            lambda before: {"__tp_last": F.last("__tp_edge").over(before)})
    w = Window.partitionBy(*keys, _RANGE).orderBy(*order)
    rows = rows.withColumn("__tp_prev", F.lag(F.struct(F.col(value).alias("v"))).over(w))
    prev = F.coalesce("__tp_prev", "__tp_last")
    return _with_small(rows, carried, [*keys, _RANGE]).withColumn(out, prev["v"]).withColumn(has_prev, prev.isNotNull()) \
        .drop(_RANGE, "__tp_prev", "__tp_last")


def consecutive_changes(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "change",
    ranges: int | None = None,
) -> DataFrame:
    """One row per pair of consecutive observations of a key:
    ``abs(value - previous value)``; NULL when either value is NULL.

    Same rows as the self-join ``a.row_num = b.row_num + 1`` on row numbers
    per key, without the join; rows with a NULL key pair with none.
    """
    keys = _cols(keys)
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    lagged = lag_by_key(df, keys, order, value, out="_prev", has_prev="_has_prev", ranges=ranges)
    return (
        lagged.where("_has_prev")
        .select(*keys, *_cols(order), F.abs(F.col(value) - F.col("_prev")).alias(out))
    )


def max_consecutive_change(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "max_change",
    per_key: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Largest absolute change between consecutive observations.

    ``per_key=False`` gives the single global maximum (one row, NULL when no
    pair has two non-NULL values); ``per_key=True`` one row per key.
    The global form is a partial/final aggregate: one value per task crosses
    the final exchange.
    """
    narrow = df.select(*dict.fromkeys([*_cols(keys), *_cols(order), value]))
    ch = consecutive_changes(narrow, keys, order, value, out="_change", ranges=ranges)
    if per_key:
        return ch.groupBy(*_cols(keys)).agg(F.max("_change").alias(out))
    return ch.agg(F.max("_change").alias(out))


def running_sums_by_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[str],
    amounts: dict[str, Column],
    ranges: int | None = None,
) -> DataFrame:
    """For each name in ``amounts`` its sum over the rows of the same key strictly
    before, in ``order`` (0 for the first row; NULL adds nothing), as a bigint."""
    keys, order = _cols(keys), _cols(order)
    edge = F.struct(*[F.sum(a).alias(n) for n, a in amounts.items()])
    rows, carried = _ranged(df, keys, order, ranges, edge,
                            lambda before: {f"__tp_before_{n}": F.sum(F.col("__tp_edge")[n]).over(before) for n in amounts})
    w = Window.partitionBy(*keys, _RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"__tp_in_{n}": F.sum(a).over(w) for n, a in amounts.items()})
    total = {n: (F.coalesce(f"__tp_in_{n}", F.lit(0)) + F.coalesce(f"__tp_before_{n}", F.lit(0))).cast("bigint") for n in amounts}
    return _with_small(rows, carried, [*keys, _RANGE]).withColumns(total) \
        .drop(_RANGE, *[f"__tp_{k}_{n}" for k in ("in", "before") for n in amounts])


def running_sum_by_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[str],
    amount: Column,
    out: str = "sum_before",
    ranges: int | None = None,
) -> DataFrame:
    """One running sum, as in :func:`running_sums_by_key`."""
    return running_sums_by_key(df, keys, order, {out: amount}, ranges)


def row_number_by_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[str],
    out: str = "row_num",
    ranges: int | None = None,
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)`` as a bigint: row
    number inside the range plus the rows of the key's earlier ranges."""
    keys, order = _cols(keys), _cols(order)
    rows, carried = _ranged(df, keys, order, ranges, F.count("*"), lambda before: {"__tp_before": F.sum("__tp_edge").over(before)})
    rows = rows.withColumn("__tp_rn", F.row_number().over(Window.partitionBy(*keys, _RANGE).orderBy(*order)))
    return _with_small(rows, carried, [*keys, _RANGE]) \
        .withColumn(out, (F.col("__tp_rn") + F.coalesce("__tp_before", F.lit(0))).cast("bigint")).drop(_RANGE, "__tp_rn", "__tp_before")


def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "row_num", partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)`` as a dense bigint, without a single task.

    Rows go through one range exchange and are landed with their partition and
    their place in it; the counts of the partitions (one row each) give the
    bases.  Rows with equal order values share a partition, so ``order`` should
    be total.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__tp_id", F.monotonically_increasing_id())
    rows = landed(df.sparkSession, placed, "global-rows")
    part, place = F.shiftright("__tp_id", 33).cast("int"), F.col("__tp_id").bitwiseAND((1 << 33) - 1)
    counts = rows.groupBy(part.alias("p")).agg(F.count("*").alias("c")).collect()  # one row per partition
    bases, at = {}, 0
    for r in sorted(counts, key=lambda r: r["p"]):
        bases[r["p"]], at = at, at + r["c"]
    base = F.get(F.array(*[F.lit(bases.get(p, 0)).cast("long") for p in range(max(bases, default=0) + 1)]), part)
    return rows.withColumn(out, base + place + 1).drop("__tp_id")


def carry_forward(
    df: DataFrame,
    partition: str | Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    default: Column | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Last non-NULL ``value`` at or before each row inside ``partition``
    (``last(value) IGNORE NULLS OVER (ROWS UNBOUNDED PRECEDING .. CURRENT ROW)``).

    The value that enters a range is the last non-NULL one of the earlier
    ranges of its key, over ranges that hold none.
    """
    keys, order = _cols(partition), _cols(order)
    df = df.withColumn("__tp_v", value)
    last = F.max_by(F.col("__tp_v"), F.when(F.col("__tp_v").isNotNull(), F.struct(*order)))
    rows, carried = _ranged(df, keys, order, ranges, last,
                            lambda before: {"__tp_carry": F.last("__tp_edge", ignorenulls=True).over(before)})
    w = Window.partitionBy(*keys, _RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__tp_in", F.last("__tp_v", ignorenulls=True).over(w))
    known = [F.col("__tp_in"), F.col("__tp_carry"), *([] if default is None else [default])]
    return _with_small(rows, carried, [*keys, _RANGE]).withColumn(out, F.coalesce(*known)).drop(_RANGE, "__tp_v", "__tp_in", "__tp_carry")


def bucket_rows(df: DataFrame, row_num: str, width: int | Column, out: str = "row_group") -> DataFrame:
    """Group id ``floor((row_num - 1) / width)`` (rows of ``width`` items)."""
    w = width if isinstance(width, Column) else F.lit(width)
    return df.withColumn(out, F.floor((F.col(row_num) - 1) / w).cast("bigint"))
