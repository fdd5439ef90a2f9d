"""Join operators.

Strategy.  Spark plans a sort-merge join unless one side is known to be
small; with AQE on, a side whose *measured* shuffle output is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` is switched to a broadcast
at run time, and skewed partitions are split (``skewJoin``).  An explicit
broadcast hint is only given where the side's size is bounded by
construction (k cluster centres, a month calendar).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JOIN_TYPES = {"inner": "inner", "left": "left", "right": "right", "full outer": "full"}


def join_type_counts(a: DataFrame, a_key: str, b: DataFrame, b_key: str) -> DataFrame:
    """Row counts of ``a JOIN b ON a_key = b_key`` for inner, left, right
    and full outer joins, as ``(join_type, count)``.

    Computed from per-key row counts instead of materialising the joins:
    inner = sum(ca * cb) over matching keys; each outer join adds the rows of
    unmatched keys (NULL keys never match, so they count as unmatched).
    Both sides are pre-aggregated before the shuffle, so a hot key that holds
    a third of the rows is one row, and the pair explosion of duplicate keys
    is never built.  The products are added up as decimals; only a total beyond
    a bigint is an error, as ``COUNT(*)`` of that join would be.
    """
    ka = a.groupBy(F.col(a_key).alias("_k")).agg(F.count(F.lit(1)).alias("_ca"))
    kb = b.groupBy(F.col(b_key).alias("_k")).agg(F.count(F.lit(1)).alias("_cb"))
    # NULL = NULL is not a match, so the NULL group of each side stays unmatched.
    m = ka.join(kb, ka["_k"] == kb["_k"], "full")
    ca, cb = F.coalesce(F.col("_ca"), F.lit(0)), F.coalesce(F.col("_cb"), F.lit(0))
    matched = F.col("_ca").isNotNull() & F.col("_cb").isNotNull()
    sums = m.agg(
        F.sum(F.when(matched, ca.cast("decimal(38,0)") * cb).otherwise(0)).alias("inner"),
        F.sum(F.when(~matched, ca).otherwise(0)).alias("a_only"),
        F.sum(F.when(~matched, cb).otherwise(0)).alias("b_only"),
    )
    return sums.select(
        F.explode(
            F.array(
                F.struct(F.lit("inner").alias("join_type"), F.col("inner").alias("count")),
                F.struct(F.lit("left").alias("join_type"), (F.col("inner") + F.col("a_only")).alias("count")),
                F.struct(F.lit("right").alias("join_type"), (F.col("inner") + F.col("b_only")).alias("count")),
                F.struct(
                    F.lit("full outer").alias("join_type"),
                    (F.col("inner") + F.col("a_only") + F.col("b_only")).alias("count"),
                ),
            )
        ).alias("r")
    ).select(F.col("r.join_type").alias("join_type"), F.coalesce(F.col("r.count"), F.lit(0)).cast("bigint").alias("count"))


def calendar_left_join(calendar: DataFrame, facts: DataFrame, on: str, fill_zero: Sequence[str] = ()) -> DataFrame:
    """Every calendar row kept; months with several fact rows stay several
    rows; amounts of empty months become 0 (``fillna`` on ``fill_zero``)."""
    out = calendar.join(facts, on=on, how="left")
    return out.fillna(0, subset=list(fill_zero)) if fill_zero else out
