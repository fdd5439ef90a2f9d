"""Mixing sources to target weights.

Sizes are summed per source, targets follow from the weights by water filling,
and each document is emitted ``floor(rate)`` times plus one more copy with
probability ``rate - floor(rate)``, drawn from a hash of its id and text.  What a
source gives is near its target as sums of such draws are: within four times
sqrt(sum of size^2 f (1 - f)), f being the fraction.

Only DataFrame functions run.  The sums are combined before the shuffle, so a
source that holds a third of all rows is one row per task.  The table of
sources is ranked in range partitions and levelled by aggregates; it never
goes through one task, and it is broadcast only up to a counted size.

Defined results: a NULL text has size 0; a NULL source is a source of its own,
ranked last; rows without an id draw by their text; repeated rows draw alike; a source of
size 0 has target 0; an empty table gives no rows.  Columns of the input that
are named like those computed here are kept apart in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidepool.llm.common import WORD, join_keys, landed, text_or_empty

#: Production weights, dealt to the sources in turn, and the most repeats.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 17


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def uniform_draw(id_col: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from the id, the text and the seed: 52 bits of an MD5."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(2**52)


def ranked_sources(spark: SparkSession, sizes: DataFrame, weights=WEIGHTS) -> DataFrame:
    """``sizes`` plus the weight of each source by its place in code-point order.

    Range partitions are numbered on their own; the counts of the partitions
    before give the base of each.
    """
    ordered = sizes.repartitionByRange(F.col("source").asc_nulls_last())
    ordered = landed(spark, ordered.withColumn("shard", F.spark_partition_id()), "mix-sources")
    base = {r["shard"]: r["n"] for r in ordered.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for shard in sorted(base):
        before[shard], total = total, total + base[shard]
    starts = F.create_map(*[F.lit(x) for kv in before.items() for x in kv]) if before else None
    place = F.row_number().over(W.partitionBy("shard").orderBy(F.col("source").asc_nulls_last())) - 1
    if starts is not None:
        place = place + starts[F.col("shard")]
    deal = F.array(*[F.lit(float(w)) for w in weights])
    return ordered.withColumn("weight", F.get(deal, (place % len(weights)).cast("int"))).drop("shard")


def targets(spark: SparkSession, sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) -> adds ``target``.

    The level L solves sum(min(max_repeats * size, L * weight)) = sum(size).
    Each pass caps the sources above their bound and shares the rest among the
    others by weight; it ends when no further source is capped.
    """
    table = landed(spark, ranked_sources(spark, sizes, weights), "mix-weights")
    cap = F.lit(max_repeats) * F.col("source_size")
    level, capped = 0.0, -1
    while True:
        held = cap <= F.lit(level) * F.col("weight")
        total, fixed, free, n = table.agg(
            F.sum("source_size"), F.sum(F.when(held, cap)), F.sum(F.when(~held, F.col("weight"))),
            F.count(F.when(held, 1))).first()
        if n == capped or not free:
            break
        capped, level = n, ((total or 0) - (fixed or 0)) / free
    held = cap <= F.lit(level) * F.col("weight")
    return table.select("source", "source_size",
                        F.when(held, cap.cast("double")).otherwise(F.lit(level) * F.col("weight")).alias("target"))


def mix_counts(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS,
               seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               keep_row: bool = False) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, copies`` (and
    the whole input row as ``row`` if asked for)."""
    size = word_count(text_or_empty(text_col))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep_row else []
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
                        uniform_draw(F.col(id_col), text_or_empty(text_col), seed).alias("draw"), *row)
    sums = (docs.select(F.col(source_col).alias("source"), size.alias("size"))
            .groupBy("source").agg(F.sum("size").alias("source_size")))
    goal = landed(spark, targets(spark, sums, weights, max_repeats), "mix-targets") \
        .withColumnRenamed("source", "goal_source")
    out = join_keys(sized, goal, F.col("source").eqNullSafe(F.col("goal_source")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    copies = whole + F.when(F.col("draw") < rate - whole, 1).otherwise(0)
    return out.select("doc_id", "size", "source_size", "target",
                      F.least(copies, F.lit(max_repeats)).cast("long").alias("copies"), *["row"] * keep_row)


def mix(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every input row as often as the mix takes it."""
    taken = mix_counts(spark, docs, keep_row=True, **options)
    copies = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies"))).otherwise(F.array().cast("array<bigint>"))
    return taken.select("row", F.explode(copies)).select("row.*")
