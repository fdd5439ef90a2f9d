"""Exact de-duplication by progressive refinement.

Rows are grouped by text length, then by a hash of the text's beginning, then
by the SHA-256 of the whole text.  Each step looks only at the groups of two
or more rows that the one before left, so the whole text is hashed only where
length and beginning agree.  Only DataFrame functions run.

Every group step is an aggregate that combines before its shuffle.  The shared
(length, beginning) keys mark bits of a bitmap of bounded size, which is
broadcast; a row whose bit is set has its text hashed, one without a partner
too if its bit is shared, which the last step sets right.  ``exact_groups``
moves no text, however many keys there are; ``exact_dedup`` moves the rows
that share a hash with another one, or a bit.  A group of copies that holds a
third of all rows is one row per task.  A very long text is read whole for its
hash (one row, at most Spark's 2 GiB).

Defined results: NULL equals the empty text.  Of equal texts the row with the
largest id stays; a NULL id counts as the smallest.  Rows repeated with the
same id are one document: ``exact_groups`` shows them alike, ``exact_dedup``
keeps one.  An empty table gives no rows; other columns, whatever their
names, travel in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import MARK_BITS, join_keys, landed, landed_marks, text_or_empty, with_mark

#: Characters of a text that the second step hashes.
PREFIX_CHARS = 64


def _full_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _bit(length: Column, prefix: Column) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(MARK_BITS))


def _suspects(spark: SparkSession, docs: DataFrame, text_col: str) -> DataFrame:
    """Landed marks of the (length, prefix) keys that two or more rows share."""
    text = text_or_empty(text_col)
    lengths = landed(spark, docs.select(F.octet_length(text).alias("len1")).groupBy("len1")
                     .agg(F.count("*").alias("n")).where("n > 1").select("len1"), "exact-lengths")
    begin = docs.select(F.octet_length(text).alias("len"),
                        F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix"))
    begin = join_keys(begin, lengths, F.col("len") == F.col("len1"), "left_semi")
    shared = begin.groupBy("len", "prefix").agg(F.count("*").alias("n")).where("n > 1")
    return landed_marks(spark, shared, _bit(F.col("len"), F.col("prefix")), "exact-prefixes")


def _marked(spark: SparkSession, docs: DataFrame, text_col: str, columns: list[Column]) -> DataFrame:
    """``columns`` (over the struct ``row``) plus ``hash``: the full hash where
    length and beginning are shared, else NULL."""
    marks = _suspects(spark, docs, text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    bit = _bit(F.octet_length(text), F.xxhash64(F.substring(text, 1, PREFIX_CHARS)))
    return with_mark(rows, marks, bit, "found").select(*columns, F.when(F.col("found"), _full_hash(text)).alias("hash"))


def exact_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept``.

    ``digest`` adds ``text_sha256``, the full hash of every text as an output
    column; the grouping never uses it for rows that dropped out early.
    """
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    columns = [F.col("row")[id_col].alias("doc_id")]
    if digest:
        columns.append(_full_hash(text).alias("text_sha256"))
    rows = landed(spark, _marked(spark, docs.select(id_col, text_col), text_col, columns), "exact-rows")
    extra = ["text_sha256"] if digest else []
    # landed, so that the join has a shuffle on either side and AQE can split a hot hash
    groups = landed(spark, rows.where("hash is not null").groupBy("hash")
                    .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                    .where("group_size > 1").withColumnRenamed("hash", "group_hash"), "exact-groups")
    alone = rows.where("hash is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), *extra)
    several = rows.where("hash is not null").join(groups, F.col("hash") == F.col("group_hash"), "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), *extra)
    return alone.unionByName(several)


def exact_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input with one row per text, all its columns as they were.

    The row that stays is the largest by id (then by its other sortable
    columns), found with an aggregate that keeps one row per text and task
    before the shuffle.
    """
    rest = [c for c, kind in docs.dtypes
            if c not in (id_col, text_col) and "map<" not in kind and "variant" not in kind]
    order = F.struct(*[F.col("row")[c].alias(f"c{i}") for i, c in enumerate([id_col, *rest])])
    rows = _marked(spark, docs, text_col, [F.col("row"), order.alias("order")])
    alone = rows.where("hash is null").select("row")
    best = rows.where("hash is not null").groupBy("hash").agg(F.max_by("row", "order").alias("row")).select("row")
    return alone.unionByName(best).select("row.*")
