"""The corpus pipeline: language ID, exact and near de-duplication, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns
of their input.  ``run`` writes each result as Parquet below
``spark.checkpoint.dir`` and reads it back as the next stage's input.
Defined results for NULLs, empty texts, ties, repeated rows, empty tables and
extra columns are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import exact_dedup, langid, mixing, simhash
from tidepool.llm.common import landed, small_batches
from tidepool.llm.queries import PIECES, packed_digests
from tidepool.session import read_table

#: Least posterior of a predicted language.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language; texts without letters, undecided ones and
    those that are unlikely in every learned language go."""
    model = langid.fit(spark, docs, PIECES, sample_rows=None)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    # landed, as the bounds come from the scores of all labelled rows
    with small_batches(spark):
        scored = landed(spark, docs.select(row, langid.predict(spark, model, F.col("text")).alias("p")), "langid-scored")
    least = langid.least_likelihoods(spark, scored.select("row.lang", "p"), model)
    floor = F.coalesce(*[F.when(F.col("p.lang_pred") == k, F.lit(v)) for k, v in least.items()], F.lit(float("-inf")))
    return scored.where((F.col("p.lang_pred") != langid.UNKNOWN) & (F.col("p.score") >= LEAST_SCORE)
                        & (F.col("p.per_letter") >= floor)).select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text."""
    return exact_dedup.exact_dedup(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.near_dedup(spark, docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(spark, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the training windows."""
    return packed_digests(spark, docs)


STAGES = [("language ID", language), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("mixing sources", mixed), ("packing", packed)]

#: SQL can't express language ID, near-dedup and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(spark, stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
