"""Generated and inline relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def generate_rows(spark: SparkSession, n: int, num_partitions: int | None = None) -> DataFrame:
    """``n`` rows ``(id, "Name_<id>")`` generated on the executors
    (``spark.range``), not as a driver-side list."""
    return spark.range(0, n, 1, num_partitions).select(
        F.col("id"), F.concat(F.lit("Name_"), F.col("id").cast("string")).alias("name")
    )


def inline_values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal relation (``VALUES``) with a DDL schema, e.g.
    ``"column_a int"``.  For literals only; its size is the caller's list."""
    return spark.createDataFrame(list(rows), schema)
