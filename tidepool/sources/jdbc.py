"""JDBC source.

The reference reads one database table through a single connection.  Here
the read is split into ``num_partitions`` range queries on a numeric or date
column, so the scan runs on all executors; filters and column selections
applied to the result are pushed into the generated SQL by Spark.
Connection details (URL, user, password, driver class) are always arguments,
never constants in code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Whole table (or ``(subquery) alias``) as a DataFrame, read in parallel
    when a partition column with bounds is given."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need lower_bound, upper_bound and num_partitions")
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
            .option("numPartitions", num_partitions)
        )
    return r.load()
