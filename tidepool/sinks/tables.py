"""Table writes and DDL: path tables, catalog tables, CTAS, external tables.

Formats: ``parquet`` is the default; ``csv``, ``json``, ``orc``, ``text`` and
``xml`` are built into Spark; ``delta``/``avro`` work when their packages are
on the classpath (they are not in this environment).

Re-runs and lost executors.  Every write is a Spark job whose tasks are
retried on another executor; output is committed only when the job
succeeds.  Replacing a table is done by writing a *new* folder and then
pointing the catalog entry at it, so a failed or repeated run never leaves a
half-written table behind and a query can read the old version of the table
it replaces (parquet tables have no ``CREATE OR REPLACE`` and cannot be
overwritten while being read).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidepool.session import checkpoint_root


def _opts(w, options: Mapping[str, str] | None):
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w


def write_path(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    options: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> str:
    """Write ``df`` to ``path`` (overwrite by default: re-running gives the same
    table, never duplicates).  ``options`` are passed through (e.g. CSV
    ``header``, table properties of a lakehouse format)."""
    w = _opts(df.write.format(fmt).mode(mode), options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def save_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> str:
    """``saveAsTable``: managed, or external when ``path`` is given."""
    w = _opts(df.write.format(fmt).mode(mode), options)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> str:
    return save_table(df, name, fmt=fmt, mode="append")


def drop_if_exists(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS``; files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def ctas_if_not_exists(spark: SparkSession, name: str, source_view: str, location: str, fmt: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS name USING fmt LOCATION 'loc' AS SELECT *
    FROM view``: a second call is a no-op."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{location}' AS SELECT * FROM {source_view}"
    )


def register_external(spark: SparkSession, name: str, location: str, fmt: str = "parquet") -> None:
    """Catalog entry over files that already exist (schema read from them)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{location}'")


def _same_shape(spark: SparkSession, name: str, df: DataFrame, fmt: str) -> bool:
    """Whether ``name`` is an unpartitioned external table with the columns of ``df`` in format ``fmt``."""
    if not spark.catalog.tableExists(name) or spark.table(name).dtypes != df.dtypes:
        return False
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return (about.get("Type") == "EXTERNAL" and about.get("Provider", "").lower() == fmt.lower()
            and "# Partition Information" not in about)


def replace_table(
    spark: SparkSession, name: str, df: DataFrame, fmt: str = "parquet", location_root: str | None = None
) -> str:
    """``CREATE OR REPLACE TABLE name [LOCATION ...] AS <df>`` for formats
    without it: write a fresh version folder, then point the catalog entry to
    it.  An external table of the same columns and format only changes its
    location, so readers always find it; any other is dropped and created.
    ``df`` may read ``name`` itself.  Returns the new location."""
    root = (location_root or f"{checkpoint_root(spark)}/tidepool/tables/{name}").rstrip("/")
    loc = f"{root}/v-{uuid.uuid4().hex[:12]}"
    write_path(df, loc, fmt=fmt)
    if _same_shape(spark, name, df, fmt):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{loc}'")
        spark.catalog.refreshTable(name)
    else:
        drop_if_exists(spark, name)
        register_external(spark, name, loc, fmt)
    return loc


def insert_select(spark: SparkSession, target: str, select_sql: str) -> None:
    """``INSERT INTO target <select>``; the select may read the target."""
    spark.sql(f"INSERT INTO {target} {select_sql}")


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    """``SHOW TBLPROPERTIES`` as a DataFrame ``(key, value)``."""
    return spark.sql(f"SHOW TBLPROPERTIES {name}")


def copy_table(spark: SparkSession, src: str, dst: str, fmt: str = "parquet", dst_fmt: str | None = None) -> str:
    """Read a path table and write it to another path."""
    return write_path(spark.read.format(fmt).load(src), dst, fmt=dst_fmt or fmt)
