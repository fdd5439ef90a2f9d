"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.marks import key_marks, with_mark  # noqa: F401  (with_mark: for the operators)
from tidepool.session import scratch_path

#: Fixed pattern: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a key table that may be broadcast; a longer one is shuffled.
BROADCAST_ROWS = 1_000_000


def text_or_empty(name: str = "text") -> Column:
    """The text column with NULL read as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def landed(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files every executor sees, so a lost executor never
    forces the (expensive) part before it to run again.
    """
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_keys(df: DataFrame, keys: DataFrame, on: Column, how: str,
              broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a *landed* table of narrow keys.

    The key table is counted (a footer read) and broadcast up to
    ``broadcast_rows``; a longer one goes through a shuffle join that AQE
    splits where a key is hot.  Both ways give the same rows.
    """
    if keys.count() <= broadcast_rows:
        keys = F.broadcast(keys)
    return df.join(keys, on, how)


#: Bits of a key mark; its rows together are 16 MB, whatever the number of keys.
MARK_BITS = 1 << 27


def landed_marks(spark: SparkSession, keys: DataFrame, bit: Column, name: str) -> DataFrame:
    """A landed bitmap with the bit of every key set, at most ``MARK_BITS`` long."""
    return landed(spark, key_marks(keys, bit), name)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, as ``--py-files`` would.

    The driver packs a small archive once per application and Spark's own file
    transfer brings it to the executors, so they need no copy of the library.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tidepool-")), "tidepool_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


#: Bytes of rows in one Arrow batch where whole texts go to Python workers.
BATCH_BYTES = 8 << 20


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """Within it, jobs send rows to Python in batches of about ``BATCH_BYTES``.

    A batch lies in the JVM, outside its heap, and twice in the worker; Spark's
    own bound (10,000 rows or 64 MiB) is meant for narrow rows.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def release_memory() -> None:
    """Give memory that is free in this Python process back to the system.

    A worker outlives its task and waits beside the executor's JVM for the next
    one; without this it would keep the most that any of its tasks took.
    """
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError, TypeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)
