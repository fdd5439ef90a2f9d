"""Incremental, duplicate-free loading.

Three forms of "later runs insert only new records; re-running never
duplicates":

* **batch** (:func:`append_new_only`): de-duplicate the incoming batch on the
  key, anti-join it against the target table, append the rest.  Running the
  same batch twice appends nothing the second time.  When the target is
  bucketed on the key (:func:`create_keyed_table`), the anti-join reads the
  target without shuffling it; only the (small) batch is shuffled.
* **by partition** (:func:`append_new_by_partition`): the same against a table
  partitioned by date, say, of which only the partitions that may hold a key of
  the batch are read; marks and bounds of each partition's keys lie beside it.
* **streaming** (:func:`stream_dedupe`): a file-source stream run with
  ``trigger(availableNow=True)``: each run processes only files not seen by the
  checkpoint.  Every micro-batch is merged by an anti-join against the keys that
  the batches before it have written, and written to a folder named by its
  batch id; no state is kept, and a record that was never seen is inserted
  however late it comes.  A batch that is run again reads the same earlier
  batches and replaces its own folder, so a lost executor, driver or a re-run
  never writes a record twice.  Where records can't come later than some delay
  after the newest one, ``delay`` drops duplicates by a watermark instead, with
  a state of that delay; a record beyond it is then dropped, seen or not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidepool.operators.marks import key_marks, mark_bit
from tidepool.session import checkpoint_root, landed


def create_keyed_table(
    df: DataFrame, name: str, key: Sequence[str], buckets: int, path: str, fmt: str = "parquet"
) -> str:
    """Create a catalog table bucketed and sorted on ``key`` at ``path``."""
    (
        df.write.format(fmt).mode("overwrite").option("path", path)
        .bucketBy(buckets, *key).sortBy(*key).saveAsTable(name)
    )
    return name


def new_rows(spark: SparkSession, batch: DataFrame, target: str, key: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in table ``target`` (one per key)."""
    return rows_without(batch.dropDuplicates(list(key)), spark.table(target), key)


def rows_without(rows: DataFrame, seen: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key isn't among those of ``seen``; NULLs match."""
    known = seen.select(*key)
    whole = reduce(and_, [F.col(k).isNotNull() for k in key])
    fresh = rows.where(whole).join(known, list(key), "left_anti")
    # keys with a NULL match null-safe, and apart: only such rows of the target are read for them
    partial = known.where(~whole).toDF(*[f"_known_{k}" for k in key])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in key])
    return fresh.unionByName(rows.where(~whole).join(partial, same, "left_anti"))


def append_new_only(spark: SparkSession, batch: DataFrame, target: str, key: Sequence[str]) -> None:
    """Append the new rows of ``batch`` to ``target``.

    The new rows are materialised first (a staging table in the shared
    checkpoint folder via ``checkpoint()``), because the anti-join reads the
    table it appends to.
    """
    checkpoint_root(spark)
    fresh = new_rows(spark, batch, target, key).checkpoint(eager=True)
    cols = spark.table(target).columns
    fresh.select(*cols).write.insertInto(target)


#: Bits of the marks of one partition's keys (32 rows of 4 KB at most).
PARTITION_BITS = 1 << 20


def touched_partitions(batch: DataFrame, sketch: DataFrame, key: Sequence[str], partition: str) -> list:
    """Partitions of the target that may hold a key of ``batch``: the partition's marks share
    a bit with those of the batch and the bounds of their first column overlap (NULLs within
    all).  Bitmaps meet, not keys, so the work is that of one pass over the batch and
    of the bitmaps of the partitions.  One value per partition at most."""
    asked = batch.withColumn("_bit", mark_bit(list(key), PARTITION_BITS))
    asked = asked.groupBy(F.bitmap_bucket_number("_bit").alias("marks_no")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_marks"), F.min(key[0]).alias("_least"), F.max(key[0]).alias("_most"),
        F.bool_or(F.col(key[0]).isNull()).alias("_null"))
    met = sketch.withColumn("_row", F.monotonically_increasing_id()).join(asked, "marks_no")
    met = met.where(F.col("_null") | F.col("least").isNull() | ((F.col("_least") <= F.col("most")) & (F.col("_most") >= F.col("least"))))
    both = met.select("_row", partition, F.explode(F.array("marks", "_marks")).alias("_bits"))
    shared = both.groupBy("_row", partition).agg(F.bitmap_and_agg("_bits").alias("_bits")).where(F.bitmap_count("_bits") > 0)
    return [r[0] for r in shared.select(partition).distinct().collect()]


def append_new_by_partition(spark: SparkSession, batch: DataFrame, target: str, key: Sequence[str], partition: str) -> list:
    """Append the rows of ``batch`` whose key is new to the parquet table at ``target``,
    partitioned by ``partition``; the partitions that had to be read.

    Beside the table (``<target>_keys``) lie marks and bounds of the keys of each
    partition.  Only partitions that may hold a key of the batch are read for the
    anti-join, whatever the size of the table.  Marks are written before the
    rows they stand for, so an append that broke off in between, or runs again,
    leaves marks that are too many at worst.
    """
    rows, sketches = landed(spark, batch.dropDuplicates(list(key)), "batch"), f"{target}_keys"
    first = rows.schema[key[0]].dataType.simpleString()
    kind = rows.schema[partition].dataType.simpleString()
    shape = f"{partition} {kind}, marks_no long, marks binary, least {first}, most {first}"
    landed(spark, spark.createDataFrame([], shape), "none").write.mode("append").parquet(sketches)  # so that there is one to read
    touched = touched_partitions(rows, spark.read.schema(shape).parquet(sketches), key, partition)
    if touched:
        same = reduce(or_, [F.col(partition).eqNullSafe(F.lit(v).cast(kind)) for v in touched])
        rows = rows_without(rows, spark.read.schema(rows.schema).parquet(target).where(same), key)
    fresh = landed(spark, rows, "fresh")
    # bounds of the keys of each bitmap row: they hold for the keys whose bits it has
    marks = key_marks(fresh, mark_bit(list(key), PARTITION_BITS), [partition], least=F.min(key[0]), most=F.max(key[0]))
    marks.write.mode("append").parquet(sketches)
    fresh.write.mode("append").partitionBy(partition).parquet(target)
    return touched


def merge_batch(batch: DataFrame, batch_id: int, key: Sequence[str], target: str, fmt: str = "parquet") -> None:
    """Write the batch's new records to ``target/batch=<id>``: those whose key no
    earlier batch has, one per key.  Running a batch again changes nothing."""
    rows = batch.dropDuplicates(list(key))
    if batch_id > 0:
        columns = StructType([*batch.schema.fields, StructField("batch", LongType())])
        earlier = batch.sparkSession.read.format(fmt).schema(columns).load(target)
        rows = rows_without(rows, earlier.where(F.col("batch") < batch_id), key)
    rows.write.format(fmt).mode("overwrite").save(f"{target}/batch={batch_id}")


def stream_dedupe(
    spark: SparkSession,
    source: str,
    schema: str,
    key: Sequence[str],
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    event_time: str | None = None,
    delay: str | None = None,
) -> None:
    """Run one incremental pass over new files in ``source`` and append the
    records whose ``key`` was not seen before to ``target``, one folder
    ``batch=<id>`` per micro-batch.  With ``event_time`` and ``delay`` keys are
    remembered for that delay only, and the files lie in ``target`` itself."""
    stream = spark.readStream.format(fmt).schema(schema).load(source)
    if event_time and delay:
        timed = stream.withColumn("_event_time", F.col(event_time).cast("timestamp")).withWatermark("_event_time", delay)
        stream = timed.dropDuplicatesWithinWatermark(list(key)).drop("_event_time")
        writer = stream.writeStream.format(fmt).option("path", target)
    else:
        writer = stream.writeStream.foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, key, target, fmt))
    q = writer.option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
