import uuid

import pytest
from pyspark.sql import functions as F

from tidepool.session import scratch_path
from tidepool.streaming import incremental as INC


def test_append_new_only_is_idempotent(spark):
    base = spark.range(0, 100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    name = f"tp_t_{uuid.uuid4().hex[:8]}"
    INC.create_keyed_table(base, name, ["k"], 4, scratch_path(spark, name))
    batch = spark.range(50, 150).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    INC.append_new_only(spark, batch.unionByName(batch), name, ["k"])
    assert spark.table(name).count() == 150
    INC.append_new_only(spark, batch, name, ["k"])
    t = spark.table(name)
    assert t.count() == 150 and t.select("k").distinct().count() == 150


def test_stream_dedupe_reruns(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("s_src", "s_out", "s_ck"))
    schema = "k bigint, ts timestamp"
    mk = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"), F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("ts"))
    mk(0, 100).write.parquet(f"{src}/d1")
    kw = dict(key=["k"], target=out, checkpoint=ckpt)
    INC.stream_dedupe(spark, f"{src}/*", schema, **kw)
    INC.stream_dedupe(spark, f"{src}/*", schema, **kw)
    assert spark.read.parquet(out).count() == 100
    mk(50, 150).write.parquet(f"{src}/d2")  # 50 seen + 50 new
    INC.stream_dedupe(spark, f"{src}/*", schema, **kw)
    assert spark.read.parquet(out).count() == 150
    # new records years older than all before are inserted, repeats of them are not
    old = spark.range(1000, 1010).select(F.col("id").alias("k"), F.timestamp_seconds(F.col("id")).alias("ts"))
    old.unionByName(old).unionByName(mk(0, 150)).write.parquet(f"{src}/d3")
    INC.stream_dedupe(spark, f"{src}/*", schema, **kw)
    assert spark.read.parquet(out).count() == 160


def test_stream_dedupe_with_a_bounded_state(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("s_src", "s_out", "s_ck"))
    rows = spark.range(0, 50).select(F.col("id").alias("k"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"))
    rows.unionByName(rows).write.parquet(f"{src}/d1")
    INC.stream_dedupe(spark, f"{src}/*", "k bigint, ts timestamp", ["k"], out, ckpt, event_time="ts", delay="1 day")
    assert spark.read.parquet(out).count() == 50


def test_a_batch_run_twice_adds_nothing(spark):
    """Batches write by their id, keep no state, and match NULL keys."""
    out = scratch_path(spark, "s_merge")
    first = spark.createDataFrame([(1, "a"), (1, "a"), (None, "n"), (2, "b")], "k int, v string")
    second = spark.createDataFrame([(2, "again"), (None, "again"), (3, "c"), (3, "c2")], "k int, v string")
    for batch, number in ((first, 0), (second, 1), (second, 1), (first, 0), (second, 2)):
        INC.merge_batch(batch, number, ["k"], out)
    rows = spark.read.parquet(out).collect()
    assert sorted((r["k"] is not None, r["k"] or 0) for r in rows) == [(False, 0), (True, 1), (True, 2), (True, 3)]
    assert {r["batch"] for r in rows} == {0, 1}


def test_stream_keeps_no_state(spark):
    import os

    src, out, ckpt = (scratch_path(spark, n) for n in ("s_src", "s_out", "s_ck"))
    spark.range(20).selectExpr("id AS k").write.parquet(f"{src}/d1")
    INC.stream_dedupe(spark, f"{src}/*", "k bigint", ["k"], out, ckpt)
    assert spark.read.parquet(out).count() == 20 and not os.path.exists(f"{ckpt.removeprefix('file:')}/state")


def test_only_touched_partitions_are_read(spark):
    out = scratch_path(spark, "s_parts")
    mk = lambda a, b: spark.range(a, b).selectExpr("id AS k", "CAST(id DIV 100 AS INT) AS day", "id * 2 AS v")
    assert INC.append_new_by_partition(spark, mk(0, 3000), out, ["k"], "day") == []
    touched = INC.append_new_by_partition(spark, mk(1250, 1350).unionByName(mk(3000, 3100)), out, ["k"], "day")
    assert {12, 13} <= set(touched) and len(touched) <= 6
    t = spark.read.parquet(out)
    assert t.count() == 3100 == t.select("k").distinct().count()
    assert INC.append_new_by_partition(spark, mk(2900, 3200), out, ["k"], "day") and spark.read.parquet(out).count() == 3200
    # the same key under another partition value is the same record; NULL keys match
    odd = spark.createDataFrame([(5, 99, 1), (None, 7, 1), (None, None, 2)], "k long, day int, v long")
    for _ in range(2):
        INC.append_new_by_partition(spark, odd, out, ["k"], "day")
        assert spark.read.parquet(out).count() == 3201


def test_bitmaps_meet_not_keys(spark):
    """The rows that the partitions' marks are compared with don't grow with the batch."""
    from tidepool.operators.marks import key_marks, mark_bit

    table = spark.range(40_000).selectExpr("id AS k", "CAST(id DIV 10000 AS INT) AS day")
    sketch = key_marks(table, mark_bit(["k"], INC.PARTITION_BITS), ["day"], least=F.min("k"), most=F.max("k"))
    asked = lambda *some: sorted(INC.touched_partitions(spark.createDataFrame([(k,) for k in some], "k long"), sketch, ["k"], "day"))
    assert asked(15_000) == [1] and {0, 3} <= set(asked(5, 39_999)) and asked(70_000) == [] == asked()
    # no key is joined: the batch is aggregated to bitmap rows first
    joined = []
    plain = type(sketch).join
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(sketch), "join", lambda a, b, *more: joined.append(min(a.count(), b.count())) or plain(a, b, *more))
        assert sorted(INC.touched_partitions(table, sketch, ["k"], "day")) == [0, 1, 2, 3]
    assert joined == [32]
