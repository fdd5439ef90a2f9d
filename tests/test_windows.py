import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators import windows as W

SCHEMA = "st string, t int, v double"


def _max_change(spark, rows, ranges):
    df = spark.createDataFrame(rows, SCHEMA)
    return W.max_consecutive_change(df, "st", ["t"], "v", out="m", ranges=ranges).collect()[0]["m"]


@pytest.mark.parametrize("ranges", [1, 3, None])
def test_consecutive_change_fixture(spark, ranges):
    assert _max_change(spark, [("a", 1, 3.0), ("a", 2, 10.0), ("a", 3, 4.0)], ranges) == 7.0


@pytest.mark.parametrize("ranges", [1, 3])
def test_consecutive_change_with_null(spark, ranges):
    rows = [("a", 1, 3.0), ("a", 2, None), ("a", 3, 4.0)]
    assert _max_change(spark, rows, ranges) is None
    ch = W.consecutive_changes(spark.createDataFrame(rows, SCHEMA), "st", ["t"], "v", ranges=ranges).collect()
    assert len(ch) == 2 and all(r["change"] is None for r in ch)


def test_ranges_do_not_change_results(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id")))  # a hot key
    own = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = ev.select("event_id", F.row_number().over(own).cast("bigint").alias("n"), F.lag("value").over(own).alias("p"),
                      F.coalesce(F.sum("event_id").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("s"),
                      F.last(F.when(F.col("event_type") == "click", F.col("value")), True).over(own).alias("c"))
    want = sorted(map(tuple, plain.collect()))
    for ranges in (1, 2, 50):
        got = W.row_number_by_key(ev, "user_id", ["ts", "event_id"], out="n", ranges=ranges)
        got = W.lag_by_key(got, "user_id", ["ts", "event_id"], "value", out="p", ranges=ranges)
        got = W.running_sum_by_key(got, "user_id", ["ts", "event_id"], F.col("event_id"), out="s", ranges=ranges)
        got = W.carry_forward(got, "user_id", ["ts", "event_id"], F.when(F.col("event_type") == "click", F.col("value")), "c", ranges=ranges)
        assert sorted(map(tuple, got.select("event_id", "n", "p", "s", "c").collect())) == want
        assert got.where("NOT has_prev").count() == ev.select("user_id").distinct().count()


def test_a_hot_key_of_one_day_spreads(spark):
    """A third of all rows are one key at one instant; the plan reads and exchanges the big side once."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.lit(5).alias("t"), "id")
    splits = W.key_splits(df, ["k"], ["t", "id"], 48)
    assert splits.count() == 1 and 12 <= len(splits.first()["__tp_splits"]) <= 16
    rows = W._with_small(df, splits, ["k"]).withColumn("r", W._range_of(F.struct("t", "id")))
    shares = [r["count"] for r in rows.where("k = -1").groupBy("r").count().collect()]
    assert len(shares) >= 13 and max(shares) <= 2 * 3000 / len(shares)
    out = W.row_number_by_key(df, "k", ["t", "id"], ranges=48)
    plan = out._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert initial.count("Range (") == 1 and initial.count("Exchange hashpartitioning") == 1 and initial.count("Window") == 1
    assert {r["id"]: r["row_num"] for r in out.where("k = -1").collect()} == {3 * i: i + 1 for i in range(3000)}


def test_global_row_number(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"), F.when(F.col("id") % 10 != 0, F.col("id") % 4).alias("b"))
    want = [(r["b"], r["a"]) for r in df.orderBy(F.desc_nulls_last("b"), "a").collect()]
    got = W.global_row_number(df, [F.desc_nulls_last("b"), F.asc("a")], partitions=5).collect()
    assert sorted(r["row_num"] for r in got) == list(range(1, 1001))
    assert [(r["b"], r["a"]) for r in sorted(got, key=lambda r: r["row_num"])] == want
    assert W.global_row_number(df.limit(0), ["a"]).count() == 0


def test_carry_forward(spark):
    rows = [("c", i, (f"h{i}" if i in (1, 4, 9) else None)) for i in range(12)]
    df = spark.createDataFrame(rows, "k string, i int, v string")
    for ranges in (1, 6):
        got = {r["i"]: r["out"] for r in W.carry_forward(df, "k", ["i"], F.col("v"), "out", default=F.lit("-"), ranges=ranges).collect()}
        assert got[0] == "-" and got[3] == "h1" and got[8] == "h4" and got[11] == "h9"


def test_running_sum_and_bucket(spark):
    df = spark.createDataFrame([("p", i, i % 3 == 0) for i in range(10)], "k string, i int, f boolean")
    out = W.running_sum_by_key(df, "k", ["i"], F.col("f").cast("int"), out="n", ranges=4)
    got = {r["i"]: r["n"] for r in out.collect()}
    assert [got[i] for i in range(10)] == [0, 1, 1, 1, 2, 2, 2, 3, 3, 3]
    b = W.bucket_rows(spark.range(1, 8).withColumnRenamed("id", "rn"), "rn", 3).collect()
    assert [r["row_group"] for r in sorted(b)] == [0, 0, 0, 1, 1, 1, 2]


@pytest.mark.parametrize("ranges", [1, 6])
def test_null_keys_and_times(spark, ranges):
    rows = [(1, None, 10.0, 0), (1, 1, 13.0, 1), (1, 2, 20.0, 2), (None, 1, 1.0, 3), (None, 1, 5.0, 4), (None, None, 9.0, 5)]
    df = spark.createDataFrame(rows, "k int, t int, v double, id int")
    numbered = {r["id"]: r["row_num"] for r in W.row_number_by_key(df, "k", ["t", "id"], ranges=ranges).collect()}
    assert numbered == {0: 1, 1: 2, 2: 3, 5: 1, 3: 2, 4: 3}
    changes = W.consecutive_changes(df, "k", ["t", "id"], "v", ranges=ranges).collect()
    assert sorted(r["change"] for r in changes) == [3.0, 7.0]
    assert W.row_number_by_key(df.limit(0), "k", ["t", "id"]).count() == 0
