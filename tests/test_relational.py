import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidepool.functions import dates as D
from tidepool.functions import numbers as N
from tidepool.operators import aggregates as A
from tidepool.operators import joins as J
from tidepool.operators import sets as SE
from tidepool.operators import shape as SH
from tidepool.sources.generate import generate_rows, inline_values


def test_join_type_counts_fixture(spark):
    a = inline_values(spark, [(1,), (1,), (0,), (None,), (None,)], "column_a int")
    b = inline_values(spark, [(1,), (0,), (0,)], "column_b int")
    got = dict(J.join_type_counts(a, "column_a", b, "column_b").collect())
    assert got == {"inner": 4, "left": 6, "right": 4, "full outer": 6}


def test_join_type_counts_matches_real_joins(spark):
    import random

    rnd = random.Random(7)
    a = inline_values(spark, [(rnd.choice([None, 1, 2, 3, 4]),) for _ in range(60)], "x int")
    b = inline_values(spark, [(rnd.choice([None, 2, 3, 5]),) for _ in range(40)], "y int")
    got = dict(J.join_type_counts(a, "x", b, "y").collect())
    for name, how in J.JOIN_TYPES.items():
        assert got[name] == a.join(b, a.x == b.y, how).count(), name


def test_not_in_drops_nulls(spark):
    df = inline_values(spark, [("a",), (None,), ("b",)], "c string")
    assert [r.c for r in df.where(SH.not_in("c", ["b"])).collect()] == ["a"]


def test_sum_of_nothing(spark):
    df = inline_values(spark, [(1.0,)], "x double").where("x > 5")
    r = df.agg(F.sum("x").alias("s"), A.sum_or_zero("x").alias("z"), F.sum(F.coalesce("x", F.lit(0.0))).alias("n")).collect()[0]
    assert r.s is None and r.z == 0 and r.n is None


def test_text_vs_number(spark):
    r = spark.sql("SELECT '20' > '1000000' AS t, 20 > 1000000 AS n").collect()[0]
    assert r.t is True and r.n is False


def test_round_half_up_and_ratio(spark):
    r = spark.range(1).select(
        N.round_half_up(F.lit(1.005), 2).alias("a"), N.ratio(F.lit(1), F.lit(0)).alias("b"),
        N.ratio(F.lit("1"), F.lit("8")).alias("c"), N.truncate_int(F.lit(-2.7)).alias("d"),
        N.round_half_up(F.lit(0.0049999996), 2).alias("e"), N.round_half_up(F.lit(-2.675), 2).alias("f"),
    ).collect()[0]
    assert r.a == 1.01 and r.b is None and r.c == 0.13 and r.d == -2
    assert r.e == 0.0 and r.f == -2.68  # one rounding step


def test_month_calendar_and_left_join(spark):
    b = spark.createDataFrame([(dt.date(2023, 9, 1), dt.date(2024, 2, 10))], "s date, e date")
    cal = [r.periodo for r in D.month_calendar(b, "s", "e").collect()]
    assert len(cal) == 6 and cal[-1] == dt.date(2024, 2, 1)
    b2 = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 3, 1))], "s date, e date")
    facts = spark.createDataFrame(
        [(dt.date(2024, 2, 1), Decimal("1.00")), (dt.date(2024, 2, 1), Decimal("2.50"))], "periodo date, v decimal(18,2)"
    )
    out = J.calendar_left_join(D.month_calendar(b2, "s", "e"), facts, "periodo", ["v"]).collect()
    assert len(out) == 4
    assert sorted(r.v for r in out if r.periodo != dt.date(2024, 2, 1)) == [0, 0]


def test_relabel_case_and_table_agree(spark):
    df = inline_values(spark, [(f"k{i}",) for i in range(50)] + [(None,)], "c string")
    small = {"k1": "one", "k2": "two"}
    big = {f"k{i}": f"v{i}" for i in range(40)}
    assert {r.c for r in SH.relabel(df, "c", small).collect()} >= {"one", "two", "k3", None}
    via_table = {r.c for r in SH.relabel(df, "c", big).collect()}
    via_case = {r.c for r in df.select(SH.relabel_expr("c", big).alias("c")).collect()}
    assert via_table == via_case


def test_collect_ordered_and_sets(spark):
    df = inline_values(spark, [(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 1, "z")], "k int, p int, v string")
    got = {r.k: r.out for r in A.collect_ordered(df, "k", "p", "v", "out").collect()}
    assert got == {1: ["a", "b", "c"], 2: ["z"]}
    u = SE.union_all_labelled({"x": df.select("k"), "y": df.select("k")})
    assert u.count() == 8 and u.columns == ["label", "k"]
    assert SE.top_n(df, [("p", "desc"), ("v", "asc")], 1).collect()[0].v == "c"
    assert A.duplicate_groups(df.select("p")).collect()[0]["copies"] == 2


def test_generate_rows(spark):
    rows = generate_rows(spark, 5).collect()
    assert [r.name for r in rows] == [f"Name_{i}" for i in range(5)]


def test_relabel_gives_one_answer_at_any_size(spark):
    from tidepool.operators.shape import relabel

    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    small = {"a": "A", "b": None}
    large = small | {f"k{i}": str(i) for i in range(200)}
    for mapping in (small, large):
        assert [r["c"] for r in relabel(df, "c", mapping).collect()] == ["A", None, "z", None]


def test_join_counts_of_a_key_with_billions_of_rows(spark):
    """Products beyond a bigint's half are added up as decimals."""
    from tidepool.operators import joins as J

    a = spark.range(1).select(F.lit(1).alias("p")).union(spark.createDataFrame([(None,)], "p int"))
    got = {r["join_type"]: r["count"] for r in J.join_type_counts(a, "p", a.withColumnRenamed("p", "q"), "q").collect()}
    assert got == {"inner": 1, "left": 2, "right": 2, "full outer": 3}


def test_segments_hold_the_whole_order(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), (-F.col("id")).alias("o"), "id")
    got = A.collect_segments(df, "k", ["o"], "id", 7, "ids").collect()
    assert max(len(r["ids"]) for r in got) == 7
    whole = [i for r in sorted((r for r in got if r["k"] == 0), key=lambda r: r["segment"]) for i in r["ids"]]
    assert whole == sorted((r["id"] for r in df.where("k = 0").collect()), reverse=True)
