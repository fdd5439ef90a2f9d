"""Relational queries over the driver tables: projections, filters, joins,
aggregates, windows, sorts, set operations, math, dates, JSON paths, arrays
and string predicates.

Table mapping (the reference's inputs -> driver tables): weather stations and
readings -> ``events`` (station = ``user_id``, reading = ``value``, JSON =
``props``); expense amounts and periods -> ``orders``/``lineitem``; the
"gender entries" numeric CSV -> numeric columns of ``lineitem``; athletes ->
``customer``; feature vectors -> ``embeddings``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidepool.functions import dates as D
from tidepool.functions import numbers as N
from tidepool.functions import strings as S
from tidepool.operators import aggregates as A
from tidepool.operators import joins as J
from tidepool.operators import sets as SE
from tidepool.operators import shape as SH
from tidepool.operators import windows as W
from tidepool.plans.registry import register
from tidepool.session import read_table


def _t(spark: SparkSession, sf: str, name: str):
    return read_table(spark, sf, name)


# --------------------------------------------------------------------------
# windows: consecutive change (the weather "max wind change" metric)
# --------------------------------------------------------------------------


@register(
    "win_consecutive_change",
    """
    SELECT MAX(ABS(value - earlier)) AS max_value_change
    FROM (SELECT value, any_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS earlier
          FROM events WHERE user_id IS NOT NULL)
    """,
)
def win_consecutive_change(spark, sf):
    ev = _t(spark, sf, "events")
    return W.max_consecutive_change(
        ev, "user_id", ["ts", "event_id"], "value", out="max_value_change"
    )


@register(
    "win_max_change_per_key",
    """
    SELECT user_id, MAX(ABS(value - earlier)) AS max_value_change
    FROM (SELECT user_id, value, COUNT(*) OVER earlier_one AS has_earlier, any_value(value) OVER earlier_one AS earlier
          FROM events WHERE user_id IS NOT NULL
          WINDOW earlier_one AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING))
    WHERE has_earlier > 0 GROUP BY user_id
    """,
)
def win_max_change_per_key(spark, sf):
    ev = _t(spark, sf, "events")
    return W.max_consecutive_change(
        ev, "user_id", ["ts", "event_id"], "value", out="max_value_change", per_key=True
    )


@register(
    "win_row_number",
    """
    SELECT event_id, user_id,
           CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS row_num
    FROM events
    """,
)
def win_row_number(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "user_id", "ts")
    return W.row_number_by_key(ev, "user_id", ["ts", "event_id"]).select("event_id", "user_id", "row_num")


@register(
    "win_global_row_number",
    "SELECT o_orderkey, CAST(ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS row_num FROM orders",
)
def win_global_row_number(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return W.global_row_number(o, [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_orderkey", "row_num")


@register(
    "win_bucket_rows",
    """
    SELECT event_id, user_id,
           CAST(FLOOR((ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) / 10) AS BIGINT)
             AS row_group
    FROM events
    """,
)
def win_bucket_rows(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "user_id", "ts")
    rn = W.row_number_by_key(ev, "user_id", ["ts", "event_id"])
    return W.bucket_rows(rn, "row_num", 10).select("event_id", "user_id", "row_group")


@register(
    "win_carry_forward",
    """
    SELECT c.conv_id, c.turn,
           (SELECT MAX(u.turn) FROM conversations u
             WHERE u.conv_id = c.conv_id AND u.turn <= c.turn AND u.role = 'user') AS last_user_turn
    FROM conversations c
    """,
)
def win_carry_forward(spark, sf):
    cv = _t(spark, sf, "conversations")
    out = W.carry_forward(
        cv.select("conv_id", "turn", "role"), "conv_id", ["turn"], F.when(F.col("role") == "user", F.col("turn")), "last_user_turn",
    )
    return out.select("conv_id", "turn", "last_user_turn")


# --------------------------------------------------------------------------
# projections
# --------------------------------------------------------------------------


@register(
    "proj_columns",
    "SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_quantity AS quantity FROM lineitem",
)
def proj_columns(spark, sf):
    li = _t(spark, sf, "lineitem")
    return SH.select_as(li, {"l_orderkey": "order_id", "l_linenumber": "line_no", "l_quantity": "quantity"})


@register(
    "proj_star_derived",
    "SELECT *, concat(c_name, '/', c_mktsegment) AS label FROM customer",
)
def proj_star_derived(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("*", F.concat(F.col("c_name"), F.lit("/"), F.col("c_mktsegment")).alias("label"))


@register(
    "proj_literal",
    "SELECT o_orderkey, 1 AS flag, 'UTC' AS station_timezone FROM orders",
)
def proj_literal(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey")
    return SH.with_literals(o, {"flag": 1, "station_timezone": "UTC"})


@register(
    "proj_drop_rename",
    "SELECT c_custkey, c_nationkey, c_mktsegment AS segment FROM customer",
)
def proj_drop_rename(spark, sf):
    c = _t(spark, sf, "customer")
    return SH.drop_rename(c, drop=["c_name", "c_acctbal"], rename={"c_mktsegment": "segment"})


@register(
    "proj_cast",
    """
    SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
           CAST(o_custkey AS VARCHAR) AS cust, CAST(o_orderdate AS DATE) AS order_date
    FROM orders
    """,
)
def proj_cast(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        N.money("o_totalprice").alias("total"),
        F.col("o_custkey").cast("string").alias("cust"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


@register(
    "proj_case_relabel",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent'
                WHEN o_orderpriority = '2-HIGH' THEN 'high'
                ELSE o_orderpriority END AS priority
    FROM orders
    """,
)
def proj_case_relabel(spark, sf):
    o = _t(spark, sf, "orders")
    out = SH.relabel(o, "o_orderpriority", {"1-URGENT": "urgent", "2-HIGH": "high"}, out="priority")
    return out.select("o_orderkey", "priority")


@register(
    "proj_case_relabel_table",
    """
    SELECT p_partkey,
           CASE WHEN regexp_matches(p_brand, '^Brand#([1-9]|[1-3][0-9]|40)$')
                THEN 'B' || lpad(substr(p_brand, 7), 3, '0') ELSE p_brand END AS brand
    FROM part
    """,
)
def proj_case_relabel_table(spark, sf):
    # 40 entries in one map literal
    mapping = {f"Brand#{i}": f"B{i:03d}" for i in range(1, 41)}
    p = _t(spark, sf, "part")
    return SH.relabel(p, "p_brand", mapping, out="brand").select("p_partkey", "brand")


@register(
    "proj_case_swap",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE o_orderstatus END AS item
    FROM orders
    """,
)
def proj_case_swap(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", SH.choose(F.col("o_orderstatus") == "F", "o_orderpriority", "o_orderstatus").alias("item"))


# --------------------------------------------------------------------------
# filters
# --------------------------------------------------------------------------


@register("filter_eq", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(spark, sf):
    return _t(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")


@register(
    "filter_neq_columns",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_tax != l_discount",
)
def filter_neq_columns(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.where(F.col("l_tax") != F.col("l_discount")).select("l_orderkey", "l_linenumber")


@register(
    "filter_and",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'",
)
def filter_and(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).select("l_orderkey", "l_linenumber")


@register(
    "filter_not_null",
    """
    SELECT l_orderkey, l_linenumber, ratio FROM (
      SELECT l_orderkey, l_linenumber, l_discount / NULLIF(l_tax, 0) AS ratio FROM lineitem)
    WHERE ratio IS NOT NULL
    """,
)
def filter_not_null(spark, sf):
    li = _t(spark, sf, "lineitem")
    r = li.select("l_orderkey", "l_linenumber", F.try_divide("l_discount", "l_tax").alias("ratio"))
    return r.where(F.col("ratio").isNotNull())


@register(
    "filter_in",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def filter_in(spark, sf):
    o = _t(spark, sf, "orders")
    return o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@register(
    "filter_not_in",
    """
    SELECT o_orderkey, prio FROM (
      SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS prio FROM orders)
    WHERE prio NOT IN ('5-LOW')
    """,
)
def filter_not_in(spark, sf):
    o = _t(spark, sf, "orders")
    p = o.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("prio"))
    return p.where(SH.not_in("prio", ["5-LOW"]))


@register(
    "filter_ilike",
    "SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%red%'",
)
def filter_ilike(spark, sf):
    p = _t(spark, sf, "part")
    return p.where(SH.ilike_contains("p_name", "Red")).select("p_partkey", "p_name")


@register(
    "filter_trailing_days",
    """
    SELECT event_id, user_id FROM events
    WHERE ts >= DATE '2024-01-20' - INTERVAL 7 DAY AND ts <= DATE '2024-01-20'
    """,
)
def filter_trailing_days(spark, sf):
    ev = _t(spark, sf, "events")
    return ev.where(D.trailing_days("ts", F.lit("2024-01-20").cast("date"), 7)).select("event_id", "user_id")


@register(
    "filter_last_calendar_week",
    """
    SELECT event_id, user_id FROM events
    WHERE ts >= date_trunc('week', DATE '2024-01-17') - INTERVAL 7 DAY
      AND ts < date_trunc('week', DATE '2024-01-17')
    """,
)
def filter_last_calendar_week(spark, sf):
    ev = _t(spark, sf, "events")
    return ev.where(D.last_calendar_week("ts", F.lit("2024-01-17").cast("date"))).select("event_id", "user_id")


@register(
    "filter_period",
    """
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo,
           CAST(date_trunc('month', o_orderdate) AS DATE) = DATE '1998-04-01' AS is_layout_2
    FROM orders
    WHERE CAST(date_trunc('month', o_orderdate) AS DATE) >= DATE '1998-04-01'
    """,
)
def filter_period(spark, sf):
    ref = F.lit("1998-04-01").cast("date")  # a month is on or after it if its days are: the filter reaches the scan
    o = _t(spark, sf, "orders").where(F.col("o_orderdate") >= ref)
    o = o.select("o_orderkey", D.first_of_month("o_orderdate").alias("periodo"))
    return o.withColumn("is_layout_2", F.col("periodo") == ref)


@register(
    "cmp_string_vs_number",
    """
    SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) > '1000000' AS text_gt,
           o_orderkey > 1000000 AS num_gt
    FROM orders
    """,
)
def cmp_string_vs_number(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        (F.col("o_orderkey").cast("string") > F.lit("1000000")).alias("text_gt"),
        (F.col("o_orderkey") > F.lit(1000000)).alias("num_gt"),
    )


# --------------------------------------------------------------------------
# joins
# --------------------------------------------------------------------------


@register(
    "join_type_counts",
    """
    WITH a AS (SELECT c_nationkey AS customer_nation FROM customer),
         b AS (SELECT s_nationkey AS supplier_nation FROM supplier)
    SELECT 'inner' AS join_type, COUNT(*) AS count FROM a INNER JOIN b ON customer_nation = supplier_nation
    UNION ALL SELECT 'left', COUNT(*) FROM a LEFT JOIN b ON customer_nation = supplier_nation
    UNION ALL SELECT 'right', COUNT(*) FROM a RIGHT JOIN b ON customer_nation = supplier_nation
    UNION ALL SELECT 'full outer', COUNT(*) FROM a FULL OUTER JOIN b ON customer_nation = supplier_nation
    """,
)
def join_type_counts(spark, sf):
    return J.join_type_counts(_t(spark, sf, "customer"), "c_nationkey", _t(spark, sf, "supplier"), "s_nationkey")


@register(
    "join_type_counts_orders",
    """
    WITH a AS (SELECT o_custkey AS order_cust FROM orders WHERE o_orderstatus <> 'F'),
         b AS (SELECT c_custkey AS cust FROM customer WHERE c_mktsegment <> 'BUILDING')
    SELECT 'inner' AS join_type, COUNT(*) AS count FROM a INNER JOIN b ON order_cust = cust
    UNION ALL SELECT 'left', COUNT(*) FROM a LEFT JOIN b ON order_cust = cust
    UNION ALL SELECT 'right', COUNT(*) FROM a RIGHT JOIN b ON order_cust = cust
    UNION ALL SELECT 'full outer', COUNT(*) FROM a FULL OUTER JOIN b ON order_cust = cust
    """,
)
def join_type_counts_orders(spark, sf):
    a = _t(spark, sf, "orders").where(F.col("o_orderstatus") != "F")
    b = _t(spark, sf, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return J.join_type_counts(a, "o_custkey", b, "c_custkey")


@register(
    "join_type_counts_null_keys",
    """
    WITH p AS (SELECT CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END AS k FROM orders),
         q AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey END AS k FROM customer)
    SELECT 'inner' AS join_type, COUNT(*) AS count FROM p INNER JOIN q ON p.k = q.k
    UNION ALL SELECT 'left', COUNT(*) FROM p LEFT JOIN q ON p.k = q.k
    UNION ALL SELECT 'right', COUNT(*) FROM p RIGHT JOIN q ON p.k = q.k
    UNION ALL SELECT 'full outer', COUNT(*) FROM p FULL OUTER JOIN q ON p.k = q.k
    """,
)
def join_type_counts_null_keys(spark, sf):
    p = _t(spark, sf, "orders").select(F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("p_key"))
    q = _t(spark, sf, "customer").select(F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("q_key"))
    return J.join_type_counts(p, "p_key", q, "q_key")


@register(
    "join_right_outer",
    """
    SELECT o.o_orderkey, c.c_custkey, c.c_mktsegment
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS k FROM orders WHERE o_orderstatus = 'P') o
    RIGHT JOIN (SELECT CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey END AS c_custkey, c_mktsegment FROM customer) c ON o.k = c.c_custkey
    """,
)
def join_right_outer(spark, sf):
    o = _t(spark, sf, "orders").where(F.col("o_orderstatus") == "P")
    o = o.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("k"))
    c = _t(spark, sf, "customer").select(F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey")).alias("c_custkey"), "c_mktsegment")
    return o.join(c, o["k"] == c["c_custkey"], "right").select("o_orderkey", "c_custkey", "c_mktsegment")


@register(
    "agg_collect_segments",
    """
    SELECT user_id, CAST((row_num - 1) // 16 AS BIGINT) AS segment, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY row_num) AS event_ids
    FROM (SELECT user_id, event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_num FROM events)
    GROUP BY user_id, (row_num - 1) // 16
    """,
)
def agg_collect_segments(spark, sf):
    ev = _t(spark, sf, "events").select("user_id", "ts", "event_id")
    parts = A.collect_segments(ev, "user_id", ["ts", "event_id"], "event_id", 16, "ids")
    return parts.select("user_id", "segment", F.array_join(F.col("ids").cast("array<string>"), ",").alias("event_ids"))


@register(
    "join_inner",
    """
    SELECT l.l_orderkey, l.l_linenumber, o.o_orderpriority
    FROM lineitem l INNER JOIN orders o ON l.l_orderkey = o.o_orderkey
    WHERE o.o_orderstatus = 'F'
    """,
)
def join_inner(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    o = _t(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select("l_orderkey", "l_linenumber", "o_orderpriority")


@register(
    "join_full_outer",
    """
    SELECT c.c_custkey, o.o_orderkey
    FROM (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') c
    FULL OUTER JOIN (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') o
      ON c.c_custkey = o.o_custkey
    """,
)
def join_full_outer(spark, sf):
    c = _t(spark, sf, "customer").where(F.col("c_mktsegment") == "MACHINERY").select("c_custkey")
    o = _t(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_custkey")
    return c.join(o, c.c_custkey == o.o_custkey, "full").select("c_custkey", "o_orderkey")


@register(
    "report_calendar_left_join",
    """
    WITH cal AS (
      SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                         date_trunc('month', max(o_orderdate)),
                                         INTERVAL 1 MONTH)) AS DATE) AS periodo
      FROM orders),
    facts AS (
      SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo, o_orderpriority,
             SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS valor, COUNT(*) AS n_orders
      FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
      GROUP BY 1, 2)
    SELECT cal.periodo, facts.o_orderpriority,
           CAST(COALESCE(facts.valor, 0) AS DECIMAL(38,2)) AS valor,
           COALESCE(facts.n_orders, 0) AS n_orders
    FROM cal LEFT JOIN facts ON cal.periodo = facts.periodo
    """,
)
def report_calendar_left_join(spark, sf):
    o = _t(spark, sf, "orders")
    cal = D.month_calendar(o.agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e")), "s", "e")
    facts = (
        o.where((F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .groupBy(D.first_of_month("o_orderdate").alias("periodo"), "o_orderpriority")
        .agg(F.sum(N.money("o_totalprice")).cast("decimal(38,2)").alias("valor"), F.count(F.lit(1)).alias("n_orders"))
    )
    return J.calendar_left_join(cal, facts, "periodo", fill_zero=["valor", "n_orders"])


# --------------------------------------------------------------------------
# aggregates
# --------------------------------------------------------------------------


@register(
    "agg_avg",
    """
    SELECT CAST(ROUND(CAST(CAST(CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_quantity) AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE) AS avg_quantity,
           CAST(ROUND(CAST(CAST(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_extendedprice) AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE) AS avg_price
    FROM lineitem
    """,
)
def agg_avg(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.agg(N.avg_exact("l_quantity").alias("avg_quantity"), N.avg_exact("l_extendedprice").alias("avg_price"))


@register(
    "agg_sum",
    """
    SELECT CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total
    FROM lineitem WHERE l_returnflag NOT IN ('N')
    """,
)
def agg_sum(spark, sf):
    li = _t(spark, sf, "lineitem").where(SH.not_in("l_returnflag", ["N"]))
    return li.agg(F.sum(N.money("l_extendedprice")).cast("decimal(38,2)").alias("total"))


@register(
    "agg_sum_nvl",
    """
    SELECT CAST(COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DECIMAL(38,2)) AS total_or_zero,
           CAST(SUM(COALESCE(CAST(l_extendedprice AS DECIMAL(18,2)), 0)) AS DECIMAL(38,2)) AS total_nvl
    FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.5
    """,
)
def agg_sum_nvl(spark, sf):
    li = _t(spark, sf, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.5))
    m = N.money("l_extendedprice")
    return li.agg(
        A.sum_or_zero(m).cast("decimal(38,2)").alias("total_or_zero"),
        F.sum(F.coalesce(m, F.lit(0))).cast("decimal(38,2)").alias("total_nvl"),
    )


@register(
    "agg_collect_ordered",
    """
    SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS parts
    FROM lineitem GROUP BY l_orderkey
    """,
)
def agg_collect_ordered(spark, sf):
    li = _t(spark, sf, "lineitem")
    out = A.collect_ordered(li, "l_orderkey", "l_linenumber", "l_partkey", "parts")
    return out.select("l_orderkey", F.array_join(F.col("parts").cast("array<string>"), ",").alias("parts"))


@register(
    "agg_distinct_rows",
    "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
)
def agg_distinct_rows(spark, sf):
    return A.distinct_rows(_t(spark, sf, "orders").select("o_orderstatus", "o_orderpriority"))


@register(
    "agg_duplicate_check",
    """
    SELECT sha256(text) AS text_hash, COUNT(*) AS copies
    FROM documents GROUP BY 1 HAVING COUNT(*) > 1
    """,
)
def agg_duplicate_check(spark, sf):
    d = _t(spark, sf, "documents").select(F.sha2("text", 256).alias("text_hash"))
    return A.duplicate_groups(d)


@register(
    "agg_drop_duplicates",
    "SELECT DISTINCT sha256(text) AS text_hash, lang FROM documents",
)
def agg_drop_duplicates(spark, sf):
    d = _t(spark, sf, "documents").select(F.sha2("text", 256).alias("text_hash"), "lang")
    return A.drop_duplicates(d)


# --------------------------------------------------------------------------
# sorts, limits, set operations
# --------------------------------------------------------------------------


@register(
    "sort_mixed",
    "SELECT o_orderkey, o_orderdate, o_orderpriority, o_totalprice FROM orders "
    "ORDER BY o_orderdate DESC, o_orderpriority ASC, o_totalprice DESC",
)
def sort_mixed(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    return SE.sort_by(o, [("o_orderdate", "desc"), ("o_orderpriority", "asc"), ("o_totalprice", "desc")])


@register(
    "sort_limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10",
)
def sort_limit(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return SE.top_n(o, [("o_totalprice", "desc"), ("o_orderkey", "asc")], 10)


@register(
    "set_union_all_labelled",
    """
    SELECT 'orders' AS label, COUNT(*) AS n FROM orders
    UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
    UNION ALL SELECT 'customer', COUNT(*) FROM customer
    """,
)
def set_union_all_labelled(spark, sf):
    parts = {n: _t(spark, sf, n).agg(F.count(F.lit(1)).alias("n")) for n in ("orders", "lineitem", "customer")}
    return SE.union_all_labelled(parts)


# --------------------------------------------------------------------------
# math and NULL functions
# --------------------------------------------------------------------------


@register(
    "fn_round",
    """
    SELECT l_orderkey, l_linenumber,
           CAST(ROUND(CAST(CAST(l_extendedprice * (1 - l_discount) AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE) AS revenue
    FROM lineitem
    """,
)
def fn_round(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        N.round_half_up(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("revenue"),
    )


@register(
    "fn_ratio",
    """
    SELECT l_orderkey, l_linenumber,
           CAST(ROUND(CAST(CAST(l_discount / NULLIF(l_tax, 0) AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE) AS ratio
    FROM lineitem
    """,
)
def fn_ratio(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", N.ratio("l_discount", "l_tax", 2).alias("ratio"))


@register(
    "fn_fillna",
    """
    SELECT c.c_custkey,
           CAST(COALESCE(t.total, 0) AS DECIMAL(38,2)) AS total,
           COALESCE(t.n_orders, 0) AS n_orders
    FROM customer c LEFT JOIN (
      SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total, COUNT(*) AS n_orders
      FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) t
    ON c.c_custkey = t.o_custkey
    """,
)
def fn_fillna(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey")
    t = (
        _t(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum(N.money("o_totalprice")).cast("decimal(38,2)").alias("total"), F.count(F.lit(1)).alias("n_orders"))
    )
    return c.join(t, "c_custkey", "left").fillna(0, subset=["total", "n_orders"])


@register(
    "fn_truncate_int",
    "SELECT o_orderkey, CAST(trunc(o_totalprice / 100) AS INTEGER) AS hundreds FROM orders",
)
def fn_truncate_int(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", N.truncate_int(F.col("o_totalprice") / 100).alias("hundreds"))


# --------------------------------------------------------------------------
# dates
# --------------------------------------------------------------------------


@register(
    "date_month_calendar",
    """
    SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                       date_trunc('month', max(o_orderdate)),
                                       INTERVAL 1 MONTH)) AS DATE) AS periodo
    FROM orders
    """,
)
def date_month_calendar(spark, sf):
    o = _t(spark, sf, "orders")
    return D.month_calendar(o.agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e")), "s", "e")


@register(
    "date_first_of_month",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-01') AS periodo FROM orders",
)
def date_first_of_month(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", D.first_of_month_text("o_orderdate").alias("periodo"))


# --------------------------------------------------------------------------
# JSON paths and arrays
# --------------------------------------------------------------------------


@register(
    "json_path",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_path(spark, sf):
    ev = _t(spark, sf, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@register(
    "arr_element",
    "SELECT vec_id, embedding[1] AS x_first, embedding[64] AS x_last, embedding[65] AS x_missing FROM embeddings",
)
def arr_element(spark, sf):
    e = _t(spark, sf, "embeddings")
    # get() is NULL out of bounds; arr[i] raises under ANSI mode
    return e.select(
        "vec_id",
        F.get("embedding", 0).alias("x_first"),
        F.get("embedding", 63).alias("x_last"),
        F.get("embedding", 64).alias("x_missing"),
    )


@register(
    "arr_explode",
    """
    SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, unnest(embedding) AS x
    FROM embeddings
    """,
)
def arr_explode(spark, sf):
    e = _t(spark, sf, "embeddings")
    return e.select("vec_id", F.posexplode("embedding").alias("pos", "x"))


# --------------------------------------------------------------------------
# string predicates
# --------------------------------------------------------------------------


@register(
    "str_is_upper",
    """
    SELECT p_partkey,
           upper(p_type) = p_type AND lower(p_type) <> p_type AS type_upper,
           upper(p_name) = p_name AND lower(p_name) <> p_name AS name_upper,
           upper(p_brand) = p_brand AND lower(p_brand) <> p_brand AS brand_upper
    FROM part
    """,
)
def str_is_upper(spark, sf):
    p = _t(spark, sf, "part")
    return p.select(
        "p_partkey",
        S.is_upper("p_type").alias("type_upper"),
        S.is_upper("p_name").alias("name_upper"),
        S.is_upper("p_brand").alias("brand_upper"),
    )


@register(
    "str_leading_digit",
    """
    SELECT conv_id, turn, COALESCE(regexp_matches(text, '^[0-9]'), false) AS leading_digit,
           COALESCE(regexp_matches(CAST(turn AS VARCHAR) || role, '^[0-9]'), false) AS turn_leading_digit
    FROM conversations
    """,
)
def str_leading_digit(spark, sf):
    c = _t(spark, sf, "conversations")
    return c.select(
        "conv_id", "turn",
        S.starts_with_digit("text").alias("leading_digit"),
        S.starts_with_digit(F.concat(F.col("turn").cast("string"), F.col("role"))).alias("turn_leading_digit"),
    )


@register(
    "str_strip_leading_number",
    """
    SELECT o_orderkey, trim(regexp_replace(CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority, '^[0-9]+', ''))
             AS label
    FROM orders
    """,
)
def str_strip_leading_number(spark, sf):
    o = _t(spark, sf, "orders")
    raw = F.concat(F.col("o_orderkey").cast("string"), F.lit(" "), F.col("o_orderpriority"))
    return o.select("o_orderkey", S.strip_leading_number(raw).alias("label"))


@register(
    "str_file_stem",
    """
    SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS file_name,
           regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^(.+?)(\\.[^.]*)?$', 1) AS stem
    FROM pages
    """,
)
def str_file_stem(spark, sf):
    p = _t(spark, sf, "pages")
    return p.select("page_id", S.file_name("url").alias("file_name"), S.file_stem("url").alias("stem"))


@register(
    "str_concat",
    "SELECT c_custkey, c_name || ' ' || c_mktsegment AS label FROM customer",
)
def str_concat(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", S.join_words("c_name", "c_mktsegment").alias("label"))
