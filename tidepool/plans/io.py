"""Source, sink and DDL queries.

Each query lands data derived from the driver tables with Spark into a fresh
folder below the shared checkpoint root (``spark.checkpoint.dir``), runs the
source/sink/DDL operation under test, and returns the table read back, so the
oracle is the plain query over the original table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidepool.functions import numbers as N
from tidepool.plans.registry import register
from tidepool.session import TABLES, read_table, scratch_path
from tidepool.sinks import tables as T
from tidepool.sources import files as FS
from tidepool.sources import generate as G


def _name(base: str) -> str:
    return f"tp_{base}_{uuid.uuid4().hex[:8]}"


_ORDERS_SLICE_SQL = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice "
    "FROM orders"
)


def _orders_slice(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", N.money("o_totalprice").alias("o_totalprice"))


# --------------------------------------------------------------------------
# sources
# --------------------------------------------------------------------------


@register(
    "src_csv_header",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
    FROM customer
    """,
)
def src_csv_header(spark, sf):
    path = scratch_path(spark, "csv_header")
    T.write_path(read_table(spark, sf, "customer"), path, fmt="csv", options={"header": "true"})
    return FS.read_csv_header(spark, path)


@register(
    "src_csv_infer",
    """
    SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag
    FROM lineitem
    """,
)
def src_csv_infer(spark, sf):
    path = scratch_path(spark, "csv_infer")
    li = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    T.write_path(li, path, fmt="csv", options={"header": "true", "sep": ";"})
    return FS.read_csv_typed(spark, path, sep=";")


@register(
    "src_csv_rejects",
    """
    SELECT CAST(l_orderkey AS VARCHAR) || ';' || CAST(l_linenumber AS VARCHAR) || CASE WHEN l_orderkey % 50 = 0 THEN ';n/a' ELSE '' END AS line,
           CASE WHEN l_orderkey % 50 = 0 THEN 'value of another type' ELSE 'other number of fields' END AS reason
    FROM lineitem WHERE l_orderkey % 50 IN (0, 1)
    """,
)
def src_csv_rejects(spark, sf):
    return _spoiled_csv(spark, sf)[1]


@register(
    "src_csv_rescued",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey % 50 > 1",
)
def src_csv_rescued(spark, sf):
    return _spoiled_csv(spark, sf)[0]


def _spoiled_csv(spark, sf):
    """Lines of ``lineitem`` as CSV; some have a value of another type, some lack a field."""
    path, key = scratch_path(spark, "csv_spoiled"), F.col("l_orderkey")
    li = read_table(spark, sf, "lineitem").select(F.concat_ws(
        ";", "l_orderkey", "l_linenumber",
        F.when(key % 50 == 0, F.lit("n/a")).when(key % 50 != 1, F.col("l_quantity").cast("string"))).alias("value"))
    T.write_path(li, path, fmt="text")
    return FS.read_csv_rescue(spark, path, "l_orderkey bigint, l_linenumber int, l_quantity double", header=False)


@register(
    "src_csv_folder_views",
    """
    SELECT n.n_name, r.r_name
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
    """,
)
def src_csv_folder_views(spark, sf):
    folder = scratch_path(spark, "csv_folder")
    for t in ("nation", "region"):
        T.write_path(read_table(spark, sf, t), f"{folder}/{t}_landed.csv", fmt="csv", options={"header": "true"})
    views = FS.csv_folder_views(spark, folder)
    assert {"nation_landed", "region_landed"} <= set(views), views
    return spark.sql(
        "SELECT n.n_name, r.r_name FROM nation_landed n JOIN region_landed r ON n.n_regionkey = r.r_regionkey"
    )


_TABLE_FILES = " UNION ALL ".join(f"SELECT '{t}.parquet' AS name" for t in TABLES)


@register("src_file_listing", f"SELECT name FROM ({_TABLE_FILES})")
def src_file_listing(spark, sf):
    return FS.list_files(spark, sf, glob="*.parquet").select("name")


@register(
    "src_binary_files",
    f"SELECT name, '50415231' AS magic FROM ({_TABLE_FILES})",
)
def src_binary_files(spark, sf):
    b = FS.read_binary_files(spark, sf, glob="*.parquet")
    return FS.file_heads(b, 4).select(FS.file_name("path").alias("name"), F.lower(F.hex("head")).alias("magic"))


@register(
    "src_table_path",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'",
)
def src_table_path(spark, sf):
    path = scratch_path(spark, "path_table")
    T.write_path(read_table(spark, sf, "lineitem"), path)
    t = FS.read_path_table(spark, path)
    return t.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_quantity")


@register(
    "src_catalog_table",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def src_catalog_table(spark, sf):
    name = _name("orders")
    T.save_table(read_table(spark, sf, "orders"), name, path=scratch_path(spark, name))
    return spark.sql(f"SELECT o_orderkey, o_totalprice FROM {name} WHERE o_orderpriority = '1-URGENT'")


@register(
    "src_generate_rows",
    """
    SELECT CAST(i AS BIGINT) AS id, 'Name_' || CAST(i AS VARCHAR) AS name
    FROM (SELECT ROW_NUMBER() OVER () - 1 AS i FROM orders)
    """,
)
def src_generate_rows(spark, sf):
    n = read_table(spark, sf, "orders").count()  # parquet footers only
    return G.generate_rows(spark, n)


# --------------------------------------------------------------------------
# sinks
# --------------------------------------------------------------------------


@register("sink_overwrite", _ORDERS_SLICE_SQL)
def sink_overwrite(spark, sf):
    path = scratch_path(spark, "overwrite")
    df = _orders_slice(spark, sf)
    T.write_path(df, path)
    T.write_path(df, path)  # a re-run replaces, it does not duplicate
    return FS.read_path_table(spark, path)


@register("sink_save_table", _ORDERS_SLICE_SQL)
def sink_save_table(spark, sf):
    name = _name("save")
    path = scratch_path(spark, name)
    df = _orders_slice(spark, sf)
    T.save_table(df, name, path=path)
    T.save_table(df, name, path=path)
    return spark.table(name)


@register("sink_append", _ORDERS_SLICE_SQL)
def sink_append(spark, sf):
    name = _name("append")
    df = _orders_slice(spark, sf)
    first = F.col("o_orderstatus").eqNullSafe("F")
    T.save_table(df.where(first), name, path=scratch_path(spark, name))
    T.append_table(df.where(~first), name)
    return spark.table(name)


_FORMATS = ("csv", "json", "orc", "parquet")


@register(
    "sink_formats",
    " UNION ALL ".join(
        f"SELECT '{f}' AS fmt, COUNT(*) AS n_rows, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) "
        f"AS total, MAX(o_orderkey) AS max_key FROM orders"
        for f in _FORMATS
    ),
)
def sink_formats(spark, sf):
    df = _orders_slice(spark, sf)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(18,2)"
    parts = []
    for fmt in _FORMATS:
        path = scratch_path(spark, f"fmt_{fmt}")
        opts = {"header": "true"} if fmt == "csv" else None
        T.write_path(df, path, fmt=fmt, options=opts)
        r = spark.read.format(fmt).schema(schema)
        if fmt == "csv":
            r = r.option("header", "true")
        back = r.load(path)
        parts.append(
            back.agg(
                F.lit(fmt).alias("fmt"),
                F.count(F.lit(1)).alias("n_rows"),
                F.sum("o_totalprice").cast("decimal(38,2)").alias("total"),
                F.max("o_orderkey").alias("max_key"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("sink_copy", _ORDERS_SLICE_SQL)
def sink_copy(spark, sf):
    src, dst = scratch_path(spark, "copy_src"), scratch_path(spark, "copy_dst")
    T.write_path(_orders_slice(spark, sf), src)
    T.copy_table(spark, src, dst)
    return FS.read_path_table(spark, dst)


# --------------------------------------------------------------------------
# DDL
# --------------------------------------------------------------------------


@register("ddl_ctas_if_not_exists", "SELECT * FROM customer WHERE c_mktsegment = 'AUTOMOBILE'")
def ddl_ctas_if_not_exists(spark, sf):
    name, view = _name("ctas"), _name("ctas_src")
    c = read_table(spark, sf, "customer")
    c.where(F.col("c_mktsegment") == "AUTOMOBILE").createOrReplaceTempView(view)
    loc = scratch_path(spark, name)
    T.ctas_if_not_exists(spark, name, view, loc)
    # second call with different content: a no-op, the first table stays
    c.where(F.col("c_mktsegment") == "BUILDING").createOrReplaceTempView(view)
    T.ctas_if_not_exists(spark, name, view, loc)
    return spark.table(name)


@register("ddl_register_external", "SELECT * FROM supplier")
def ddl_register_external(spark, sf):
    name, loc = _name("ext"), scratch_path(spark, "ext")
    T.write_path(read_table(spark, sf, "supplier"), loc)
    T.register_external(spark, name, loc)
    T.register_external(spark, name, loc)  # idempotent
    return spark.table(name)


@register("ddl_replace_table", _ORDERS_SLICE_SQL + " WHERE o_totalprice > 1000")
def ddl_replace_table(spark, sf):
    name = _name("replace")
    T.replace_table(spark, name, _orders_slice(spark, sf))
    # replace from a query over the table itself (no overwrite-own-input error)
    T.replace_table(spark, name, spark.table(name).where(F.col("o_totalprice") > 1000))
    return spark.table(name)


@register(
    "ddl_insert_select",
    f"""
    SELECT * FROM ({_ORDERS_SLICE_SQL})
    UNION ALL
    SELECT * FROM ({_ORDERS_SLICE_SQL} ORDER BY o_orderkey LIMIT 1)
    """,
)
def ddl_insert_select(spark, sf):
    name = _name("ins")
    T.save_table(_orders_slice(spark, sf), name, path=scratch_path(spark, name))
    T.insert_select(spark, name, f"SELECT * FROM {name} ORDER BY o_orderkey LIMIT 1")
    return spark.table(name)


@register(
    "ddl_table_properties",
    """
    SELECT * FROM (VALUES ('layer', 'curated'), ('change_feed', 'false')) AS p(key, value)
    UNION ALL SELECT 'source_rows', CAST(COUNT(*) AS VARCHAR) FROM customer
    """,
)
def ddl_table_properties(spark, sf):
    name = _name("props")
    loc = scratch_path(spark, name)
    source = read_table(spark, sf, "customer")
    source.createOrReplaceTempView(f"{name}_src")
    spark.sql(
        f"CREATE TABLE {name} USING parquet LOCATION '{loc}' "
        f"TBLPROPERTIES ('layer' = 'curated', 'change_feed' = 'false', 'source_rows' = '{source.count()}') AS SELECT * FROM {name}_src"
    )
    return T.table_properties(spark, name).where(F.col("key").isin("layer", "change_feed", "source_rows"))
