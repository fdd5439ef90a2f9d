"""Weather-observation and incremental-load queries.

Raw documents are built from ``events`` with Spark (one feature collection
per block of 100 event ids; station = user_id, temperature = value, wind
speed = ``props.k``, humidity absent for ``view`` events, station missing for
``error`` events) and landed as JSON Lines in the shared scratch folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidepool.operators import observations as O
from tidepool.plans.registry import register
from tidepool.session import read_table, scratch_path
from tidepool.sinks.tables import write_path
from tidepool.sources.files import read_json_documents
from tidepool.streaming import incremental as INC


def observation_documents(spark, sf) -> str:
    """Land the raw observation documents; returns their folder."""
    ev = read_table(spark, sf, "events")
    feature = F.struct(
        F.concat(F.lit("obs-"), F.col("event_id").cast("string")).alias("id"),
        F.struct(
            F.array((F.lit(-70.0) - F.col("user_id") / 4.0), (F.lit(-33.0) + (F.col("event_id") % 8) / 8.0)).alias(
                "coordinates"
            )
        ).alias("geometry"),
        F.struct(
            F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("station"),
            F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("timestamp"),
            F.struct(F.col("value").alias("value")).alias("temperature"),
            F.struct(F.get_json_object("props", "$.k").cast("double").alias("value")).alias("windSpeed"),
            F.when(F.col("event_type") != "view", F.struct((F.col("value") / 2).alias("value"))).alias(
                "relativeHumidity"
            ),
        ).alias("properties"),
    )
    docs = ev.groupBy((F.col("event_id") / 100).cast("bigint").alias("doc")).agg(
        F.collect_list(feature).alias("features")
    )
    path = scratch_path(spark, "observations_raw")
    write_path(docs.select(F.to_json(F.struct("doc", "features")).alias("value")), path, fmt="text")
    return path


def _clean(spark, sf):
    return O.clean_observations(read_json_documents(spark, observation_documents(spark, sf)))


_CLEAN_SQL = """
    SELECT CAST(user_id AS VARCHAR) AS station_id, 'obs-' || CAST(event_id AS VARCHAR) AS station_name,
           -70.0 - user_id / 4.0 AS longitude, -33.0 + (event_id % 8) / 8.0 AS latitude,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS observation_timestamp, 'UTC' AS station_timezone,
           CAST(ROUND(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE) AS temperature,
           CAST(ROUND(CAST(CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE)
             AS wind_speed,
           CASE WHEN event_type <> 'view' THEN CAST(ROUND(CAST(CAST(value / 2 AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE) END
             AS humidity,
           ts, event_id
    FROM events WHERE event_type <> 'error'
"""


@register(
    "src_json_documents",
    "SELECT event_id // 100 AS doc_id, COUNT(*) AS n_features FROM events GROUP BY 1",
)
def src_json_documents(spark, sf):
    raw = read_json_documents(spark, observation_documents(spark, sf))
    return raw.select(
        F.get_json_object("value", "$.doc").cast("bigint").alias("doc_id"),
        F.json_array_length(F.get_json_object("value", "$.features")).cast("bigint").alias("n_features"),
    )


@register(
    "json_observations",
    f"SELECT {', '.join(O.OBSERVATION_COLUMNS)} FROM ({_CLEAN_SQL})",
)
def json_observations(spark, sf):
    return _clean(spark, sf)


@register(
    "json_rejects",
    """
    SELECT event_id // 100 AS doc, CASE WHEN event_id // 100 % 5 = 0 THEN 'malformed JSON' ELSE 'no features array' END AS reason
    FROM events WHERE event_id // 100 % 5 < 2 GROUP BY ALL
    """,
)
def json_rejects(spark, sf):
    """Every fifth document cut off in the middle, every fifth without its features."""
    raw = read_json_documents(spark, observation_documents(spark, sf))
    doc = F.regexp_extract("value", '"doc":(\\d+)', 1).cast("bigint")
    spoiled = raw.select(F.when(doc % 5 == 0, F.expr("left(value, length(value) - 9)"))
                         .when(doc % 5 == 1, F.replace("value", F.lit('"features"'), F.lit('"feature"'))).otherwise(F.col("value")).alias("value"))
    return O.document_rejects(spoiled).select(doc.alias("doc"), "reason")


@register(
    "agg_distinct_observations",
    f"SELECT DISTINCT station_id, wind_speed FROM ({_CLEAN_SQL})",
)
def agg_distinct_observations(spark, sf):
    return _clean(spark, sf).select("station_id", "wind_speed").distinct()


@register(
    "obs_avg_temperature",
    f"""
    SELECT CAST(ROUND(CAST(CAST(CAST(SUM(CAST(temperature AS DECIMAL(18,2))) AS DOUBLE) / COUNT(temperature) AS VARCHAR) AS DECIMAL(38,17)), 4) AS DOUBLE) AS avg_temperature_last_week
    FROM ({_CLEAN_SQL}) WHERE ts >= DATE '2024-01-20' - INTERVAL 7 DAY AND ts <= DATE '2024-01-20'
    """,
)
def obs_avg_temperature(spark, sf):
    from tidepool.functions.dates import trailing_days
    from tidepool.functions.numbers import avg_exact

    obs = _clean(spark, sf)
    t = O.observed_at()
    d = obs.where(trailing_days(t, F.lit("2024-01-20").cast("date").cast("timestamp"), 7))
    return d.agg(avg_exact("temperature", 4).alias("avg_temperature_last_week"))


@register(
    "obs_max_wind_change",
    f"""
    SELECT MAX(ABS(wind_speed - earlier)) AS max_wind_speed_change
    FROM (SELECT wind_speed, any_value(wind_speed) OVER (PARTITION BY station_id ORDER BY observation_timestamp, station_name
                                                         ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) AS earlier
          FROM ({_CLEAN_SQL}))
    """,
)
def obs_max_wind_change(spark, sf):
    return O.max_change(_clean(spark, sf), "wind_speed", "max_wind_speed_change")


# --------------------------------------------------------------------------
# incremental loading
# --------------------------------------------------------------------------

_ORDERS_KEYED = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders"
)


@register("inc_append_new_only", _ORDERS_KEYED)
def inc_append_new_only(spark, sf):
    from tidepool.functions.numbers import money

    o = read_table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice").alias("o_totalprice")
    )
    name = f"tp_inc_{uuid.uuid4().hex[:8]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    INC.create_keyed_table(o.where(F.col("o_orderstatus") == "F"), name, ["o_orderkey"], buckets, scratch_path(spark, name))
    batch = o.unionByName(o.where(F.col("o_orderstatus") == "O"))  # re-delivered rows inside the batch
    INC.append_new_only(spark, batch, name, ["o_orderkey"])
    INC.append_new_only(spark, batch, name, ["o_orderkey"])  # re-run: appends nothing
    return spark.table(name)


@register(
    "inc_append_by_partition",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus FROM orders",
)
def inc_append_by_partition(spark, sf):
    """Three loads into a table by month: finished orders, all orders of one year (in part
    again), and all orders."""
    o = read_table(spark, sf, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("month"), "o_orderstatus")
    target = scratch_path(spark, "orders_by_month")
    for batch in (o.where("o_orderstatus = 'F'"), o.where("year(month) = 1996"), o.unionByName(o.where("o_orderstatus = 'O'"))):
        INC.append_new_by_partition(spark, batch, target, ["o_orderkey"], "month")
    return spark.read.schema(o.schema).parquet(target).select("o_orderkey", "month", "o_orderstatus")


@register(
    "inc_stream_dedupe",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def inc_stream_dedupe(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    src, out, ckpt = (scratch_path(spark, n) for n in ("stream_src", "stream_out", "stream_ckpt"))
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    # first delivery: events before the 16th but those of type error; second: the error events, however
    # old, and all from the 10th on (6 days delivered twice)
    late = F.col("event_type").eqNullSafe("error")
    write_path(ev.where((F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")) & ~late), f"{src}/delivery1")
    kw = dict(key=["event_id"], target=out, checkpoint=ckpt)
    INC.stream_dedupe(spark, f"{src}/*", schema, **kw)
    write_path(ev.where(F.coalesce(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"), F.lit(True)) | late), f"{src}/delivery2")
    INC.stream_dedupe(spark, f"{src}/*", schema, **kw)
    INC.stream_dedupe(spark, f"{src}/*", schema, **kw)  # nothing new: no-op
    return spark.read.schema(schema).parquet(out).select("event_id", "user_id", "event_type", "value")
