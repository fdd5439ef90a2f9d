"""Weather-observation JSON: raw documents -> one typed row per observation.

A raw document is a GeoJSON-like feature collection ``{"features": [...]}``
stored as text in a ``value`` column (one row per document).  Cleaning is one
projection over ``explode(from_json(get_json_object(value, '$.features')))``:
documents with no features, an empty list or unparsable text produce no rows,
and features without a station are dropped.  It all runs inside the scan
stage (no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.numbers import round_half_up
from tidepool.operators.windows import max_consecutive_change
from tidepool.session import landed

# Element type of the "features" array read from a document.
FEATURE_SCHEMA = (
    "ARRAY<STRUCT<id: STRING, geometry: STRUCT<coordinates: ARRAY<DOUBLE>>, "
    "properties: STRUCT<station: STRING, timestamp: STRING, temperature: STRUCT<value: DOUBLE>, "
    "windSpeed: STRUCT<value: DOUBLE>, relativeHumidity: STRUCT<value: DOUBLE>>>>"
)

OBSERVATION_COLUMNS = [
    "station_id", "station_name", "longitude", "latitude", "observation_timestamp",
    "station_timezone", "temperature", "wind_speed", "humidity",
]


def features(raw: DataFrame, value: str = "value") -> DataFrame:
    """One row ``feature`` per element of ``$.features`` (inner explode)."""
    arr = F.from_json(F.get_json_object(F.col(value), "$.features"), FEATURE_SCHEMA)
    return raw.select(F.explode(arr).alias("feature"))


def document_rejects(raw: DataFrame, value: str = "value") -> DataFrame:
    """Documents that give no feature rows, ``value, reason``: text that is no JSON,
    and JSON whose ``features`` is no readable array.  An empty array is no reject."""
    listed = F.from_json(F.get_json_object(F.col(value), "$.features"), FEATURE_SCHEMA)
    reason = (F.when(F.col(value).isNull(), F.lit("no document"))
              .when(F.try_parse_json(value).isNull(), F.lit("malformed JSON"))
              .when(listed.isNull(), F.lit("no features array")))
    return raw.select(F.col(value).alias("value"), reason.alias("reason")).where(F.col("reason").isNotNull())


def clean_observations(raw: DataFrame, value: str = "value", timezone: str = "UTC") -> DataFrame:
    """Typed observation rows; features without a station are dropped.
    Readings are rounded to 2 decimals (half-up); coordinates are read with
    ``get`` so a missing coordinate is NULL, not an error."""
    f = F.col("feature")
    p = f["properties"]
    return features(raw, value).select(
        p["station"].alias("station_id"),
        f["id"].alias("station_name"),
        F.get(f["geometry"]["coordinates"], 0).alias("longitude"),
        F.get(f["geometry"]["coordinates"], 1).alias("latitude"),
        p["timestamp"].alias("observation_timestamp"),
        F.lit(timezone).alias("station_timezone"),
        round_half_up(p["temperature"]["value"].cast("double"), 2).alias("temperature"),
        round_half_up(p["windSpeed"]["value"].cast("double"), 2).alias("wind_speed"),
        round_half_up(p["relativeHumidity"]["value"].cast("double"), 2).alias("humidity"),
    ).where(F.col("station_id").isNotNull())


def observed_at(ts_text: str | Column = "observation_timestamp") -> Column:
    """ISO-8601 text with offset -> timestamp; unparsable text -> NULL.
    (Ordering by the text is only right for one offset and one format.)"""
    c = F.col(ts_text) if isinstance(ts_text, str) else ts_text
    return F.try_to_timestamp(c)


def max_change(obs: DataFrame, column: str, out: str, keys: Sequence[str] = ("station_id",)) -> DataFrame:
    """Largest absolute change of ``column`` between consecutive observations
    of a station, in observation-time order (ties broken by the feature id)."""
    narrow = obs.select(*keys, observed_at().alias("_t"), "station_name", column)
    # documents are parsed once, into the few columns that the sample and the window read
    readings = landed(obs.sparkSession, narrow, "readings")
    return max_consecutive_change(readings, list(keys), ["_t", "station_name"], column, out=out)
