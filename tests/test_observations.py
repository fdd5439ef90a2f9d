from pyspark.sql import functions as F

from tidepool.operators import observations as O

DOC = ('{"features": [{"id": "s1", "geometry": {"coordinates": [-70.5, -33.25]}, "properties": '
       '{"station": "ST1", "timestamp": "2024-01-01T00:00:00+00:00", "temperature": {"value": 21.456}, '
       '"windSpeed": {"value": 3.0}, "relativeHumidity": {"value": 50}}}, '
       '{"id": "s2", "geometry": {"coordinates": []}, "properties": {"timestamp": "x"}}]}')


def test_cleaning_fixture(spark):
    raw = spark.createDataFrame([(DOC,), ('{"features": []}',), ("{bad",), ("{}",)], "value string")
    rows = O.clean_observations(raw).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.station_id, r.station_name, r.longitude, r.latitude) == ("ST1", "s1", -70.5, -33.25)
    assert (r.temperature, r.wind_speed, r.humidity, r.station_timezone) == (21.46, 3.0, 50.0, "UTC")


def test_max_change_on_observations(spark):
    feats = ",".join(
        '{"id": "o%d", "properties": {"station": "A", "timestamp": "2024-01-0%dT00:00:00+00:00", '
        '"windSpeed": {"value": %s}}}' % (i, i + 1, v) for i, v in enumerate([3, 10, 4])
    )
    raw = spark.createDataFrame([('{"features": [%s]}' % feats,)], "value string")
    got = O.max_change(O.clean_observations(raw), "wind_speed", "m").collect()[0].m
    assert got == 7.0
    assert raw.select(O.observed_at(F.lit("junk")).alias("t")).collect()[0].t is None
