"""What a body is, forecast and sensor records, and requests with their own horizons."""

import json

from pyspark.sql import functions as F

from airshed.functions import constants as K
from airshed.ml import scoring
from airshed.operators import normalize as N
from airshed.operators import payload as P
from airshed.plans import queries as Q

SMALL = "/root/testdata/sf0.001"


def bodies(spark, *payloads):
    return spark.createDataFrame([(p if p is None or isinstance(p, str) else json.dumps(p), i)
                                  for i, p in enumerate(payloads)], "body string, i int")


def meta():
    return F.col("i").cast("string"), F.lit(1.0), F.lit(2.0), F.lit("t")


def test_body_kinds(spark):
    df = bodies(spark, None, "{bad", "[]", "5", '"x"', "null", "{}", {"a": 1}, "", '{"a": 1, "a": 2}')
    assert [r[0] for r in df.orderBy("i").select(P.body_kind("body")).collect()] == [
        "no body", "malformed", "array", "scalar", "scalar", "null", "object", "object", "malformed", "malformed"]


def test_only_objects_are_responses(spark):
    """NULL, malformed text, arrays, scalars and null give no record in any feed."""
    df = bodies(spark, None, "{bad", "[]", "5", "null", '"x"')
    for form in (N.aq_current, N.aq_fallback, N.weather_payload, N.traffic_payload, N.uv_payload, N.openmeteo_payload):
        assert form(df, *meta()).count() == 0
    assert N.openaq_payload(df, F.lit("s"), F.lit(1), F.lit("t")).count() == 0


def test_missing_and_null_blocks_differ(spark):
    ids = lambda df, c="station": [r[0] for r in df.select(c).orderBy(c).collect()]
    df = bodies(spark, {}, {"result": None}, {"result": {}}, {"result": {"safe_exposure_time": None}},
                {"result": [1]}, {"result": {"uv": None}})
    assert ids(N.uv_payload(df, *meta())) == ["0", "2", "5"]
    df = bodies(spark, {}, {"flowSegmentData": None}, {"flowSegmentData": {"currentSpeed": None}},
                {"flowSegmentData": {"roadClosure": None}}, {"flowSegmentData": {"freeFlowSpeed": 60}})
    got = {r.corridor: r for r in N.traffic_payload(df, *meta()).collect()}
    assert sorted(got) == ["0", "3", "4"] and got["3"].road_closure is None and got["0"].road_closure is False
    ok = {"main": {"temp": None, "feels_like": 1, "humidity": 1, "pressure": 1}, "wind": {"speed": 1, "deg": None},
          "clouds": {"all": 1}, "weather": [{"main": "a", "description": "b"}]}
    df = bodies(spark, ok, {**ok, "rain": None}, {**ok, "rain": {"1h": None}}, {**ok, "rain": {"1h": 2}},
                {**ok, "main": {"temp": 1}}, {**ok, "weather": []})
    got = {r.station: r for r in N.weather_payload(df, *meta()).collect()}
    assert sorted(got) == ["0", "2", "3"] and got["0"].temp_c is None and got["0"].wind_deg is None
    assert (got["0"].rain_1h_mm, got["2"].rain_1h_mm, got["3"].rain_1h_mm) == (0.0, None, 2.0)
    df = bodies(spark, {"status": "ok", "data": {}}, {"status": "ok", "data": None}, {"status": "ok"},
                {"status": "ok", "data": {"iaqi": None}}, {"status": "ok", "data": {"iaqi": {"no2": None}}},
                {"status": "ok", "data": {"iaqi": {"no2": {"v": 4}}}})
    got = {r.station: r.no2 for r in N.aq_fallback(df, *meta()).collect()}
    assert got == {"0": None, "5": 4.0}


def test_forecast_hours(spark):
    times = [f"h{i}" for i in range(30)]
    df = bodies(spark, {}, {"hourly": {"time": times, "temperature_2m": list(range(30))}},
                {"hourly": {"time": times, "temperature_2m": list(range(24))}},
                {"hourly": {"time": times, "temperature_2m": list(range(23))}},
                {"hourly": {"time": times[:2], "wind_speed_10m": [1, None, 3]}, "current": {"cloud_cover": 7}},
                {"hourly": {"time": None}}, {"hourly": {"time": times, "uv_index": None}},
                {"hourly": {"temperature_2m": [1, 2]}}, {"current": None}, {"hourly": [1]})
    got = {r.station: r for r in N.openmeteo_payload(df, *meta()).collect()}
    assert sorted(got) == ["0", "1", "2", "4", "7"]
    assert got["0"].forecast_24h == [] == got["7"].forecast_24h
    assert [h.temp_c for h in got["1"].forecast_24h] == [float(i) for i in range(24)]
    assert [(h.time, h.temp_c, h.wind_speed_ms) for h in got["4"].forecast_24h] == [
        ("h0", None, 1.0), ("h1", None, None)]
    assert got["4"].cloud_cover_pct == 7.0


def test_forecast_is_read_by_subfield(spark):
    """The stored array of structs is read for the asked subfields only."""
    stored = Q.stored_forecasts(spark, SMALL)
    plan = stored.select("station", F.col("forecast_24h.temp_c"))._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "temp_c" in schema and "wind" not in schema and "time" not in schema.replace("timestamp", "")


def test_sensors_fold_in_the_row(spark):
    sensor = lambda name, value: {"parameter": {"name": name}, "value": value}
    df = bodies(spark, {"results": [{"sensors": [sensor("PM25", 1), sensor("pm25", 2), sensor("NO2", None),
                                                 sensor("", 3), {"value": 4}, sensor("co", 0.5), sensor("x", 1)]}]},
                {"results": []}, {"results": None}, {}, {"results": [{}]}, {"results": [None]},
                {"results": [{"sensors": None}]}, {"results": [{"sensors": [{"parameter": None}]}]},
                {"results": [{"sensors": [sensor(None, 1)]}]}, {"results": [{"sensors": []}, {"sensors": [1]}]})
    out = N.openaq_payload(df, F.col("i").cast("string"), F.lit(7), F.lit("t"))
    got = {r.station: r for r in out.collect()}
    assert sorted(got) == ["0", "4", "9"]
    assert (got["0"].pm25, got["0"].no2, got["0"].co, got["0"].location_id) == (2.0, None, 0.5, "7")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_requests(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 23, 6, [6, 3, -1, 6, None, 0, 2]), ("b", None, None, None, None), ("c", 0.0, 24, 0, [1]),
         ("d", 0.0, -1, 7, None), ("e", 0.0, 0, 0, [])],
        "request_id string, pm25 double, hour int, dayofweek int, horizons array<int>").withColumn(
        "station", F.lit("s"))
    rows = scoring.request_rows(df)
    got = {}
    for r in scoring.request_features(rows).orderBy("request_id", "horizon_h").collect():
        got.setdefault(r.request_id, []).append((r.horizon_h, r.target_hour, r.target_dayofweek))
    assert got["a"] == [(0, 23, 6), (2, 1, 0), (3, 2, 0), (6, 5, 0)]
    assert [h for h, _, _ in got["b"]] == list(range(25)) and sorted(got) == ["a", "b"]
    first = scoring.request_features(rows).where("request_id = 'b'").first()
    assert (first.pm25, first.temp_c, first.humidity_pct, first.wind_speed_ms, first.hour) == (0.0, 28.0, 75.0, 2.0, 12)
    rejects = {r.request_id: r.rejected for r in scoring.request_rejects(rows).collect()}
    assert rejects == {"c": "hour", "d": "hour,dayofweek"}
    none = scoring.request_rows(spark.createDataFrame([("x", "s")], "request_id string, station string"))
    assert scoring.request_features(none).count() == len(K.HORIZONS)
    assert scoring.request_features(rows.limit(0)).count() == 0
