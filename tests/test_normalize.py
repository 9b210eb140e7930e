import json

from pyspark.sql import functions as F

from airshed.operators import normalize as N
from airshed.operators.dedup import horizon_list


def bodies(spark, payloads):
    return spark.createDataFrame([(json.dumps(p) if not isinstance(p, str) else p,) for p in payloads],
                                 "body string")


def meta():
    return F.lit("s"), F.lit(1.0), F.lit(2.0), F.lit("2024-01-01T00:00:00+00:00")


def test_aq_current_and_fallback(spark):
    df = bodies(spark, [{"current": {"us_aqi": 55, "pm2_5": 12.5}}, {"current": {"pm2_5": 1}}, "not json"])
    out = N.aq_current(df, *meta()).collect()
    assert len(out) == 1 and out[0].aqi == 55.0 and out[0].pm25 == 12.5 and out[0].so2 is None
    df = bodies(spark, [{"status": "ok", "data": {"aqi": "-", "iaqi": {"pm25": {"v": 7}}}},
                        {"status": "error", "data": {"aqi": 10}}])
    out = N.aq_fallback(df, *meta()).collect()
    assert len(out) == 1 and out[0].aqi == "-" and out[0].pm25 == 7.0 and out[0].no2 is None


def test_weather_payload_defaults_and_rejects(spark):
    ok = {"main": {"temp": 30, "feels_like": 33, "humidity": 70, "pressure": 1008},
          "wind": {"speed": 2.5}, "clouds": {"all": 40}, "weather": [{"main": "Rain", "description": "light rain"}]}
    no_wind = dict(ok)
    no_wind.pop("wind")
    out = N.weather_payload(bodies(spark, [ok, no_wind, {**ok, "weather": []}]), *meta(), uv=F.lit(5.0)).collect()
    assert len(out) == 1
    r = out[0]
    assert r.wind_deg == 0.0 and r.rain_1h_mm == 0.0 and r.weather_main == "Rain" and r.uv_index == 5.0


def test_traffic_payload_defaults(spark):
    df = bodies(spark, [{"flowSegmentData": {"currentSpeed": 30, "freeFlowSpeed": 50}}, {}])
    out = sorted(N.traffic_payload(df, *meta()).collect(), key=lambda r: r.current_speed_kmh)
    assert (out[0].current_speed_kmh, out[0].free_flow_kmh, out[0].congestion_ratio, out[0].road_closure) == (0.0, 1.0, 1.0, False)
    assert out[1].congestion_ratio == 0.4


def test_uv_payload(spark):
    df = bodies(spark, [{"result": {"uv": 3.2, "uv_max": 9, "safe_exposure_time": {"st2": 40}}}])
    r = N.uv_payload(df, *meta()).first()
    assert r.uv == 3.2 and r.safe_exposure_min == 40.0


def test_sensor_pivot_rules(spark):
    payload = {"results": [{"sensors": [
        {"parameter": {"name": "PM25"}, "value": 10},
        {"parameter": {"name": "pm25"}, "value": 12},     # repeated name: last wins
        {"parameter": {"name": ""}, "value": 5},          # empty name skipped
        {"parameter": {"name": "no2"}, "value": None},    # null value skipped
        {"parameter": {"name": "O3"}, "value": 33}]}]}
    raw = bodies(spark, [payload, {"results": []}]).withColumn("site", F.monotonically_increasing_id())
    long = N.sensors_from_payload(raw, ["site"])
    out = sorted(N.sensor_pivot(long, keys=["site"]).collect(), key=lambda r: r.site)
    assert len(out) == 1  # no results, no record
    assert (out[0].pm25, out[0].no2, out[0].o3, out[0].co) == (12.0, None, 33.0, None)


def test_malformed_payloads_are_no_readings(spark):
    ok = {"flowSegmentData": {"currentSpeed": 20, "freeFlowSpeed": 40}}
    raw = spark.createDataFrame([(json.dumps(ok),), ("{broken",), (None,), ("[",)], "body string")
    where = [F.lit("c"), F.lit(1.0), F.lit(2.0), F.lit("t")]
    assert [r.congestion_ratio for r in N.traffic_payload(raw, *where).collect()] == [0.5]
    raw = spark.createDataFrame([('{"status": "ok"}',)], "body string")
    assert N.aq_fallback(raw, *where).count() == 0


def test_hours_without_time_are_dropped(spark):
    df = spark.createDataFrame([("a", None, [1.0, 2.0]), ("b", ["t1"], [3.0, 4.0])],
                               "station string, time array<string>, temp array<double>")
    out = N.explode_hourly(df, ["station"], {"time": F.col("time"), "temp_c": F.col("temp")})
    assert [tuple(r) for r in out.collect()] == [("b", "t1", 3.0)]


def test_hourly_arrays(spark):
    df = spark.createDataFrame([("s", ["t1", "t2", "t3"], [1.0, 2.0, None], None)],
                               "station string, time array<string>, temp array<double>, uv array<double>")
    out = N.explode_hourly(df, ["station"], {"time": F.col("time"), "temp_c": F.col("temp"),
                                             "uv_index": F.col("uv")}, limit=2).collect()
    assert [(r.time, r.temp_c, r.uv_index) for r in out] == [("t1", 1.0, None), ("t2", 2.0, None)]
    empty = spark.createDataFrame([("s", [], [])], "station string, time array<string>, temp array<double>")
    assert N.explode_hourly(empty, ["station"], {"time": F.col("time"), "temp_c": F.col("temp")}).count() == 0


def test_encode_decode_round_trip(spark):
    df = spark.createDataFrame([("s", 1.5)], "station string, aqi double")
    enc = N.encode(df)
    back = N.decode(enc, df.schema).first()
    assert (back.station, back.aqi) == ("s", 1.5)


def test_horizon_list(spark):
    df = spark.createDataFrame([([6, 0, -1, 6, 3],)], "h array<int>")
    assert df.select(horizon_list("h")).first()[0] == [0, 3, 6]
