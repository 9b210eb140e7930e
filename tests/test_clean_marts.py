from pyspark.sql import functions as F

from airshed.operators import clean, marts, serving
from airshed.sources import schemas

RUN = "2024-01-02T00:00:00+00:00"


def aqi_rows(spark, rows):
    return spark.createDataFrame(rows, schemas.AQI)


def rec(station, ts, aqi, lat=-6.1, lon=106.8, pm25="10"):
    return (station, lat, lon, ts, aqi, pm25, None, None, None, None, None, "t")


def test_aqi_silver_edge_rows(spark):
    T = "2024-01-01T00:0{}:00.000000+00:00"
    rows = [
        rec("a", T.format(1), "-"),        # junk text -> dropped by range filter
        rec("a", T.format(2), "55"),       # numeric text -> kept
        rec("a", T.format(3), "0"),
        rec("a", T.format(4), "500"),
        rec("a", T.format(5), "500.1"),    # out of range
        rec("a", T.format(6), "-1"),
        rec("a", T.format(7), "NaN"),      # NaN -> dropped
        rec(None, T.format(8), "10"),      # no station
        rec("a", None, "10"),              # no timestamp
        rec("b", "yesterday", "20"),       # unparsable time kept, null date/hour
        rec("c", T.format(1), "abc"),      # invalid duplicate ...
        rec("c", T.format(1), "42"),       # ... must not hide the valid one
        rec("d", T.format(1), "60", lat=1.0),
        rec("d", T.format(2), "80", lat=2.0),  # one station, two coordinates
    ]
    silver = clean.clean_aqi(aqi_rows(spark, rows), RUN)
    got = {(r.station, r.timestamp): r for r in silver.collect()}
    assert sorted((k[0], r.aqi) for k, r in got.items()) == [
        ("a", 0.0), ("a", 55.0), ("a", 500.0), ("b", 20.0), ("c", 42.0), ("d", 60.0), ("d", 80.0)]
    b = got[("b", "yesterday")]
    assert b.date is None and b.hour is None
    a = got[("a", T.format(2))]
    assert a.date == "2024-01-01" and a.hour == 0 and a.aqi_category == "Moderate"
    assert a.pm25 == 10.0 and a.processed_at == RUN

    gold = {(r.station, r.lat): r for r in marts.station_gold(silver, RUN).collect()}
    # a station with two coordinates fans out into two rows sharing the station's latest
    assert gold[("d", 1.0)].latest_aqi == 80.0 and gold[("d", 2.0)].latest_aqi == 80.0
    assert gold[("d", 1.0)].reading_count == 1
    ga = gold[("a", -6.1)]
    assert ga.reading_count == 3 and ga.min_aqi == 0.0 and ga.max_aqi == 500.0
    assert abs(ga.avg_aqi - 555.0 / 3) < 1e-12 and ga.latest_aqi == 500.0
    assert ga.latest_category == "Hazardous" and ga.last_updated == T.format(4)


def test_dedup_is_repeatable(spark):
    T = "2024-01-01T00:00:00.000000+00:00"
    rows = [rec("s", T, "10", pm25="1"), rec("s", T, "10", pm25="2"), rec("s", T, "9", pm25="3")]
    for parts in (1, 3):
        df = aqi_rows(spark, rows).repartition(parts)
        out = clean.clean_aqi(df, RUN).collect()
        # smallest full-row tuple wins whatever the partitioning: (lat, lon, aqi=9, ...)
        assert len(out) == 1 and out[0].aqi == 9.0 and out[0].pm25 == 3.0


def test_weather_silver_and_gold(spark):
    W = schemas.WEATHER
    base = dict.fromkeys(W.fieldNames())
    def w(ts, temp, hum, **kw):
        d = dict(base, station="s", lat=1.0, lon=2.0, timestamp=ts, temp_c=temp, humidity_pct=hum,
                 source="x", **kw)
        return tuple(d[f] for f in W.fieldNames())
    rows = [
        w("2024-01-01T00:00:00+00:00", None, None, wind_speed_ms="3"),   # wind record: dropped
        w("2024-01-01T01:00:00+00:00", "25", None),                        # null humidity: dropped
        w("2024-01-01T02:00:00+00:00", "0", "80", rain_1h_mm=None),        # temp 0 kept
        w("2024-01-01T03:00:00+00:00", "27.5", "70", weather_main="Rain", uv_index="6"),
    ]
    silver = clean.clean_weather(spark.createDataFrame(rows, W), RUN)
    assert sorted(r.temp_c for r in silver.collect()) == [0.0, 27.5]
    g = marts.weather_gold(silver, RUN).collect()
    assert len(g) == 1 and g[0].temp_c == 27.5 and g[0].weather_main == "Rain"
    assert g[0].last_updated == "2024-01-01T03:00:00+00:00" and g[0].uv_index == 6.0


def test_traffic_edges_and_gold(spark):
    rows = [("c", 1.0, 2.0, f"2024-01-01T0{i}:00:00+00:00", "10", "50", str(r), None, False, "t")
            for i, r in enumerate([0, 0.2, 0.4, 0.6, 0.8, 1, 1.01])]
    silver = clean.clean_traffic(spark.createDataFrame(rows, schemas.TRAFFIC), RUN)
    levels = [r.congestion_level for r in silver.orderBy("timestamp").collect()]
    assert levels == ["Free Flow", "Light", "Moderate", "Heavy", "Severe", "Severe"]  # 1.01 dropped
    g = marts.corridor_gold(silver, RUN).first()
    assert g.reading_count == 6 and abs(g.avg_congestion - 0.5) < 1e-12
    assert g.congestion_level == "Moderate" and g.max_congestion == 1.0


def test_station_current_and_overview(spark):
    gold = spark.createDataFrame(
        [("a", 1.0, 1.0, 40.0, None, 10, 5.0), ("b", None, 2.0, 90.0, 90.0, None, 6.0),
         ("c", 1.0, 3.0, None, None, 3, None)],
        "station string, lat double, lon double, avg_aqi double, latest_aqi double, "
        "reading_count long, avg_pm25 double").withColumn("last_updated", F.lit("2024-01-01"))
    weather = spark.createDataFrame([("a", 30.0, 80.0, 2.0, 7.2, "2024-01-01")],
                                    "station string, temp_c double, humidity_pct double, "
                                    "wind_speed_ms double, uv_index double, last_updated string")
    for f in ["feels_like_c", "pressure_hpa", "wind_deg", "clouds_pct", "rain_1h_mm"]:
        weather = weather.withColumn(f, F.lit(None).cast("double"))
    for f in ["weather_main", "weather_desc"]:
        weather = weather.withColumn(f, F.lit(None).cast("string"))
    cur = serving.station_current(gold, weather)
    rows = {r.station: r for r in cur.collect()}
    assert rows["a"].aqi_category == "Good" and rows["a"].temp_c == 30.0
    assert rows["c"].aqi_category == "Unknown" and rows["c"].temp_c is None
    traffic = spark.createDataFrame([("x", 0.3, "Light"), ("y", 0.3, "Light"), ("z", None, None)],
                                    "corridor string, avg_congestion double, congestion_level string")
    o = serving.overview(cur, traffic).first()
    assert o.station_count == 3 and o.corridor_count == 3 and o.total_aqi_readings == 13
    assert o.city_avg_aqi == 65.0 and o.city_avg_category == "Moderate"
    assert (o.worst_station, o.best_station) == ("b", "a")
    assert o.worst_corridor == "x" and o.worst_corridor_congestion == 0.3   # tie -> first name
    assert o.avg_temp_c == 30.0 and o.max_uv_index == 7.2


def test_ties_go_to_first_name(spark):
    cur = spark.createDataFrame([("b", 50.0), ("a", 50.0)], "station string, current_aqi double")
    r = serving.worst_best_station(cur).first()
    assert r.worst_station == "a" and r.best_station == "a"
