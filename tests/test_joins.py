import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from airshed.functions import constants as K
from airshed.operators import serving
from airshed.operators.asof import asof_left_join
from airshed.operators.joins import horizon_samples, hourly_training_rows, source_fallback

T0 = datetime(2024, 1, 1)


def brute_asof(left, right):
    out = []
    for key, lt, lid in left:
        best = None
        for rk, rt, val in right:
            if key is not None and rk == key and lt is not None and rt <= lt and (best is None or rt > best[0]):
                best = (rt, val)
        out.append((lid, None if best is None else best[1]))
    return sorted(out)


def test_asof_matches_brute_force(spark):
    rnd = random.Random(7)
    left, right = [], []
    for i in range(400):
        k = rnd.choice(["a", "b", "c", None])
        t = None if rnd.random() < 0.03 else T0 + timedelta(minutes=rnd.randint(0, 60 * 24 * 5))
        left.append((k, t, i))
    used = set()
    for i in range(150):
        k = rnd.choice(["a", "b", "c"])
        t = T0 + timedelta(minutes=rnd.choice([rnd.randint(0, 60 * 24 * 5), 0, 60 * 24]))
        if (k, t) in used:
            continue
        used.add((k, t))
        right.append((k, t, float(i)))
    right.append((None, T0, -1.0))                      # null key never matches
    right.append(("a", left[0][1] or T0, 999.0)) if ("a", left[0][1] or T0) not in used else None
    L = spark.createDataFrame(left, "k string, t timestamp, id int")
    R = spark.createDataFrame(right, "k string, t timestamp, v double")
    for bucket in ("minute", "hour", "day"):
        got = sorted((r.id, r.v) for r in asof_left_join(L, R, ["k"], "t", "t", ["v"], bucket).collect())
        assert got == brute_asof(left, right), bucket


def test_asof_equal_time_matches_and_far_carry(spark):
    L = spark.createDataFrame([("a", datetime(2024, 3, 1, 5), 1), ("a", datetime(2024, 1, 1, 0), 2),
                               ("a", datetime(2023, 12, 31), 3)], "k string, t timestamp, id int")
    R = spark.createDataFrame([("a", datetime(2024, 1, 1, 0), 10.0)], "k string, t timestamp, v double")
    got = sorted((r.id, r.v) for r in asof_left_join(L, R, ["k"], "t", "t", ["v"]).collect())
    assert got == [(1, 10.0), (2, 10.0), (3, None)]


def _grid(spark, stations, hours, gaps=()):
    rows = [(f"s{s}", T0 + timedelta(hours=h)) for s in range(stations) for h in range(hours)
            if (s, h) not in gaps]
    df = spark.createDataFrame(rows, "station string, time timestamp")
    aq = df.select("station", "time", *[F.lit(1.0).alias(c) for c in ["pm25", "pm10", "no2", "o3"]],
                   F.lit(42.0).alias("aqi"))
    wx = df.select("station", "time", *[F.lit(1.0).alias(c) for c in
                                        ["temp_c", "humidity_pct", "wind_speed_ms"]])
    return aq, wx


def test_horizon_samples_golden_grid(spark):
    # 61 days x 24 h x 10 stations, h = 0..24: sum_h (1464 - h) * 10 = 363,000
    aq, wx = _grid(spark, 10, 1464)
    assert horizon_samples(hourly_training_rows(aq, wx)).count() == 363_000


def test_horizon_samples_gap_and_null(spark):
    aq, wx = _grid(spark, 1, 30, gaps={(0, 10)})
    aq = aq.withColumn("pm25", F.when(F.col("time") == T0 + timedelta(hours=20), None).otherwise(F.col("pm25")))
    rows = hourly_training_rows(aq, wx)
    assert rows.count() == 28                     # gap hour and null-pollutant hour gone
    s = horizon_samples(rows, horizons=[0, 1])
    # h=0: 28 pairs; h=1: hours t with t+1 present: 28 - pairs broken by the gaps (9->10, 19->20) - last
    assert s.filter("horizon_h = 0").count() == 28
    assert s.filter("horizon_h = 1").count() == 28 - 3
    r = s.filter("horizon_h = 1").orderBy("time").first()
    assert (r.target_hour, r.target_dayofweek) == (8, 0)   # 2024-01-01 01:00 +07:00, Monday


def test_source_fallback(spark):
    p = spark.createDataFrame([("a", "1", 10.0, 1.0, "p"), ("b", "1", None, 2.0, "p"), ("c", "1", None, 3.0, "p")],
                              "station string, slot string, aqi double, pm25 double, source string")
    s = spark.createDataFrame([("b", "1", 20.0, 4.0, "s"), ("a", "1", 30.0, 5.0, "s"), ("d", "1", None, 6.0, "s")],
                              "station string, slot string, aqi double, pm25 double, source string")
    got = sorted(tuple(r) for r in source_fallback(p, s).collect())
    assert got == [("a", "1", 10.0, 1.0, "p"), ("b", "1", 20.0, 4.0, "s"), ("d", "1", None, 6.0, "s")]


def test_horizon_constants():
    assert K.HORIZONS == list(range(25)) and len(K.FEATURE_ORDER) == 12


def test_horizon_samples_reach_beyond_a_day(spark):
    t0 = datetime(2024, 1, 1, 23, 30)
    rows = spark.createDataFrame([("a", t0 + timedelta(hours=h), float(h)) for h in (0, 24, 25, 49)],
                                 "station string, time timestamp, aqi double")
    rows = rows.withColumns({c: F.lit(1.0) for c in K.CURRENT_COLS})
    got = {(r.horizon_h, r.aqi_target) for r in horizon_samples(rows, horizons=[1, 24, 49]).collect()}
    assert got == {(24, 24.0), (1, 25.0), (24, 49.0), (49, 49.0)}


def test_traffic_current_keeps_the_last_place_of_a_corridor(spark):
    gold = spark.createDataFrame(
        [("c", 1.0, 1.0, "2024-01-01T00:00:00+00:00"), ("c", 2.0, 2.0, "2024-01-02T00:00:00+00:00"),
         ("d", 3.0, 3.0, None), (None, 4.0, 4.0, None)],
        "corridor string, lat double, lon double, last_updated string")
    got = {(r.corridor, r.lat) for r in serving.traffic_current(gold).collect()}
    assert got == {("c", 2.0), ("d", 3.0)}
