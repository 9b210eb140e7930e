"""Feed-shaped views derived from the driver tables.

The pipeline consumes sensor records (AQI, weather, wind, UV, traffic, sensor lists).  These
adapters derive such records from the generated ``events`` and ``lineitem`` tables so that
every query reads the given tables and its work grows with them.  Each adapter has a
DataFrame form and the equivalent DuckDB SQL (used by the oracle); both must compute the
same IEEE doubles, so every constant is an explicit double and integers are cast first.

Mapping (events): AQI readings come from error/purchase/signup events, weather from view
events, UV from click events; ``user_id`` is the station (``st-0007``) and ``props.k`` an
integer driving the secondary metrics.  Traffic comes from lineitem: ``l_suppkey`` is the
corridor (``co-0042``), ``l_shipdate`` the reading time, ``l_quantity`` the current speed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions.numeric import congestion_ratio
from airshed.functions.text import padded_id
from airshed.functions.timeparts import iso_utc
from airshed.sources.tables import table

AQI_EVENT_TYPES = ["error", "purchase", "signup"]
WEATHER_EVENT_TYPE = "view"
UV_EVENT_TYPE = "click"
FREE_FLOW_KMH = 50.0


def _d(x: float) -> Column:
    return F.lit(float(x))


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int").cast("double")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
                     "event_type", "value", _k().alias("k"))


def _station_cols(user_id: Column) -> list[Column]:
    return [padded_id("st-", user_id, 4).alias("station"),
            (_d(-6.1) - user_id.cast("double") * _d(0.001)).alias("lat"),
            (_d(106.6) + user_id.cast("double") * _d(0.002)).alias("lon")]


# ---------------------------------------------------------------- AQI
def aqi_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AQI records: aqi = 2*value - 10 runs past both ends of 0..500 on purpose."""
    ev = _events(spark, sf_dir).filter(F.col("event_type").isin(AQI_EVENT_TYPES))
    v, k = F.col("value"), F.col("k")
    return ev.select(
        *_station_cols(F.col("user_id")),
        iso_utc("ts").alias("timestamp"),
        (v * _d(2.0) - _d(10.0)).alias("aqi"),
        (v * _d(0.5)).alias("pm25"),
        (v * _d(0.8) + k * _d(0.1)).alias("pm10"),
        (k * _d(0.3) + _d(1.0)).alias("no2"),
        (v * _d(0.2) + _d(2.0)).alias("o3"),
        F.when(k >= 10, k * _d(0.05)).alias("so2"),
        (v * _d(0.01)).alias("co"),
        F.lit("events").alias("source"),
    )


AQI_RAW_SQL = """
SELECT printf('st-%04d', user_id) AS station,
       -6.1::DOUBLE - CAST(user_id AS DOUBLE) * 0.001::DOUBLE AS lat,
       106.6::DOUBLE + CAST(user_id AS DOUBLE) * 0.002::DOUBLE AS lon,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp,
       value * 2.0::DOUBLE - 10.0::DOUBLE AS aqi,
       value * 0.5::DOUBLE AS pm25,
       value * 0.8::DOUBLE + k * 0.1::DOUBLE AS pm10,
       k * 0.3::DOUBLE + 1.0::DOUBLE AS no2,
       value * 0.2::DOUBLE + 2.0::DOUBLE AS o3,
       CASE WHEN k >= 10 THEN k * 0.05::DOUBLE END AS so2,
       value * 0.01::DOUBLE AS co,
       'events' AS source
FROM (SELECT *, CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS k
      FROM events WHERE event_type IN ('error', 'purchase', 'signup'))
"""


def aqi_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AQI records as they arrive from the fallback feed: metrics as text, with junk.

    k = 13 -> aqi '-', k = 17 -> aqi 'n/a', k = 19 -> no station, k = 23 -> unparsable time.
    """
    ev_k = _events(spark, sf_dir).filter(F.col("event_type").isin(AQI_EVENT_TYPES))
    k = F.col("k")
    rec = ev_k.select(
        F.when(k == 19, F.lit(None).cast("string"))
         .otherwise(padded_id("st-", F.col("user_id"), 4)).alias("station"),
        (_d(-6.1) - F.col("user_id").cast("double") * _d(0.001)).alias("lat"),
        (_d(106.6) + F.col("user_id").cast("double") * _d(0.002)).alias("lon"),
        F.when(k == 23, F.lit("not-a-time")).otherwise(iso_utc("ts")).alias("timestamp"),
        F.when(k == 13, F.lit("-")).when(k == 17, F.lit("n/a"))
         .otherwise((F.col("value") * _d(2.0) - _d(10.0)).cast("string")).alias("aqi"),
        (F.col("value") * _d(0.5)).cast("string").alias("pm25"),
        (F.col("value") * _d(0.8) + k * _d(0.1)).cast("string").alias("pm10"),
        (k * _d(0.3) + _d(1.0)).cast("string").alias("no2"),
        (F.col("value") * _d(0.2) + _d(2.0)).cast("string").alias("o3"),
        F.when(k >= 10, (k * _d(0.05)).cast("string")).alias("so2"),
        (F.col("value") * _d(0.01)).cast("string").alias("co"),
        F.lit("events").alias("source"),
    )
    return rec


AQI_DIRTY_SQL = """
SELECT CASE WHEN k = 19 THEN NULL ELSE printf('st-%04d', user_id) END AS station,
       -6.1::DOUBLE - CAST(user_id AS DOUBLE) * 0.001::DOUBLE AS lat,
       106.6::DOUBLE + CAST(user_id AS DOUBLE) * 0.002::DOUBLE AS lon,
       CASE WHEN k = 23 THEN 'not-a-time'
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS timestamp,
       CASE WHEN k = 13 THEN '-' WHEN k = 17 THEN 'n/a'
            ELSE CAST(value * 2.0::DOUBLE - 10.0::DOUBLE AS VARCHAR) END AS aqi,
       CAST(value * 0.5::DOUBLE AS VARCHAR) AS pm25,
       CAST(value * 0.8::DOUBLE + k * 0.1::DOUBLE AS VARCHAR) AS pm10,
       CAST(k * 0.3::DOUBLE + 1.0::DOUBLE AS VARCHAR) AS no2,
       CAST(value * 0.2::DOUBLE + 2.0::DOUBLE AS VARCHAR) AS o3,
       CASE WHEN k >= 10 THEN CAST(k * 0.05::DOUBLE AS VARCHAR) END AS so2,
       CAST(value * 0.01::DOUBLE AS VARCHAR) AS co,
       'events' AS source
FROM (SELECT *, CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS k
      FROM events WHERE event_type IN ('error', 'purchase', 'signup'))
"""


# ---------------------------------------------------------------- weather / wind
def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).filter(F.col("event_type") == WEATHER_EVENT_TYPE)
    v, k = F.col("value"), F.col("k")
    main = F.when(k < 30, "Clear").when(k < 70, "Clouds").otherwise("Rain")
    return ev.select(
        *_station_cols(F.col("user_id")),
        iso_utc("ts").alias("timestamp"),
        (_d(20.0) + v * _d(0.05)).alias("temp_c"),
        (_d(20.0) + v * _d(0.05) + k * _d(0.01)).alias("feels_like_c"),
        (_d(40.0) + k * _d(0.5)).alias("humidity_pct"),
        (_d(1000.0) + k * _d(0.2)).alias("pressure_hpa"),
        (v * _d(0.02)).alias("wind_speed_ms"),
        F.pmod(k * _d(15.0), _d(360.0)).alias("wind_deg"),
        (v * _d(0.03)).alias("wind_gust_ms"),
        (_d(10000.0) - k * _d(10.0)).alias("visibility_m"),
        k.alias("clouds_pct"),
        main.alias("weather_main"),
        F.concat(F.lower(main), F.lit(" sky")).alias("weather_desc"),
        F.when(k >= 70, v * _d(0.01)).otherwise(_d(0.0)).alias("rain_1h_mm"),
        (k * _d(0.11)).alias("uv_index"),
        F.lit("events").alias("source"),
    )


WEATHER_RAW_SQL = """
SELECT printf('st-%04d', user_id) AS station,
       -6.1::DOUBLE - CAST(user_id AS DOUBLE) * 0.001::DOUBLE AS lat,
       106.6::DOUBLE + CAST(user_id AS DOUBLE) * 0.002::DOUBLE AS lon,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp,
       20.0::DOUBLE + value * 0.05::DOUBLE AS temp_c,
       20.0::DOUBLE + value * 0.05::DOUBLE + k * 0.01::DOUBLE AS feels_like_c,
       40.0::DOUBLE + k * 0.5::DOUBLE AS humidity_pct,
       1000.0::DOUBLE + k * 0.2::DOUBLE AS pressure_hpa,
       value * 0.02::DOUBLE AS wind_speed_ms,
       (k * 15.0::DOUBLE) % 360.0::DOUBLE AS wind_deg,
       value * 0.03::DOUBLE AS wind_gust_ms,
       10000.0::DOUBLE - k * 10.0::DOUBLE AS visibility_m,
       k AS clouds_pct,
       CASE WHEN k < 30 THEN 'Clear' WHEN k < 70 THEN 'Clouds' ELSE 'Rain' END AS weather_main,
       lower(CASE WHEN k < 30 THEN 'Clear' WHEN k < 70 THEN 'Clouds' ELSE 'Rain' END) || ' sky'
           AS weather_desc,
       CASE WHEN k >= 70 THEN value * 0.01::DOUBLE ELSE 0.0::DOUBLE END AS rain_1h_mm,
       k * 0.11::DOUBLE AS uv_index,
       'events' AS source
FROM (SELECT *, CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS k
      FROM events WHERE event_type = 'view')
"""


def wind_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ10: the wind projection emitted next to every weather record."""
    return weather_raw(spark, sf_dir).select(
        "station", "lat", "lon", "timestamp", "wind_speed_ms", "wind_deg", "wind_gust_ms",
        F.lit("wind").alias("source"))


WIND_RAW_SQL = f"""
SELECT station, lat, lon, timestamp, wind_speed_ms, wind_deg, wind_gust_ms, 'wind' AS source
FROM ({WEATHER_RAW_SQL})
"""


# ---------------------------------------------------------------- UV
def uv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).filter(F.col("event_type") == UV_EVENT_TYPE)
    v, k = F.col("value"), F.col("k")
    return ev.select(
        *_station_cols(F.col("user_id")),
        iso_utc("ts").alias("timestamp"),
        (v * _d(0.03)).alias("uv"),
        (v * _d(0.04)).alias("uv_max"),
        iso_utc(F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("uv_max_time"),
        (_d(250.0) + k).alias("ozone"),
        (k * _d(2.0)).alias("safe_exposure_min"),
        F.lit("events").alias("source"),
    )


UV_RAW_SQL = """
SELECT printf('st-%04d', user_id) AS station,
       -6.1::DOUBLE - CAST(user_id AS DOUBLE) * 0.001::DOUBLE AS lat,
       106.6::DOUBLE + CAST(user_id AS DOUBLE) * 0.002::DOUBLE AS lon,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp,
       value * 0.03::DOUBLE AS uv,
       value * 0.04::DOUBLE AS uv_max,
       strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS uv_max_time,
       250.0::DOUBLE + k AS ozone,
       k * 2.0::DOUBLE AS safe_exposure_min,
       'events' AS source
FROM (SELECT *, CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS k
      FROM events WHERE event_type = 'click')
"""


# ---------------------------------------------------------------- traffic
def traffic_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    sk = F.col("l_suppkey").cast("double")
    q = F.col("l_quantity")
    return li.select(
        padded_id("co-", F.col("l_suppkey"), 4).alias("corridor"),
        (_d(-6.2) - sk * _d(0.001)).alias("lat"),
        (_d(106.7) + sk * _d(0.002)).alias("lon"),
        iso_utc(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        q.alias("current_speed_kmh"),
        _d(FREE_FLOW_KMH).alias("free_flow_kmh"),
        congestion_ratio(q, _d(FREE_FLOW_KMH)).alias("congestion_ratio"),
        (_d(1.0) - F.col("l_discount")).alias("confidence"),
        (F.col("l_returnflag") == "R").alias("road_closure"),
        F.lit("lineitem").alias("source"),
    )


TRAFFIC_RAW_SQL = """
SELECT printf('co-%04d', l_suppkey) AS corridor,
       -6.2::DOUBLE - CAST(l_suppkey AS DOUBLE) * 0.001::DOUBLE AS lat,
       106.7::DOUBLE + CAST(l_suppkey AS DOUBLE) * 0.002::DOUBLE AS lon,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp,
       l_quantity AS current_speed_kmh,
       50.0::DOUBLE AS free_flow_kmh,
       greatest(0.0::DOUBLE, round_even((1.0::DOUBLE - l_quantity / greatest(50.0::DOUBLE, 1.0::DOUBLE))
                                        * 1000.0::DOUBLE, 0) / 1000.0::DOUBLE) AS congestion_ratio,
       1.0::DOUBLE - l_discount AS confidence,
       l_returnflag = 'R' AS road_closure,
       'lineitem' AS source
FROM lineitem
"""


# ---------------------------------------------------------------- hourly series (training)
# Stations are the users, as in the served feeds; every event is a reading of both feeds, and the
# AQI is the one that silver serves (2*value - 10, within 0..500).
def _hourly(spark, sf_dir, metrics: dict, where: Column | None = None) -> DataFrame:
    from airshed.functions.numeric import exact_avg
    ev = _events(spark, sf_dir)
    if where is not None:
        ev = ev.filter(where)
    return (ev.groupBy(padded_id("st-", F.col("user_id"), 4).alias("station"),
                       F.date_trunc("hour", F.col("ts")).alias("time"))
              .agg(*[exact_avg(expr).alias(name) for name, expr in metrics.items()]))


def aq_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly air-quality series per station (mean of the hour's readings)."""
    v, k = F.col("value"), F.col("k")
    aqi = v * _d(2.0) - _d(10.0)
    return _hourly(spark, sf_dir, {
        "pm25": v * _d(0.5), "pm10": v * _d(0.8) + k * _d(0.1),
        "no2": k * _d(0.3) + _d(1.0), "o3": v * _d(0.2) + _d(2.0), "aqi": aqi},
        aqi.between(_d(0.0), _d(500.0)))


def wx_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather series per station."""
    v, k = F.col("value"), F.col("k")
    return _hourly(spark, sf_dir, {
        "temp_c": _d(20.0) + v * _d(0.05), "humidity_pct": _d(40.0) + k * _d(0.5),
        "wind_speed_ms": v * _d(0.02)})


def _exact_avg_sql(expr: str) -> str:
    return (f"CAST(SUM(CAST({expr} AS DECIMAL(38,6))) AS DOUBLE)"
            f" / CAST(COUNT(CAST({expr} AS DECIMAL(38,6))) AS DOUBLE)")


_EV_K = ("(SELECT *, CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE)"
         " AS k FROM events)")

AQ_HOURLY_SQL = f"""
SELECT printf('st-%04d', user_id) AS station, date_trunc('hour', ts) AS time,
       {_exact_avg_sql("value * 0.5::DOUBLE")} AS pm25,
       {_exact_avg_sql("value * 0.8::DOUBLE + k * 0.1::DOUBLE")} AS pm10,
       {_exact_avg_sql("k * 0.3::DOUBLE + 1.0::DOUBLE")} AS no2,
       {_exact_avg_sql("value * 0.2::DOUBLE + 2.0::DOUBLE")} AS o3,
       {_exact_avg_sql("value * 2.0::DOUBLE - 10.0::DOUBLE")} AS aqi
FROM {_EV_K} WHERE value * 2.0::DOUBLE - 10.0::DOUBLE BETWEEN 0 AND 500
GROUP BY 1, 2
"""

WX_HOURLY_SQL = f"""
SELECT printf('st-%04d', user_id) AS station, date_trunc('hour', ts) AS time,
       {_exact_avg_sql("20.0::DOUBLE + value * 0.05::DOUBLE")} AS temp_c,
       {_exact_avg_sql("40.0::DOUBLE + k * 0.5::DOUBLE")} AS humidity_pct,
       {_exact_avg_sql("value * 0.02::DOUBLE")} AS wind_speed_ms
FROM {_EV_K}
GROUP BY 1, 2
"""


# ---------------------------------------------------------------- sensor lists, two AQI feeds
# Sensor parameter name reported for each event type; an empty name is skipped downstream.
SENSOR_NAME_BY_EVENT = {"view": "PM25", "click": "pm10", "signup": "NO2", "purchase": "o3",
                        "error": ""}


def sensor_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sensor entry of a site's poll: (site, slot, pos, name, value)."""
    ev = _events(spark, sf_dir)
    name = F.lit(None).cast("string")
    for et, n in SENSOR_NAME_BY_EVENT.items():
        name = F.when(F.col("event_type") == et, F.lit(n)).otherwise(name)
    return ev.select(
        padded_id("site-", F.col("user_id"), 4).alias("site"),
        iso_utc(F.date_trunc("hour", F.col("ts"))).alias("slot"),
        # entry order: (user, ts) is unique in events, so the time alone orders a site's
        # entries; a long keeps the pivot's max_by buffers fixed-width (hash aggregate)
        F.unix_micros(F.col("ts")).alias("pos"),
        name.alias("name"),
        F.col("value"),
    )


SENSOR_LONG_SQL = """
SELECT printf('site-%04d', user_id) AS site,
       strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS slot,
       ts AS pos_ts, event_id AS pos_id,
       CASE event_type WHEN 'view' THEN 'PM25' WHEN 'click' THEN 'pm10' WHEN 'signup' THEN 'NO2'
                       WHEN 'purchase' THEN 'o3' WHEN 'error' THEN '' END AS name,
       value
FROM events
"""


def aqi_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Primary and secondary AQI feeds polled per (station, hour slot).

    Primary = signup events (a reading above 300 comes back without an AQI, i.e. the
    primary feed failed); secondary = error and purchase events.  Each feed keeps its latest reading in
    the slot.
    """
    ev = _events(spark, sf_dir)

    def feed(types: list[str], src: str, null_above: float | None) -> DataFrame:
        aqi = F.col("value")
        if null_above is not None:
            aqi = F.when(aqi <= null_above, aqi)
        rows = ev.filter(F.col("event_type").isin(types)).select(
            padded_id("st-", F.col("user_id"), 4).alias("station"),
            iso_utc(F.date_trunc("hour", F.col("ts"))).alias("slot"),
            F.col("ts"), aqi.alias("aqi"), (F.col("value") * _d(0.5)).alias("pm25"))
        # (user, ts) is unique, so per-column max_by on the time picks one reading's values;
        # double values and a timestamp ordering keep the buffers fixed-width (hash aggregate)
        return (rows.groupBy("station", "slot")
                    .agg(F.max_by("aqi", "ts").alias("aqi"), F.max_by("pm25", "ts").alias("pm25"))
                    .withColumn("source", F.lit(src)))

    return feed(["signup"], "primary", 300.0), feed(["error", "purchase"], "secondary", None)


def aqi_feed_sql(event_types: list[str], source: str, null_above: float | None) -> str:
    aqi = "value" if null_above is None else f"CASE WHEN value <= {null_above}::DOUBLE THEN value END"
    return f"""
SELECT station, slot, aqi, pm25, source FROM (
  SELECT printf('st-%04d', user_id) AS station,
         strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS slot,
         {aqi} AS aqi, value * 0.5::DOUBLE AS pm25, '{source}' AS source,
         row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC) AS rn
  FROM events WHERE event_type IN ({", ".join(f"'{t}'" for t in event_types)})) WHERE rn = 1
"""


# ---------------------------------------------------------------- response bodies
def openmeteo_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast responses, one per view event: k % 40 + 1 hours. For k % 7 = 0 the temperature series is one
    hour short; for k % 5 = 0 there is no wind series and for k % 9 = 0 no current block."""
    ev = _events(spark, sf_dir).filter(F.col("event_type") == WEATHER_EVENT_TYPE)
    v, k, n = F.col("value"), F.col("k"), (F.col("k").cast("int") % 40 + 1)
    hours = F.sequence(F.lit(0), n - 1)
    times = F.transform(hours, lambda h: iso_utc(F.col("ts") + F.make_dt_interval(F.lit(0), h)))
    temps = F.transform(hours, lambda h: v * _d(0.05) + h.cast("double"))
    hourly = F.struct(
        times.alias("time"),
        F.when(k.cast("int") % 7 == 0, F.slice(temps, F.lit(1), n - 1)).otherwise(temps).alias("temperature_2m"),
        F.when(k.cast("int") % 5 != 0, F.transform(hours, lambda h: h.cast("double") * _d(0.5)))
         .alias("wind_speed_10m"))
    current = F.when(k.cast("int") % 9 != 0, F.struct(v.alias("temperature_2m"), k.alias("cloud_cover")))
    return ev.select(*_station_cols(F.col("user_id")), iso_utc("ts").alias("timestamp"), "event_id",
                     F.to_json(F.struct(current.alias("current"), hourly.alias("hourly"))).alias("body"))


OPENMETEO_SQL = """
SELECT printf('st-%04d', user_id) AS station, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp, ts,
       value, CASE WHEN k % 9 <> 0 THEN value END AS temp_c, CASE WHEN k % 9 <> 0 THEN k::DOUBLE END AS cloud,
       least(24, n) AS n, k
FROM (SELECT *, k % 40 + 1 AS n FROM (
        SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
        WHERE event_type = 'view'))
WHERE NOT (k % 7 = 0 AND n - 1 < least(24, n))
"""


def openaq_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor-list responses, one per click event: a parameter given twice (the second without a value for
    k % 3 = 0), names in either case, an empty and a missing one. No results for k % 11 = 0."""
    ev = _events(spark, sf_dir).filter(F.col("event_type") == UV_EVENT_TYPE)
    v, k = F.col("value"), F.col("k")

    def sensor(name: Column, value: Column) -> Column:
        return F.struct(F.when(name.isNotNull(), F.struct(name.alias("name"))).alias("parameter"),
                        value.alias("value"))
    sensors = F.array(
        sensor(F.lit("PM25"), v), sensor(F.lit("pm25"), F.when(k.cast("int") % 3 != 0, k)),
        sensor(F.lit(""), _d(1.0)), sensor(F.lit(None).cast("string"), _d(2.0)),
        sensor(F.lit("NO2"), k * _d(0.3)), sensor(F.lit("humidity"), v))
    results = F.when(k.cast("int") % 11 != 0, F.array(F.struct(sensors.alias("sensors")))).otherwise(
        F.array().cast("array<struct<sensors:array<struct<parameter:struct<name:string>,value:double>>>>"))
    return ev.select(padded_id("site-", F.col("user_id"), 4).alias("station"),
                     F.col("user_id").alias("location_id"), iso_utc("ts").alias("timestamp"),
                     F.to_json(F.struct(results.alias("results"))).alias("body"))


OPENAQ_SQL = """
SELECT printf('site-%04d', user_id) AS station, CAST(user_id AS VARCHAR) AS location_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp,
       CASE WHEN k % 3 <> 0 THEN k::DOUBLE ELSE value END AS pm25, CAST(NULL AS DOUBLE) AS pm10,
       k * 0.3::DOUBLE AS no2, CAST(NULL AS DOUBLE) AS so2, CAST(NULL AS DOUBLE) AS co,
       CAST(NULL AS DOUBLE) AS o3, 'openaq' AS source
FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
      WHERE event_type = 'click') WHERE k % 11 <> 0
"""

#: Feed -> its block, and what a body with a null block looks like. Dirty bodies go round these.
DIRTY_FEEDS = {"aq": "current", "fallback": "data", "weather": "main", "traffic": "flowSegmentData",
               "uv": "result", "openaq": "results", "openmeteo": "current"}
_VALID = {"aq": '{"current": {"us_aqi": %s}}', "fallback": '{"status": "ok", "data": {"aqi": "%s"}}',
          "weather": '{"main": {"temp": %s, "feels_like": null, "humidity": 1, "pressure": 2}, "wind": '
                     '{"speed": 1}, "clouds": {"all": 1}, "weather": [{"main": "a", "description": "b"}]}',
          "traffic": '{"flowSegmentData": {"currentSpeed": %s}}', "uv": '{"result": {"uv": %s}}',
          "openaq": '{"results": [{"sensors": [{"parameter": {"name": "PM25"}, "value": %s}]}]}',
          "openmeteo": '{"current": {"temperature_2m": %s}}'}


def dirty_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """feed, event_id, k, body: every event is a response of one feed (event_id % 7), in one of eight forms
    (k % 8): no body, malformed, array, scalar, null, empty object, null block, valid."""
    ev = _events(spark, sf_dir)
    feeds = list(DIRTY_FEEDS)
    feed = F.element_at(F.array(*map(F.lit, feeds)), (F.col("event_id") % len(feeds) + 1).cast("int"))
    form = F.col("k").cast("int") % 8
    null_block = F.coalesce(*[F.when(feed == f, F.lit(
        f'{{"{b}": null}}' if f != "fallback" else '{"status": "ok", "data": null}'))
        for f, b in DIRTY_FEEDS.items()])
    valid = F.coalesce(*[F.when(feed == f, F.format_string(t, F.col("k").cast("int"))) for f, t in _VALID.items()])
    body = F.lit(None).cast("string")
    for i, text in enumerate((F.lit("{not json"), F.lit("[]"), F.lit("5"), F.lit("null"), F.lit("{}"),
                              null_block, valid), 1):
        body = F.when(form == i, text).otherwise(body)
    return ev.select(feed.alias("feed"), "event_id", F.col("k").cast("int").alias("k"), body.alias("body"))


DIRTY_SQL = f"""
SELECT list_value({', '.join(f"'{f}'" for f in DIRTY_FEEDS)})[event_id % 7 + 1] AS feed, event_id,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
"""


# ---------------------------------------------------------------- forecast requests
def forecast_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per signup event; fields are missing, and hours and weekdays out of bounds, by k."""
    ev = _events(spark, sf_dir).filter(F.col("event_type") == "signup")
    v, k = F.col("value"), F.col("k").cast("int")
    horizons = (F.when(k % 4 == 1, F.array(*map(F.lit, (6, 3, -1, 6, 0))))
                .when(k % 4 == 2, F.array().cast("array<int>"))
                .when(k % 4 == 3, F.array(k % 30, F.lit(24), F.lit(48), F.lit(None).cast("int"))))
    return ev.select(
        F.col("event_id").alias("request_id"), padded_id("st-", F.col("user_id"), 4).alias("station"),
        F.when(k % 5 != 0, v * _d(0.5)).alias("pm25"), (v * _d(0.8)).alias("pm10"),
        F.when(k % 6 != 0, v * _d(0.2)).alias("o3"), F.when(k % 4 != 0, _d(20.0) + v * _d(0.05)).alias("temp_c"),
        F.when(k % 9 != 0, k % 26 - 1).alias("hour"), F.when(k % 10 != 0, k % 8).alias("dayofweek"),
        horizons.alias("horizons"))


REQUESTS_SQL = """
SELECT event_id AS request_id, printf('st-%04d', user_id) AS station,
       CASE WHEN k % 5 <> 0 THEN value * 0.5::DOUBLE ELSE 0.0 END AS pm25, value * 0.8::DOUBLE AS pm10,
       0.0::DOUBLE AS no2, CASE WHEN k % 6 <> 0 THEN value * 0.2::DOUBLE ELSE 0.0 END AS o3,
       CASE WHEN k % 4 <> 0 THEN 20.0::DOUBLE + value * 0.05::DOUBLE ELSE 28.0 END AS temp_c,
       75.0::DOUBLE AS humidity_pct, 2.0::DOUBLE AS wind_speed_ms,
       CASE WHEN k % 9 <> 0 THEN k % 26 - 1 ELSE 12 END AS hour,
       CASE WHEN k % 10 <> 0 THEN k % 8 ELSE 0 END AS dayofweek,
       CASE k % 4 WHEN 0 THEN range(25) WHEN 1 THEN [0, 3, 6] WHEN 2 THEN []
         ELSE list_distinct([k % 30, 24, 48]) END AS horizons
FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
      WHERE event_type = 'signup')
"""
