"""Payload normalisers (JSN1-JSN8, AGG9): raw API response text -> typed feed records.

Every normaliser is ``from_json`` with an explicit schema plus Column expressions and a VARIANT gate
(``operators.payload``): only objects are responses, a missing block counts as empty, a null or
non-object block makes the response unusable. Such a response yields no record.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions import constants as K
from airshed.functions.numeric import congestion_ratio
from airshed.operators import payload as P

D, S = T.DoubleType(), T.StringType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def _gated(raw: DataFrame, body: str, *checks) -> DataFrame:
    """The responses that are objects and pass every check (functions of a VARIANT), with ``_v``, the
    body as VARIANT. The checks share one parse: it is bound to the lambda's variable."""
    value = P.parsed(body)
    ok = F.exists(F.array(value), lambda v: reduce(and_, [c(v) for c in checks], P.is_object(v)))
    return raw.filter(ok).withColumn("_v", value)


# ---------------------------------------------------------------- JSN1
def encode(df: DataFrame, cols=None, name: str = "value") -> DataFrame:
    """Record -> JSON text (stream value)."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias(name))


def decode(df: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """JSON text -> typed columns; malformed text gives an all-NULL record."""
    return df.select(F.from_json(F.col(col), schema).alias("_r")).select("_r.*")


# ---------------------------------------------------------------- JSN2 / JSN3 (AQI)
CURRENT_AQ = _st(("current", _st(("us_aqi", D), ("pm2_5", D), ("pm10", D),
                                 ("nitrogen_dioxide", D), ("ozone", D),
                                 ("sulphur_dioxide", D), ("carbon_monoxide", D))))


def aq_current(raw: DataFrame, station: Column, lat: Column, lon: Column, ts: Column,
               body: str = "body") -> DataFrame:
    """JSN2: primary AQ response -> AQI record; a missing ``us_aqi`` rejects the record."""
    c = F.from_json(F.col(body), CURRENT_AQ).getField("current")
    out = _gated(raw, body, lambda v: P.is_object(v, "$.current")).select(station.alias("station"), lat.alias("lat"), lon.alias("lon"),
                     ts.alias("timestamp"), c.getField("us_aqi").alias("aqi"),
                     c.getField("pm2_5").alias("pm25"), c.getField("pm10").alias("pm10"),
                     c.getField("nitrogen_dioxide").alias("no2"), c.getField("ozone").alias("o3"),
                     c.getField("sulphur_dioxide").alias("so2"),
                     c.getField("carbon_monoxide").alias("co"), F.lit("open-meteo-aq").alias("source"))
    return out.filter(F.col("aqi").isNotNull())


_IAQI = _st(*[(p, _st(("v", D))) for p in ["pm25", "pm10", "no2", "o3", "so2", "co"]])
FALLBACK_AQ = _st(("status", S), ("data", _st(("aqi", S), ("iaqi", _IAQI))))


def aq_fallback(raw: DataFrame, station: Column, lat: Column, lon: Column, ts: Column,
                body: str = "body") -> DataFrame:
    """JSN3: fallback feed; only ``status == "ok"`` with a ``data`` block; nested ``iaqi.<p>.v``, missing -> NULL
    (a null ``iaqi`` or pollutant block is unusable).

    ``aqi`` stays text: this feed may send "-", which the silver filter drops.
    """
    r = F.from_json(F.col(body), FALLBACK_AQ)
    d = r.getField("data")
    iaqi = d.getField("iaqi")
    out = _gated(raw, body, lambda v: P.is_object(v, "$.data"), *[
        (lambda v, b=b: P.optional_object(v, f"$.data.iaqi{b}"))
        for b in ["", *[f".{p}" for p in K.SENSOR_PARAMS]]]).filter(
        r.getField("status") == "ok").select(
                     station.alias("station"), lat.alias("lat"), lon.alias("lon"), ts.alias("timestamp"),
                     d.getField("aqi").alias("aqi"),
                     *[iaqi.getField(p).getField("v").alias(p)
                       for p in ["pm25", "pm10", "no2", "o3", "so2", "co"]],
                     F.lit("aqicn").alias("source"))
    return out


# ---------------------------------------------------------------- JSN4 (weather)
OWM = _st(("main", _st(("temp", D), ("feels_like", D), ("humidity", D), ("pressure", D))),
          ("wind", _st(("speed", D), ("deg", D), ("gust", D))),
          ("clouds", _st(("all", D))), ("visibility", D),
          ("weather", T.ArrayType(_st(("main", S), ("description", S)))),
          ("rain", _st(("1h", D))))


def weather_payload(raw: DataFrame, station: Column, lat: Column, lon: Column, ts: Column,
                    uv: Column | None = None, body: str = "body") -> DataFrame:
    """JSN4: flatten; missing wind.deg and rain.1h are 0; a response in which one of the required
    keys (main block, wind speed, clouds, first weather entry) is missing is rejected, while a
    null value is kept as NULL."""
    r = F.from_json(F.col(body), OWM)
    main, wind, w0 = r.getField("main"), r.getField("wind"), F.try_element_at(r.getField("weather"), F.lit(1))
    v = F.col("_v")
    needed = [*[f"$.main.{c}" for c in ("temp", "feels_like", "humidity", "pressure")], "$.wind.speed",
              "$.clouds.all", "$.weather[0].main", "$.weather[0].description"]
    out = _gated(raw, body, lambda v: P.has(v, *needed), lambda v: P.optional_object(v, "$.rain")).select(
        station.alias("station"), lat.alias("lat"), lon.alias("lon"),
        ts.alias("timestamp"),
        main.getField("temp").alias("temp_c"), main.getField("feels_like").alias("feels_like_c"),
        main.getField("humidity").alias("humidity_pct"), main.getField("pressure").alias("pressure_hpa"),
        wind.getField("speed").alias("wind_speed_ms"),
        P.default(v, "$.wind.deg", wind.getField("deg"), 0.0).alias("wind_deg"),
        wind.getField("gust").alias("wind_gust_ms"), r.getField("visibility").alias("visibility_m"),
        r.getField("clouds").getField("all").alias("clouds_pct"),
        w0.getField("main").alias("weather_main"), w0.getField("description").alias("weather_desc"),
        P.default(v, "$.rain['1h']", r.getField("rain").getField("1h"), 0.0).alias("rain_1h_mm"),
        (uv if uv is not None else F.lit(None).cast("double")).alias("uv_index"),
        F.lit("openweathermap+openmeteo-uv").alias("source"))
    return out


# ---------------------------------------------------------------- JSN5 (traffic)
FLOW = _st(("flowSegmentData", _st(("currentSpeed", D), ("freeFlowSpeed", D), ("confidence", D),
                                   ("roadClosure", T.BooleanType()))))


def traffic_payload(raw: DataFrame, corridor: Column, lat: Column, lon: Column, ts: Column,
                    body: str = "body") -> DataFrame:
    """JSN5: missing values are speed 0, free flow 1, closure false; ratio by FN9. A body that is
    no object (NULL, malformed, an array, a scalar), and one whose block or speeds are null, is no
    reading."""
    v = F.col("_v")
    d = F.from_json(F.col(body), FLOW).getField("flowSegmentData")
    cur = F.coalesce(d.getField("currentSpeed"), F.lit(K.TRAFFIC_DEFAULTS["current_speed_kmh"]))
    free = F.coalesce(d.getField("freeFlowSpeed"), F.lit(K.TRAFFIC_DEFAULTS["free_flow_kmh"]))
    raw = _gated(raw, body, lambda v: P.optional_object(v, "$.flowSegmentData"), lambda v: P.not_null(
        v, "$.flowSegmentData.currentSpeed", "$.flowSegmentData.freeFlowSpeed"))
    return raw.select(corridor.alias("corridor"), lat.alias("lat"), lon.alias("lon"),
                      ts.alias("timestamp"), cur.alias("current_speed_kmh"),
                      free.alias("free_flow_kmh"), congestion_ratio(cur, free).alias("congestion_ratio"),
                      d.getField("confidence").alias("confidence"),
                      P.default(v, "$.flowSegmentData.roadClosure", d.getField("roadClosure"),
                                K.TRAFFIC_DEFAULTS["road_closure"]).alias("road_closure"),
                      F.lit("tomtom").alias("source"))


# ---------------------------------------------------------------- JSN6 (UV)
UVR = _st(("result", _st(("uv", D), ("uv_max", D), ("uv_max_time", S), ("ozone", D),
                         ("safe_exposure_time", _st(("st2", D))))))


def uv_payload(raw: DataFrame, station: Column, lat: Column, lon: Column, ts: Column,
               body: str = "body") -> DataFrame:
    """JSN6: UV flatten incl. ``safe_exposure_time.st2``. A response without a result is a record of
    NULLs; one whose result or exposure block is null, or that is no object, is none."""
    raw = _gated(raw, body, lambda v: P.optional_object(v, "$.result"),
                 lambda v: P.optional_object(v, "$.result.safe_exposure_time"))
    r = F.from_json(F.col(body), UVR).getField("result")
    return raw.select(station.alias("station"), lat.alias("lat"), lon.alias("lon"),
                      ts.alias("timestamp"), r.getField("uv").alias("uv"),
                      r.getField("uv_max").alias("uv_max"), r.getField("uv_max_time").alias("uv_max_time"),
                      r.getField("ozone").alias("ozone"),
                      r.getField("safe_exposure_time").getField("st2").alias("safe_exposure_min"),
                      F.lit("openuv").alias("source"))


# ---------------------------------------------------------------- JSN7 / JSN8 (parallel arrays)
def zip_hourly(arrays: dict[str, Column], limit: int | None = 24) -> Column:
    """JSN7: parallel arrays -> array<struct>, first ``limit`` entries.

    A NULL input array is treated as empty (padded with NULLs by the zip), so a missing
    series does not null the whole forecast.
    """
    cols = [F.coalesce(c, F.array().cast(T.ArrayType(T.StringType() if n == "time" else D))).alias(n)
            for n, c in arrays.items()]
    z = F.arrays_zip(*cols)
    size = F.lit(limit) if limit else F.size(z)
    if "time" in arrays:  # hours without a time are none
        size = F.least(size, F.coalesce(F.size(arrays["time"]), F.lit(0)))
    return F.slice(z, 1, F.greatest(size, F.lit(0)))


def explode_hourly(df: DataFrame, keys, arrays: dict[str, Column], limit: int | None = None) -> DataFrame:
    """JSN8: parallel hourly arrays -> one row per hour; empty arrays -> no rows."""
    return df.select(*keys, F.inline(zip_hourly(arrays, limit)))


OPENMETEO_CURRENT = {"temp_c": "temperature_2m", "humidity_pct": "relative_humidity_2m",
                     "wind_speed_ms": "wind_speed_10m", "wind_deg": "wind_direction_10m",
                     "wind_gust_ms": "wind_gusts_10m", "pressure_hpa": "surface_pressure",
                     "cloud_cover_pct": "cloud_cover", "uv_index": "uv_index",
                     "boundary_layer_height_m": "boundary_layer_height",
                     "precipitation_mm": "precipitation"}
OPENMETEO_HOURLY = {"temp_c": "temperature_2m", "wind_speed_ms": "wind_speed_10m",
                    "wind_deg": "wind_direction_10m", "uv_index": "uv_index",
                    "boundary_layer_height_m": "boundary_layer_height",
                    "precip_probability_pct": "precipitation_probability"}
OPENMETEO = _st(("current", _st(*[(n, D) for n in OPENMETEO_CURRENT.values()])),
                ("hourly", _st(("time", T.ArrayType(S)),
                               *[(n, T.ArrayType(D)) for n in OPENMETEO_HOURLY.values()])))
FORECAST_HOURS = 24


def openmeteo_payload(raw: DataFrame, station: Column, lat: Column, lon: Column, ts: Column,
                      body: str = "body") -> DataFrame:
    """JSN7: current values and the first 24 hours as ``forecast_24h`` (array of structs).

    A missing block or series is empty (its values NULL); a response whose block, time list or series
    is null, or with a series shorter than the hours that it should fill, yields no record."""
    r = F.from_json(F.col(body), OPENMETEO)
    now, hourly = r.getField("current"), r.getField("hourly")
    times = F.slice(F.coalesce(hourly.getField("time"), F.array().cast("array<string>")), 1, FORECAST_HOURS)
    lists = ["time", *OPENMETEO_HOURLY.values()]
    raw = _gated(
        raw, body, *[(lambda v, b=b: P.optional_object(v, b)) for b in ("$.current", "$.hourly")],
        *[(lambda v, n=n: P.optional_array(v, f"$.hourly.{n}")) for n in lists])
    series = {n: hourly.getField(c) for n, c in OPENMETEO_HOURLY.items()}
    long_enough = [F.coalesce(F.size(c) >= F.size(times), F.lit(True)) for c in series.values()]
    zipped = F.arrays_zip(times.alias("time"), *[F.coalesce(
        F.slice(c, 1, FORECAST_HOURS), F.transform(times, lambda _: F.lit(None).cast("double"))).alias(n)
        for n, c in series.items()])
    return raw.filter(reduce(and_, long_enough)).select(
        station.alias("station"), lat.alias("lat"), lon.alias("lon"), ts.alias("timestamp"),
        *[now.getField(c).alias(n) for n, c in OPENMETEO_CURRENT.items()],
        F.slice(zipped, F.lit(1), F.size(times)).alias("forecast_24h"), F.lit("open-meteo").alias("source"))


# ---------------------------------------------------------------- AGG9 (sensor list pivot)
def openaq_payload(raw: DataFrame, station: Column, location_id: Column, ts: Column,
                   body: str = "body") -> DataFrame:
    """AGG9 over the payload: the first result's sensors folded, in the row, to a map of parameter to
    value; then one column per known parameter.

    Names are lower-cased; empty or missing names and missing or null values are skipped; of a repeated
    name the last value stays. No results: no record. A sensor whose parameter block or name is null makes
    the response unusable."""
    v = F.col("_v")
    sensors = F.try_variant_get(v, "$.results[0].sensors", "array<variant>")
    null_in = lambda s, path: F.coalesce(F.is_variant_null(P.part(s, path)), F.lit(False))
    usable = lambda v: ~F.coalesce(F.exists(
        F.try_variant_get(v, "$.results[0].sensors", "array<variant>"),
        lambda s: null_in(s, "$.parameter") | null_in(s, "$.parameter.name")), F.lit(False))

    def fold(seen: Column, s: Column) -> Column:
        name = F.lower(F.coalesce(F.try_variant_get(s, "$.parameter.name", "string"), F.lit("")))
        value = F.try_variant_get(s, "$.value", "double")
        return F.when((name == "") | value.isNull(), seen).otherwise(F.map_concat(
            F.map_filter(seen, lambda k, _: k != name), F.create_map(name, value)))

    raw = _gated(raw, body, lambda v: P.is_object(v, "$.results[0]"), lambda v: P.optional_array(
        v, "$.results[0].sensors"), usable)
    folded = F.aggregate(F.coalesce(sensors, F.array().cast("array<variant>")),
                         F.create_map().cast("map<string,double>"), fold)
    return (raw.select(station.alias("station"), location_id.cast("string").alias("location_id"),
                       ts.alias("timestamp"), folded.alias("_m"))
            .select("station", "location_id", "timestamp", *[F.try_element_at("_m", F.lit(p)).alias(p)
                                                             for p in K.SENSOR_PARAMS],
                    F.lit("openaq").alias("source")))


def sensor_pivot(long: DataFrame, keys=("site", "slot"), params=K.SENSOR_PARAMS) -> DataFrame:
    """AGG9: one wide row per poll from (keys, pos, name, value) sensor entries.

    Names are lower-cased; empty names and NULL values are skipped; for a repeated name the
    last entry (largest ``pos``) wins.  Every poll yields a row, even with no usable entry.
    Conditional ``max_by`` per parameter: a partial aggregate, no pivot value discovery.
    """
    p = F.lower(F.col("name"))
    usable = (p != "") & F.col("value").isNotNull()
    return long.groupBy(*keys).agg(*[
        F.max_by(F.col("value"), F.when(usable & (p == name), F.col("pos"))).alias(name)
        for name in params])


def sensors_from_payload(raw: DataFrame, keys, body: str = "body") -> DataFrame:
    """Sensor-list response -> long entries (keys, pos, name, value) for ``sensor_pivot``; a response
    without results has none."""
    sensor = _st(("parameter", _st(("name", S))), ("value", D))
    result = _st(("sensors", T.ArrayType(sensor)))
    schema = _st(("results", T.ArrayType(result)))
    first = F.try_element_at(F.from_json(F.col(body), schema).getField("results"), F.lit(1))
    ex = raw.filter(first.isNotNull()).select(*keys, F.posexplode_outer(first.getField("sensors")).alias("pos", "s"))
    return ex.select(*keys, "pos", F.col("s.parameter.name").alias("name"),
                     F.col("s.value").alias("value"))
