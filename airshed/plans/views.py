"""Serving views (VW1-VW6) over the marts; each is a projection / filter / small union."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions import constants as K
from airshed.functions.classify import (aqi_category, compass_point, pretty_name, trend_label,
                                        uv_band)
from airshed.functions.numeric import current_value, default_fill
from airshed.functions.timeparts import local_parts, parse_ts, target_parts
from airshed.operators.clean import map_ready, point_lookup


def stations(current: DataFrame) -> DataFrame:
    """VW1 / SRT1: station list sorted by name."""
    return current.select("station", "current_aqi", "aqi_category", "reading_count",
                          "last_updated", "weather_updated", "temp_c").orderBy("station")


def station_series(features: DataFrame, station: str | None = None) -> DataFrame:
    """VW1 / SRT2: per-station series ascending, fixed 6-column shape (all stations, or one)."""
    df = features if station is None else point_lookup(features, "station", station)
    return (df.select("station", "timestamp", "aqi", "pm25", "pm10", "no2", "o3")
              .orderBy("station", "timestamp"))


def station_detail(current: DataFrame, features: DataFrame, station: str) -> DataFrame:
    """VW1 / PRJ11: the whole serving record of one station with its series (ascending, the fixed 6 columns)
    as an array; no row for an unknown station. Both sides are filtered before they are read."""
    series = (station_series(features, station).groupBy("station").agg(F.array_sort(F.collect_list(
        F.struct("timestamp", "aqi", "pm25", "pm10", "no2", "o3"))).alias("series")))
    return point_lookup(current, "station", station).join(series, "station", "left").withColumn(
        "readings", F.coalesce(F.size("series"), F.lit(0)))


def traffic(gold_traffic: DataFrame) -> DataFrame:
    """VW2: corridor list sorted by name."""
    return gold_traffic.orderBy("corridor")


def dashboard_stations(current: DataFrame) -> DataFrame:
    """VW6: display name, current AQI and PM2.5 (FN7), band, coordinates."""
    aqi = current_value("latest_aqi", "avg_aqi")
    return current.select(
        "station", pretty_name("station").alias("name"), aqi.alias("current_aqi"),
        current_value("latest_pm25", "avg_pm25").alias("current_pm25"),
        aqi_category(aqi, K.AQI_UNKNOWN_LABEL).alias("band"), "lat", "lon")


def dashboard_traffic(gold_traffic: DataFrame) -> DataFrame:
    return gold_traffic.select("corridor", pretty_name("corridor").alias("name"),
                               "avg_speed_kmh", "congestion_level", "lat", "lon")


def map_points(current: DataFrame, gold_traffic: DataFrame) -> DataFrame:
    """VW6 / PRJ12: markers for stations and corridors that have both coordinates."""
    st = dashboard_stations(current).select(F.lit("station").alias("kind"),
                                            F.col("station").alias("id"), "name", "lat", "lon",
                                            F.col("band").alias("label"))
    tr = dashboard_traffic(gold_traffic).select(F.lit("corridor").alias("kind"),
                                                F.col("corridor").alias("id"), "name", "lat",
                                                "lon", F.col("congestion_level").alias("label"))
    return map_ready(st.unionByName(tr))


def uv_bands(uv: DataFrame) -> DataFrame:
    """FN3 over UV readings."""
    u = F.col("uv").try_cast("double")
    return uv.select("station", "timestamp", u.alias("uv"), uv_band(u).alias("uv_band"))


def wind_octants(weather: DataFrame) -> DataFrame:
    """FN4 over weather readings."""
    return weather.select("station", "timestamp", "wind_deg",
                          compass_point("wind_deg").alias("wind_dir"))


def scoring_features(current: DataFrame, now_utc: str, horizons=K.HORIZONS) -> DataFrame:
    """ML9 + FN7 + FN8 + FN13 + FN14: one feature row per (station, horizon).

    Current pollutants fall back to the window average, then NULL/0 -> 0; weather NULL/0 ->
    the scoring defaults; hour and weekday are local (UTC+7) at ``now_utc``.
    """
    now = parse_ts(F.lit(now_utc))
    hour, dow = local_parts(now, K.SCORING_TZ)
    pol = {p: default_fill(current_value(f"latest_{p}", f"avg_{p}"), 0.0)
           for p in ["pm25", "pm10", "no2", "o3"]}
    wx = {f: default_fill(F.col(f), d) for f, d in K.SCORING_DEFAULTS.items()}
    hs = F.array(*[F.lit(int(h)).cast("long") for h in sorted(set(h for h in horizons if h >= 0))])
    base = current.select("station", *[c.alias(n) for n, c in pol.items()],
                          *[c.alias(n) for n, c in wx.items()],
                          hour.alias("hour"), dow.alias("dayofweek"),
                          F.explode(hs).alias("horizon_h"))
    th, td = target_parts("hour", "dayofweek", "horizon_h")
    return base.withColumns({"target_hour": th.cast("long"), "target_dayofweek": td.cast("long")})


def forecast_time_grid(current: DataFrame, now_utc: str, horizons=K.HORIZONS) -> DataFrame:
    """FN15: valid time (local, ISO text) of every (station, horizon)."""
    hs = F.array(*[F.lit(int(h)).cast("long") for h in sorted(set(horizons))])
    g = current.select("station", F.explode(hs).alias("horizon_h"))
    return with_valid_time(g, now_utc)


def with_valid_time(forecast: DataFrame, now_utc: str) -> DataFrame:
    """FN15 / ML13: adds the local valid time (ISO text) of ``horizon_h`` hours after ``now_utc``."""
    now_local = F.from_utc_timestamp(parse_ts(F.lit(now_utc)), K.SCORING_TZ)
    vt = now_local + F.make_dt_interval(F.lit(0), F.col("horizon_h").cast("int"))
    return forecast.withColumn("valid_time", F.date_format(
        vt, "yyyy-MM-dd'T'HH:mm:ss'" + K.SCORING_TZ + "'"))


def trend_table(pairs: DataFrame, current: DataFrame) -> DataFrame:
    """ML14 / VW4 trend: nowcast, +H forecast, delta (1 decimal), label; JN6 adds the
    station's current AQI."""
    from airshed.functions.numeric import round_half_even
    delta = round_half_even(F.col("forecast_aqi") - F.col("nowcast_aqi"), 1)
    cur = current.select("station", current_value("latest_aqi", "avg_aqi").alias("current_aqi"))
    return (pairs.withColumn("delta", delta)
                 .withColumn("trend", trend_label("delta"))
                 .join(cur, on="station", how="left"))
