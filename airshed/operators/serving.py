"""Serving marts and city-level aggregates (JN3, FN7, AGG3-AGG8).

All inputs here are per-entity marts (one row per station / corridor), so every operator is
a small global or per-entity aggregate; nothing is pulled to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions import constants as K
from airshed.functions.classify import aqi_category
from airshed.functions.numeric import current_value, exact_avg, round_half_even
from airshed.operators.dedup import latest_by


def station_current(gold_stations: DataFrame, gold_weather: DataFrame) -> DataFrame:
    """JN3 + FN7: gold station rows with the latest weather fields and the serving band.

    The weather mart has one row per station; the join is left so stations without weather
    keep NULL fields.  Both sides are per-station marts; AQE turns the join into a broadcast
    at run time when the measured side is small.
    """
    w = gold_weather.select("station", *[F.col(f).alias(f"_w_{f}") for f in K.WEATHER_FIELDS],
                            F.col("last_updated").alias("weather_updated"))
    cur = current_value("latest_aqi", "avg_aqi")
    cols = [c for c in gold_stations.columns if c != "station"]
    # a station that has moved has a gold row per coordinate: the last updated one serves
    newest = F.max_by(F.struct(*cols), F.struct("last_updated", *[
        c for c in cols if c != "last_updated"]))
    stations = (gold_stations.filter(F.col("station").isNotNull())
                .groupBy("station").agg(newest.alias("_g")).select("station", "_g.*"))
    return (stations
            .join(w, on="station", how="left")
            .select(*gold_stations.columns,
                    *[F.col(f"_w_{f}").alias(f) for f in K.WEATHER_FIELDS],
                    "weather_updated",
                    aqi_category(cur, K.AQI_UNKNOWN_LABEL).alias("aqi_category"),
                    cur.alias("current_aqi")))


def traffic_current(gold_traffic: DataFrame) -> DataFrame:
    """JOB5: one row per corridor, the last updated one if it has several coordinates."""
    cols = [c for c in gold_traffic.columns if c != "corridor"]
    order = ["last_updated", *[c for c in cols if c != "last_updated"]]
    return latest_by(gold_traffic.filter(F.col("corridor").isNotNull()), ["corridor"],
                     order, cols).select(*gold_traffic.columns)


def worst_best_station(current: DataFrame) -> DataFrame:
    """AGG5: worst / best station by current AQI; a tie goes to the first station name."""
    rated = current.filter(F.col("current_aqi").isNotNull())
    cur, st = F.col("current_aqi"), F.col("station")
    worst = F.min_by(F.struct(st.alias("s"), cur.alias("a")), F.struct((-cur).alias("v"), st.alias("n")))
    best = F.min_by(F.struct(st.alias("s"), cur.alias("a")), F.struct(cur.alias("v"), st.alias("n")))
    g = rated.agg(worst.alias("w"), best.alias("b"))
    return g.select(
        F.col("w.s").alias("worst_station"),
        round_half_even("w.a", 1).alias("worst_aqi"),
        aqi_category(F.col("w.a"), K.AQI_UNKNOWN_LABEL).alias("worst_category"),
        F.col("b.s").alias("best_station"),
        round_half_even("b.a", 1).alias("best_aqi"),
        aqi_category(F.col("b.a"), K.AQI_UNKNOWN_LABEL).alias("best_category"))


def worst_corridor(traffic: DataFrame) -> DataFrame:
    """AGG6: corridor with the highest average congestion (2 decimals); tie -> first name."""
    rated = traffic.filter(F.col("avg_congestion").isNotNull())
    c, n = F.col("avg_congestion"), F.col("corridor")
    pick = F.min_by(F.struct(n.alias("corridor"), c.alias("c"), F.col("congestion_level").alias("l")),
                    F.struct((-c).alias("v"), n.alias("n")))
    return rated.agg(pick.alias("t")).select(
        F.col("t.corridor").alias("corridor"),
        round_half_even("t.c", 2).alias("avg_congestion"),
        F.col("t.l").alias("congestion_level"))


def city_weather(current: DataFrame) -> DataFrame:
    """AGG7: averages over stations having the field, max UV, 1 decimal; none -> NULL."""
    return current.agg(
        round_half_even(exact_avg("temp_c"), 1).alias("avg_temp_c"),
        round_half_even(exact_avg("humidity_pct"), 1).alias("avg_humidity_pct"),
        round_half_even(exact_avg("wind_speed_ms"), 1).alias("avg_wind_speed_ms"),
        round_half_even(F.max("uv_index"), 1).alias("max_uv_index"))


def overview(current: DataFrame, traffic: DataFrame) -> DataFrame:
    """AGG3-AGG7: the one-row city overview.

    Both marts are stacked into one frame tagged by kind and reduced by a single global
    aggregate with per-kind conditional aggregates, so no join is needed.
    """
    st = current.select(
        F.lit("s").alias("kind"), "station", "current_aqi", "reading_count", "temp_c",
        "humidity_pct", "wind_speed_ms", "uv_index",
        F.lit(None).cast("string").alias("corridor"),
        F.lit(None).cast("double").alias("avg_congestion"),
        F.lit(None).cast("string").alias("congestion_level"))
    tr = traffic.select(
        F.lit("t").alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in [
            ("station", "string"), ("current_aqi", "double"), ("reading_count", "long"),
            ("temp_c", "double"), ("humidity_pct", "double"), ("wind_speed_ms", "double"),
            ("uv_index", "double")]],
        "corridor", "avg_congestion", "congestion_level")
    u = st.unionByName(tr)
    is_s, is_t = F.col("kind") == "s", F.col("kind") == "t"
    cur, name = F.col("current_aqi"), F.col("station")
    rated = is_s & cur.isNotNull()
    cong = F.col("avg_congestion")
    g = u.agg(
        F.count(F.when(is_s, 1)).alias("station_count"),
        F.count(F.when(is_t, 1)).alias("corridor_count"),
        F.coalesce(F.sum(F.when(is_s, F.coalesce(F.col("reading_count"), F.lit(0)))), F.lit(0))
         .cast("long").alias("total_aqi_readings"),
        exact_avg(F.when(rated, cur)).alias("_avg"),
        F.min_by(F.struct(name.alias("s"), cur.alias("a")),
                 F.when(rated, F.struct((-cur).alias("v"), name.alias("n")))).alias("_w"),
        F.min_by(F.struct(name.alias("s"), cur.alias("a")),
                 F.when(rated, F.struct(cur.alias("v"), name.alias("n")))).alias("_b"),
        F.min_by(F.struct(F.col("corridor").alias("c"), cong.alias("v"),
                          F.col("congestion_level").alias("l")),
                 F.when(is_t & cong.isNotNull(),
                        F.struct((-cong).alias("v"), F.col("corridor").alias("n")))).alias("_t"),
        *[exact_avg(F.when(is_s, F.col(f))).alias(f"_{f}")
          for f in ["temp_c", "humidity_pct", "wind_speed_ms"]],
        F.max(F.when(is_s, F.col("uv_index"))).alias("_uv"))
    avg = round_half_even("_avg", 1)
    return g.select(
        "station_count", "corridor_count", "total_aqi_readings",
        avg.alias("city_avg_aqi"),
        aqi_category(avg, K.AQI_UNKNOWN_LABEL).alias("city_avg_category"),
        F.col("_w.s").alias("worst_station"), round_half_even("_w.a", 1).alias("worst_aqi"),
        aqi_category(F.col("_w.a"), K.AQI_UNKNOWN_LABEL).alias("worst_category"),
        F.col("_b.s").alias("best_station"), round_half_even("_b.a", 1).alias("best_aqi"),
        aqi_category(F.col("_b.a"), K.AQI_UNKNOWN_LABEL).alias("best_category"),
        F.col("_t.c").alias("worst_corridor"),
        round_half_even("_t.v", 2).alias("worst_corridor_congestion"),
        F.col("_t.l").alias("worst_corridor_level"),
        round_half_even("_temp_c", 1).alias("avg_temp_c"),
        round_half_even("_humidity_pct", 1).alias("avg_humidity_pct"),
        round_half_even("_wind_speed_ms", 1).alias("avg_wind_speed_ms"),
        round_half_even("_uv", 1).alias("max_uv_index"))
