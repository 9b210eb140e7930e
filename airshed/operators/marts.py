"""Silver -> gold marts (AGG1, AGG2, WIN1, WIN2, JN1, PRJ8, PRJ9).

The station mart needs a per-(station, lat, lon) aggregate *and* each station's latest
reading.  Instead of aggregate + window + join (two shuffles of silver), one aggregate
carries the latest reading of each coordinate group, and a window over the tiny aggregate
picks the station-wide latest: one shuffle of silver in total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions import constants as K
from airshed.functions.classify import congestion_level
from airshed.functions.numeric import average_of, average_state, exact_avg, merged_state, round_half_even
from airshed.functions.timeparts import parse_ts

LATEST_AQI_COLS = ["aqi", "aqi_category", "pm25", "pm10", "no2", "o3", "so2", "co"]


def _avg(c: str, digits: int | None):
    a = exact_avg(c)
    return a if digits is None else round_half_even(a, digits)


def station_gold(silver: DataFrame, run_ts: str, digits: int | None = None) -> DataFrame:
    """Gold stations: window aggregates per (station, lat, lon) + the station's latest."""
    aggs = [
        _avg("aqi", digits).alias("avg_aqi"),
        F.min("aqi").alias("min_aqi"),
        F.max("aqi").alias("max_aqi"),
        *[_avg(p, digits).alias(f"avg_{p}") for p in ["pm25", "pm10", "no2", "o3", "so2", "co"]],
        F.count(F.lit(1)).alias("reading_count"),
        F.max("timestamp").alias("last_updated"),
        F.max_by(F.struct(*LATEST_AQI_COLS), F.col("timestamp")).alias("_glatest"),
    ]
    g = silver.groupBy("station", "lat", "lon").agg(*aggs)
    # JN1 without a join: the latest of the station is the latest of its groups.
    g = g.withColumn("_latest", F.max_by("_glatest", "last_updated")
                     .over(Window.partitionBy("station")))
    latest = [F.col(f"_latest.{c}").alias("latest_category" if c == "aqi_category" else f"latest_{c}")
              for c in LATEST_AQI_COLS]
    return g.select(
        "station", "lat", "lon", "avg_aqi", "min_aqi", "max_aqi", "avg_pm25", "avg_pm10",
        "avg_no2", "avg_o3", "avg_so2", "avg_co", "reading_count", "last_updated",
        F.lit(run_ts).alias("processed_at"), *latest)


# ---------------------------------------------------------------- marts from parts (one per date)
# The parts of a date are a partial aggregate of its silver rows. A mart is the merge of all parts, so a
# run over some dates rewrites their parts only and reads no other silver rows.
STATION_METRICS = ["aqi", "pm25", "pm10", "no2", "o3", "so2", "co"]


def station_parts(silver: DataFrame) -> DataFrame:
    """Per date, station, lat and lon: what ``station_gold`` needs of these rows."""
    return silver.groupBy("date", "station", "lat", "lon").agg(
        *[average_state(c).alias(f"avg_{c}") for c in STATION_METRICS],
        F.min("aqi").alias("min_aqi"), F.max("aqi").alias("max_aqi"), F.count(F.lit(1)).alias("reading_count"),
        F.max("timestamp").alias("last_updated"),
        F.max_by(F.struct(*LATEST_AQI_COLS), F.col("timestamp")).alias("latest"))


def station_gold_of(parts: DataFrame, run_ts: str, digits: int | None = None) -> DataFrame:
    """``station_gold`` of the rows that the parts stand for."""
    g = parts.groupBy("station", "lat", "lon").agg(
        *[merged_state(f"avg_{c}").alias(f"avg_{c}") for c in STATION_METRICS],
        F.min("min_aqi").alias("min_aqi"), F.max("max_aqi").alias("max_aqi"),
        F.sum("reading_count").alias("reading_count"), F.max_by("latest", "last_updated").alias("_glatest"),
        F.max("last_updated").alias("last_updated"))
    g = g.withColumn("_latest", F.max_by("_glatest", "last_updated").over(Window.partitionBy("station")))
    avg = lambda c: average_of(F.col(f"avg_{c}"))
    avg = avg if digits is None else (lambda c, f=avg: round_half_even(f(c), digits))
    latest = [F.col(f"_latest.{c}").alias("latest_category" if c == "aqi_category" else f"latest_{c}")
              for c in LATEST_AQI_COLS]
    return g.select("station", "lat", "lon", avg("aqi").alias("avg_aqi"), "min_aqi", "max_aqi",
                    *[avg(c).alias(f"avg_{c}") for c in STATION_METRICS[1:]], "reading_count", "last_updated",
                    F.lit(run_ts).alias("processed_at"), *latest)


def corridor_parts(silver: DataFrame) -> DataFrame:
    """Per date, corridor, lat and lon: what ``corridor_gold`` needs of these rows."""
    return silver.groupBy("date", "corridor", "lat", "lon").agg(
        average_state("current_speed_kmh").alias("speed"), F.min("current_speed_kmh").alias("min_speed_kmh"),
        average_state("congestion_ratio").alias("congestion"), F.max("congestion_ratio").alias("max_congestion"),
        F.count(F.lit(1)).alias("reading_count"), F.max("timestamp").alias("last_updated"))


def corridor_gold_of(parts: DataFrame, run_ts: str, digits: int | None = None) -> DataFrame:
    """``corridor_gold`` of the rows that the parts stand for."""
    g = parts.groupBy("corridor", "lat", "lon").agg(
        merged_state("speed").alias("speed"), F.min("min_speed_kmh").alias("min_speed_kmh"),
        merged_state("congestion").alias("congestion"), F.max("max_congestion").alias("max_congestion"),
        F.sum("reading_count").alias("reading_count"), F.max("last_updated").alias("last_updated"))
    g = g.withColumns({"avg_speed_kmh": average_of(F.col("speed")), "avg_congestion": average_of(F.col("congestion"))})
    g = g.withColumn("congestion_level", congestion_level("avg_congestion"))
    if digits is not None:
        g = g.withColumns({c: round_half_even(c, digits) for c in ["avg_speed_kmh", "avg_congestion"]})
    return g.select("corridor", "lat", "lon", "avg_speed_kmh", "min_speed_kmh", "avg_congestion", "max_congestion",
                    "reading_count", "last_updated", "congestion_level", F.lit(run_ts).alias("processed_at"))


def weather_parts(silver: DataFrame) -> DataFrame:
    """Per date and station: the latest reading."""
    return silver.groupBy("date", "station").agg(F.max_by(
        F.struct("lat", "lon", *K.WEATHER_FIELDS, "timestamp"), F.col("timestamp")).alias("w")).select(
        "date", "station", "w.*")


def ml_features(silver: DataFrame) -> DataFrame:
    """Gold ML features: per-reading rows with UTC hour/date and Spark weekday (Sunday=1)."""
    return silver.select(
        "station", "timestamp", "lat", "lon", "aqi", "pm25", "pm10", "no2", "o3", "so2", "co",
        "hour", "date",
        F.dayofweek(parse_ts(F.col("timestamp"))).cast("long").alias("dayofweek"))


def corridor_gold(silver: DataFrame, run_ts: str, digits: int | None = None) -> DataFrame:
    """Gold traffic: per (corridor, lat, lon); the band is re-derived from the average."""
    g = silver.groupBy("corridor", "lat", "lon").agg(
        exact_avg("current_speed_kmh").alias("avg_speed_kmh"),
        F.min("current_speed_kmh").alias("min_speed_kmh"),
        exact_avg("congestion_ratio").alias("avg_congestion"),
        F.max("congestion_ratio").alias("max_congestion"),
        F.count(F.lit(1)).alias("reading_count"),
        F.max("timestamp").alias("last_updated"))
    g = g.withColumn("congestion_level", congestion_level("avg_congestion"))
    if digits is not None:
        g = g.withColumns({c: round_half_even(c, digits) for c in ["avg_speed_kmh", "avg_congestion"]})
    return g.select("corridor", "lat", "lon", "avg_speed_kmh", "min_speed_kmh", "avg_congestion",
                    "max_congestion", "reading_count", "last_updated", "congestion_level",
                    F.lit(run_ts).alias("processed_at"))


def weather_gold(silver: DataFrame, run_ts: str) -> DataFrame:
    """WIN2: latest weather reading per station with its coordinates and 11 fields."""
    fields = [c for c in K.WEATHER_FIELDS if c in silver.columns]
    g = (silver.groupBy("station")
               .agg(F.max_by(F.struct("lat", "lon", *fields, "timestamp"), F.col("timestamp"))
                    .alias("_w")))
    return g.select("station", "_w.lat", "_w.lon", *[f"_w.{c}" for c in fields],
                    F.col("_w.timestamp").alias("last_updated"),
                    F.lit(run_ts).alias("processed_at"))


def band_counts(silver: DataFrame, band_col: str, key_name: str = "band") -> DataFrame:
    """Readings per band (distribution check of a classifier)."""
    return (silver.groupBy(F.col(band_col).alias(key_name))
                  .agg(F.count(F.lit(1)).alias("readings")))
