"""Bronze -> silver cleaning (PRJ1-PRJ7, DDP1).

Step order matters and follows the upstream jobs: required-field ``dropna`` on the raw
values, then the range filter on the *converted* AQI (junk text and NaN drop out), then the
lenient casts, derived columns, and finally the dedup, so an invalid duplicate can never hide
a valid one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions import constants as K
from airshed.functions.classify import aqi_category, congestion_level
from airshed.functions.timeparts import parse_ts
from airshed.operators.dedup import keep_first


def lenient_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ5: convert to double; text that does not parse becomes NULL and the row stays."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in present})


def with_time_parts(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """PRJ6: ``date`` (yyyy-MM-dd text, as the JSON sinks carry it) and ``hour`` (UTC)."""
    ts = parse_ts(F.col(ts_col))
    return df.withColumns({"date": F.date_format(F.to_date(ts), "yyyy-MM-dd"),
                           "hour": F.hour(ts).cast("long")})


def stamp(df: DataFrame, run_ts: str) -> DataFrame:
    """PRJ7: constant run stamp, passed in so reruns are repeatable."""
    return df.withColumn("processed_at", F.lit(run_ts))


# The derived columns (band, date, hour, stamp) are functions of the dedup key and of the
# columns before them, so deriving them after the dedup picks the same survivor as the
# upstream order (derive, then dedup) while parsing fewer rows and shuffling narrower ones.

def clean_aqi(raw: DataFrame, run_ts: str) -> DataFrame:
    df = raw.dropna(subset=["station", "aqi", "timestamp"])
    df = df.filter(F.col("aqi").try_cast("double").between(K.AQI_MIN, K.AQI_MAX))
    df = keep_first(lenient_double(df, K.AQI_METRICS), ["station", "timestamp"])
    df = df.withColumn("aqi_category", aqi_category("aqi"))
    return stamp(with_time_parts(df), run_ts)


def clean_weather(raw: DataFrame, run_ts: str) -> DataFrame:
    """PRJ4 drops the wind records sharing the weather directory (no temperature)."""
    df = raw.filter(F.col("temp_c").isNotNull())
    df = df.dropna(subset=["station", "timestamp", "temp_c", "humidity_pct"])
    df = keep_first(lenient_double(df, K.WEATHER_CASTS), ["station", "timestamp"])
    return stamp(with_time_parts(df), run_ts)


def clean_traffic(raw: DataFrame, run_ts: str) -> DataFrame:
    df = raw.dropna(subset=["corridor", "timestamp", "congestion_ratio"])
    df = lenient_double(df, K.TRAFFIC_CASTS)
    df = df.filter(F.col("congestion_ratio").between(K.RATIO_MIN, K.RATIO_MAX))
    df = keep_first(df, ["corridor", "timestamp"])
    df = df.withColumn("congestion_level", congestion_level("congestion_ratio"))
    return stamp(with_time_parts(df), run_ts)


def map_ready(df: DataFrame) -> DataFrame:
    """PRJ12: only entities that can be placed on a map."""
    return df.dropna(subset=["lat", "lon"])


def point_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """PRJ11: rows of one entity; an empty result means "not found"."""
    return df.filter(F.col(key) == F.lit(value))
