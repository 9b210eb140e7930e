"""Joins: combined view (JN2), UV enrichment (JN7), source fallback (JN8), hourly training
join (JN4), horizon self-join (JN5) and the now-vs-future pairing (JN9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.functions import constants as K
from airshed.functions.timeparts import parse_ts
from airshed.operators.asof import asof_left_join
from airshed.operators.dedup import first_in_order

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def combined(weather_silver: DataFrame, aqi_silver: DataFrame, run_ts: str,
             bucket: str = "minute") -> DataFrame:
    """JN2, re-aimed: each weather reading + the AQI reading of its station in force at that
    time (the latest at or before it).

    The upstream view joined on the station alone, pairing every weather row with every AQI
    row of the station (n_w * n_a rows per station).  Pairing each reading with the one
    in force keeps the view linear in its inputs.
    """
    aqi_cols = [c for c in K.COMBINED_AQI_COLS if c in aqi_silver.columns]
    left = weather_silver.withColumn("_lts", parse_ts(F.col("timestamp")))
    right = aqi_silver.select("station", parse_ts(F.col("timestamp")).alias("_rts"), *aqi_cols)
    out = asof_left_join(left, right, ["station"], "_lts", "_rts", aqi_cols, bucket)
    return out.drop("_lts").withColumn("processed_at", F.lit(run_ts))


def uv_enrich(weather_silver: DataFrame, uv_readings: DataFrame, bucket: str = "minute") -> DataFrame:
    """JN7: attach the UV reading in force at each weather reading (NULL when none yet)."""
    left = weather_silver.withColumn("_lts", parse_ts(F.col("timestamp")))
    right = uv_readings.select("station", parse_ts(F.col("timestamp")).alias("_rts"),
                               F.col("uv").try_cast("double").alias("uv"),
                               F.col("uv_max").try_cast("double").alias("uv_max"))
    return asof_left_join(left, right, ["station"], "_lts", "_rts", ["uv", "uv_max"], bucket).drop("_lts")


def source_fallback(primary: DataFrame, secondary: DataFrame, keys=("station", "slot"),
                    cols=("aqi", "pm25", "source")) -> DataFrame:
    """JN8: per poll slot the primary record, else the secondary one.

    A primary record without an AQI counts as missing.  The whole record is taken from one
    source (never mixed).  Both inputs hold one row per key, so the full outer join is 1:1;
    if neither side yields a record the slot produces no row.
    """
    keys, cols = list(keys), list(cols)
    p = primary.select(*keys, F.struct(*cols).alias("_p"))
    s = secondary.select(*keys, F.struct(*cols).alias("_s"))
    j = p.join(s, on=keys, how="full_outer")
    rec = F.when(F.col("_p.aqi").isNotNull(), F.col("_p")).otherwise(F.col("_s"))
    return (j.select(*keys, rec.alias("_r")).filter(F.col("_r").isNotNull())
             .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def hourly_training_rows(aq: DataFrame, wx: DataFrame, tz: str = K.TRAINING_TZ) -> DataFrame:
    """JN4 + ML1: AQ hourly inner-join weather hourly on (station, time), local hour and
    weekday (Monday=0), rows with any NULL current column or AQI dropped.

    Repeated hours of either feed count once (DDP2): the smallest row is kept, so a re-run
    gives the same one. The join reuses the partitioning of that aggregate.
    """
    keys = ["station", "time"]
    aq, wx = (first_in_order(x, keys, [c for c in x.columns if c not in keys]) for x in (aq, wx))
    j = aq.join(wx, on=keys, how="inner")
    local = F.from_utc_timestamp(F.col("time"), tz)
    j = j.withColumns({"hour": F.hour(local).cast("long"),
                       "dayofweek": F.weekday(local).cast("long")})
    return j.dropna(subset=K.CURRENT_COLS + ["aqi"])


def horizon_samples(rows: DataFrame, horizons=K.HORIZONS, tz: str = K.TRAINING_TZ) -> DataFrame:
    """JN5 / ML2: pair the observation at t with the AQI at t + h for every horizon h.

    Exact-time pairing (a gap in the series simply yields no pair), computed without a
    self-join: every hourly row goes to the window of its own UTC day and, as a target only (its
    features left out), to those of the days from which a horizon can reach it. A window holds
    the hours of those days, so it is bounded, and no station is a hot key. The pairs are made
    from it after the shuffle, which carries two rows an hour for horizons of up to 24.
    """
    hs = sorted(set(int(h) for h in horizons))
    days = max(hs, default=0) // 24 + (1 if max(hs, default=0) % 24 else 0)
    at = F.unix_micros("time")
    x = (rows.select("station", "time", "aqi", *K.CURRENT_COLS, at.alias("_at"))
             .withColumn("_ago", F.explode(F.array(*[F.lit(d) for d in range(days + 1)])))
             .withColumn("_day", F.floor(F.col("_at") / DAY_US) - F.col("_ago")))
    own = F.col("_ago") == 0
    x = x.select("station", "_day", "_ago", "_at", "aqi",
                 *[F.when(own, F.col(c)).alias(c) for c in ["time", *K.CURRENT_COLS]])
    near = Window.partitionBy("station", "_day")
    x = x.withColumn("_near", F.collect_list(F.struct("_at", "aqi")).over(near)).filter(own)
    ahead = F.filter("_near", lambda s: ((s["_at"] - F.col("_at")) / HOUR_US).isin([float(h) for h in hs])
                     & s["aqi"].isNotNull())
    x = (x.withColumn("_to", F.explode(ahead))
          .select("station", "time", *K.CURRENT_COLS, F.col("_to.aqi").alias("aqi_target"),
                  F.timestamp_micros("_to._at").alias("target_time"),
                  ((F.col("_to._at") - F.col("_at")) / HOUR_US).cast("int").alias("horizon_h")))
    local = F.from_utc_timestamp(F.col("target_time"), tz)
    return x.select("station", "time", *K.CURRENT_COLS, "aqi_target",
                    F.col("horizon_h").cast("long").alias("horizon_h"),
                    F.hour(local).cast("long").alias("target_hour"),
                    F.weekday(local).cast("long").alias("target_dayofweek"))


def now_vs_future(forecast: DataFrame, horizon: int = K.TREND_HORIZON) -> DataFrame:
    """JN9: per station the h=0 and h=H predictions side by side (conditional aggregation)."""
    h = F.col("horizon_h")
    return forecast.groupBy("station").agg(
        F.max(F.when(h == 0, F.col("aqi_predicted"))).alias("nowcast_aqi"),
        F.max(F.when(h == horizon, F.col("aqi_predicted"))).alias("forecast_aqi"),
        F.max(F.when(h == horizon, F.col("category"))).alias("forecast_category"))
