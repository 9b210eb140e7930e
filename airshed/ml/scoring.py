"""Batch scoring (ML9-ML14): every station x horizon in one distributed transform."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.functions import constants as K
from airshed.functions.classify import aqi_category
from airshed.functions.numeric import clamp_prediction
from airshed.functions.timeparts import target_parts
from airshed.ml.forest import Forest
from airshed.operators.dedup import horizon_list
from airshed.operators.joins import now_vs_future
from airshed.plans import views


def request_rows(requests: DataFrame) -> DataFrame:
    """ML10 + DDP4: request rows with the defaults filled in (also for columns that are missing), their
    horizons (no list: all; else distinct, sorted, without negative ones) and ``rejected``, the fields
    outside their bounds, comma-joined (NULL for an accepted request)."""
    def filled(c: str, v) -> Column:
        kind = "int" if isinstance(v, int) else "double"
        return F.coalesce(F.col(c).cast(kind), F.lit(v)) if c in requests.columns else F.lit(v)

    values = {c: filled(c, v) for c, v in K.REQUEST_DEFAULTS.items()}
    every = F.array(*[F.lit(int(h)) for h in K.HORIZONS])
    own = horizon_list(F.col("horizons").cast("array<int>")) if "horizons" in requests.columns else F.lit(None)
    out = requests.withColumns({**values, "horizons": F.coalesce(own, every)})
    outside = F.concat_ws(",", *[F.when(~F.col(c).between(lo, hi), F.lit(c))
                                 for c, (lo, hi) in K.REQUEST_BOUNDS.items()])
    return out.withColumn("rejected", F.when(outside != "", outside))


def request_features(rows: DataFrame, keys=("request_id", "station")) -> DataFrame:
    """ML12 + FN14: a feature row for each accepted request and horizon; the target hour and weekday
    follow from the request's own."""
    base = rows.where("rejected is null").select(*keys, *K.REQUEST_DEFAULTS,
                                                 F.explode("horizons").alias("horizon_h"))
    hour, day = target_parts("hour", "dayofweek", "horizon_h")
    return base.withColumns({"target_hour": hour.cast("int"), "target_dayofweek": day.cast("int")})


def request_rejects(rows: DataFrame, keys=("request_id", "station")) -> DataFrame:
    """The requests that are not scored, with the fields outside their bounds."""
    return rows.where("rejected is not null").select(*keys, *K.REQUEST_BOUNDS, "rejected")


def score_requests(model: Forest, rows: DataFrame, keys=("request_id", "station")) -> DataFrame:
    """ML11 + ML12 over requests: key columns, horizon_h, aqi_predicted, category."""
    return predict(model, request_features(rows, keys)).select(*keys, "horizon_h", "aqi_predicted",
                                                               "category")


def predict(model: Forest, features: DataFrame) -> DataFrame:
    """ML12: transform -> clamp/round (FN16) -> band (FN1)."""
    x = features.withColumns({c: F.col(c).cast("double") for c in K.FEATURE_ORDER})
    out = model.transform(x)
    p = clamp_prediction(F.col("prediction"))
    return (out.withColumn("aqi_predicted", p)
               .withColumn("category", aqi_category("aqi_predicted"))
               .drop("features", "prediction"))


def forecast(model: Forest, current: DataFrame, now_utc: str,
             horizons=K.HORIZONS) -> DataFrame:
    """ML12 over the current snapshot: (station, horizon_h, aqi_predicted, category)."""
    feats = views.scoring_features(current, now_utc, horizons)
    return predict(model, feats).select("station", F.col("horizon_h").cast("long").alias("horizon_h"),
                                        "aqi_predicted", "category")


def nowcast(model: Forest, current: DataFrame, now_utc: str) -> DataFrame:
    """ML11: horizon 0 for every station."""
    return forecast(model, current, now_utc, [0]).drop("horizon_h")


def curve(model: Forest, current: DataFrame, now_utc: str) -> DataFrame:
    """ML13: 0-24 h curve with local valid time, ordered by station and horizon."""
    f = forecast(model, current, now_utc)
    return views.with_valid_time(f, now_utc).orderBy("station", "horizon_h")


def peak(curve_df: DataFrame) -> DataFrame:
    """AGG8: highest predicted AQI per station; a tie goes to the smallest horizon."""
    pick = F.max_by(F.struct("horizon_h", "aqi_predicted", "category", "valid_time"),
                    F.struct(F.col("aqi_predicted"), (-F.col("horizon_h")).alias("h")))
    return curve_df.groupBy("station").agg(pick.alias("p")).select(
        "station", F.col("p.horizon_h").alias("peak_horizon_h"),
        F.col("p.aqi_predicted").alias("peak_aqi"), F.col("p.category").alias("peak_category"),
        F.col("p.valid_time").alias("peak_valid_time"))


def trend(model: Forest, current: DataFrame, now_utc: str,
          horizon: int = K.TREND_HORIZON) -> DataFrame:
    """ML14: nowcast vs +H per station with delta and label (JN9 + JN6)."""
    f = forecast(model, current, now_utc, [0, horizon])
    return views.trend_table(now_vs_future(f, horizon), current)


def downsample(curve_df: DataFrame, every: int = 3) -> DataFrame:
    """SRT4: every n-th hour of the curve."""
    return curve_df.filter(F.col("horizon_h") % every == 0)
