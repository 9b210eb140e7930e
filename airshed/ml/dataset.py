"""Training set: hourly AQ x weather rows -> horizon samples -> deterministic split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.functions import constants as K
from airshed.operators.joins import horizon_samples, hourly_training_rows


BUCKETS = 100
SAMPLE_KEY = ("station", "time", "horizon_h")
TARGET_KEY = ("station", "target_time")


def training_samples(aq_hourly: DataFrame, wx_hourly: DataFrame) -> DataFrame:
    """ML1 + ML2: samples (9 current features, horizon, target hour/weekday) -> aqi_target."""
    return horizon_samples(hourly_training_rows(aq_hourly, wx_hourly))


def check_size(samples: DataFrame, minimum: int = K.MIN_TRAINING_ROWS) -> int:
    """ML3: refuse to train on too few samples (or none)."""
    return checked(samples.count(), minimum)


def checked(n: int, minimum: int = K.MIN_TRAINING_ROWS) -> int:
    if n == 0:
        raise ValueError("The training set is empty.")
    if n < minimum:
        raise ValueError(f"The training set has {n} samples; a forecast needs {minimum} at least.")
    return n


def split(samples: DataFrame, test_fraction: float = K.TEST_FRACTION,
          keys=SAMPLE_KEY) -> tuple[DataFrame, DataFrame]:
    """ML4: hash split on the sample key - the same rows land in the same side whatever
    the partitioning or task retries (``randomSplit`` depends on partition layout). With
    ``keys=TARGET_KEY`` all samples that forecast the same station and hour land in one side."""
    test = is_test(samples, test_fraction, keys)
    return samples.filter(~test), samples.filter(test)


def is_test(samples: DataFrame, test_fraction: float = K.TEST_FRACTION, keys=SAMPLE_KEY) -> Column:
    """Whether a sample is held out: by the md5 of its key as text, which any engine can repeat. Times are
    written as seconds since 1970."""
    hour = F.unix_seconds(F.col("time").cast("timestamp"))
    target = hour + F.col("horizon_h").cast("long") * 3600
    text = {"time": hour, "target_time": target}
    key = F.concat_ws("|", *[text.get(k, F.col(k) if k in samples.columns else F.lit(None)).cast("string")
                             for k in keys])
    bucket = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % BUCKETS
    return bucket >= int(round(BUCKETS * (1 - test_fraction)))
