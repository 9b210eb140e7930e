"""SRC5: station and corridor dimensions (fixed, 10 rows each -> safe to broadcast)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions import constants as K


def stations(spark: SparkSession) -> DataFrame:
    rows = [(n, lat, lon) for n, (lat, lon) in K.STATIONS.items()]
    return F.broadcast(spark.createDataFrame(rows, "station string, lat double, lon double"))


def corridors(spark: SparkSession) -> DataFrame:
    rows = [(n, lat, lon) for n, (lat, lon) in K.CORRIDORS.items()]
    return F.broadcast(spark.createDataFrame(rows, "corridor string, lat double, lon double"))
