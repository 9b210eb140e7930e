"""Runs over the dates that new bronze touches (JOB1-JOB3, SRC1), equal to a run over everything.

Bronze comes from ``streaming.landing``, in numbered batches. A run takes the finished batches after its last
one, finds the event dates in them, and with an index of (date, batch) the other batches that hold rows of
these dates: only those are read again. Silver and the parts of the marts are replaced date by date; the
marts are merged from the parts of all dates, a few rows per date and entity. State below
``<lake>/state/<feed>``: ``dates/run=<last batch>/`` (the index) and ``runs/`` (the batches done), written
last: a run that fails is run again from the same batch, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions.timeparts import parse_ts
from airshed.operators import clean, marts
from airshed.plans import snapshots
from airshed.plans.jobs import JobResult, Lake
from airshed.sources import schemas
from airshed.streaming import compaction
from airshed.streaming.landing import finished_batches

DATES = "date string, batch long"
RUNS = "upto long, run_ts string"


@dataclass(frozen=True)
class Feed:
    name: str  # of the bronze folder
    clean: Callable
    parts: Callable
    gold: Callable
    mart: str


FEEDS = {f.name: f for f in (
    Feed("aqi", clean.clean_aqi, marts.station_parts, marts.station_gold_of, "stations"),
    Feed("traffic", clean.clean_traffic, marts.corridor_parts, marts.corridor_gold_of, "traffic"),
    Feed("weather", clean.clean_weather, marts.weather_parts, marts.weather_gold, "weather"))}


def _parquet(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    try:
        df = spark.read.schema(schema).parquet(path)
        return df.select(spark.createDataFrame([], schema).columns)  # without the folders' own column
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def bronze(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """The feed's records with their batch and event date (NULL for an unreadable time)."""
    if compaction.commits(spark, root).isEmpty():
        schema = T.StructType([*schemas.BY_DIR[feed].fields, T.StructField("dir", T.StringType()),
                               T.StructField("batch", T.LongType())])
        df = spark.read.schema(schema).json(f"{root}/bronze").where(F.col("dir") == feed)
    else:
        df = compaction.records(spark, root, feed, schemas.BY_DIR[feed]).drop("ingest_date").withColumn(
            "dir", F.lit(feed))
    return df.withColumn("_date", F.date_format(parse_ts(F.col("timestamp")), "yyyy-MM-dd"))


def _replace(df: DataFrame, path: str) -> None:
    """Replaces the dates that ``df`` has rows for."""
    (df.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(path))


def _dated(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumn("date", F.col("date").cast("string"))


def affected(spark: SparkSession, root: str, lake: Lake, feed: str) -> tuple[int, int, DataFrame]:
    """The last batch done, the last finished one, and the (date, batch) pairs of the batches between."""
    state = lake.path("state", feed)
    last = _parquet(spark, f"{state}/runs", RUNS).agg(F.max("upto")).first()[0]
    upto = finished_batches(spark, root).agg(F.max("batch")).first()[0]
    last, upto = -1 if last is None else last, -1 if upto is None else upto
    new = bronze(spark, root, feed).where((F.col("batch") > last) & (F.col("batch") <= upto))
    return last, upto, new.select(F.col("_date").alias("date"), "batch").distinct()


def records_of(spark: SparkSession, root: str, feed: str, index: DataFrame, dates: DataFrame) -> DataFrame:
    """All records of ``dates``, read from the batches that the index names for them."""
    needed = index.join(F.broadcast(dates), F.col("date").eqNullSafe(F.col("_d")), "left_semi")
    lo, hi = needed.agg(F.min("batch"), F.max("batch")).first()
    rows = bronze(spark, root, feed).where(F.col("batch").between(lo, hi))  # prunes folders
    batches = needed.select(F.col("batch").alias("_b")).distinct()
    return (rows.join(F.broadcast(batches), F.col("batch") == F.col("_b"), "left_semi")
            .join(F.broadcast(dates), F.col("_date").eqNullSafe(F.col("_d")), "left_semi")
            .drop("dir", "batch", "_date"))


def run_feed(spark: SparkSession, root: str, lake: Lake, feed: str, run_ts: str,
             digits: int | None = None) -> JobResult:
    """Brings the feed's silver and mart up to date with the finished batches below ``root``."""
    spec, state, started = FEEDS[feed], lake.path("state", feed), snapshots.now()
    last, upto, pairs = affected(spark, root, lake, feed)
    if upto <= last:
        return JobResult(feed, True, message="no new batch")
    pairs.write.mode("overwrite").parquet(f"{state}/dates/run={upto}")
    index = _parquet(spark, f"{state}/dates", DATES)
    # dates are bounded by the time that the data span, and are strings of ten characters
    dates = (_parquet(spark, f"{state}/dates/run={upto}", DATES).select(F.col("date").alias("_d")).distinct())
    rows = {"dates": dates.count()}
    if rows["dates"]:
        silver, parts = lake.path("silver", feed), lake.path("parts", spec.mart)
        _replace(spec.clean(records_of(spark, root, feed, index, dates), run_ts), silver)
        changed = _dated(spark, silver).join(F.broadcast(dates), F.col("date").eqNullSafe(F.col("_d")), "left_semi")
        _replace(spec.parts(changed), parts)
        every = _dated(spark, parts).drop("date")
        gold = (spec.gold(every, run_ts) if feed == "weather" else spec.gold(every, run_ts, digits))
        rows[f"gold_{spec.mart}"] = snapshots.publish(gold, lake.path("gold", spec.mart), run_ts)
    (spark.createDataFrame([(upto, run_ts)], RUNS).coalesce(1).write.mode("append").parquet(f"{state}/runs"))
    snapshots.record_run(spark, lake.root, run_ts, feed, "ok", rows, "", started)
    return JobResult(feed, True, rows)
