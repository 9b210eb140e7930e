"""Composed batch jobs over paths (JOB1-JOB5, VW5).

Each job writes its silver table once and reads it back for the gold marts, so the marts
start from a written table instead of re-running the cleaning plan (the write is the
lineage cut; its folder is on shared storage). Gold and serving marts are snapshots
(``plans.snapshots``): a failed run leaves the former ones in place. Every job run is a line of the
lake's ledger.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.operators import clean, joins, marts, serving
from airshed.plans import snapshots
from airshed.plans.sinks import write_table
from airshed.sources.bronze import read_bronze, read_table

log = logging.getLogger("airshed.jobs")


@dataclass
class Lake:
    """Folder layout of one deployment."""
    bronze: str
    root: str
    bronze_layout: str = "partitioned"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver read back for the marts.  It is written partitioned by ``date``; partition
    discovery would type that column as DATE, so it is returned to its text form."""
    df = spark.read.parquet(path)
    return df.withColumn("date", F.col("date").cast("string")) if "date" in df.columns else df


@dataclass
class JobResult:
    job: str
    ok: bool
    rows: dict = field(default_factory=dict)
    message: str = ""


def run_aqi(spark: SparkSession, lake: Lake, run_ts: str) -> JobResult:
    """JOB1: bronze AQI -> silver -> gold stations + gold ML features."""
    raw = read_bronze(spark, lake.bronze, "aqi", layout=lake.bronze_layout)
    if raw is None:
        return JobResult("aqi", True, message="skipped: no AQI records")
    rows = {"silver_aqi": write_table(clean.clean_aqi(raw, run_ts), lake.path("silver", "aqi"),
                                      partition_by=["date"])}
    silver = read_silver(spark, lake.path("silver", "aqi"))
    rows["gold_stations"] = snapshots.publish(marts.station_gold(silver, run_ts), lake.path("gold", "stations"), run_ts)
    rows["gold_ml_features"] = snapshots.publish(marts.ml_features(silver), lake.path("gold", "ml_features"), run_ts)
    return JobResult("aqi", True, rows)


def run_weather(spark: SparkSession, lake: Lake, run_ts: str) -> JobResult:
    """JOB2: weather + wind dir -> silver -> gold latest weather; combined view when the AQI
    silver exists."""
    raw = read_bronze(spark, lake.bronze, "weather", layout=lake.bronze_layout)
    if raw is None:
        return JobResult("weather", True, message="skipped: no weather records")
    rows = {"silver_weather": write_table(clean.clean_weather(raw, run_ts),
                                          lake.path("silver", "weather"), partition_by=["date"])}
    silver = read_silver(spark, lake.path("silver", "weather"))
    rows["gold_weather"] = snapshots.publish(marts.weather_gold(silver, run_ts), lake.path("gold", "weather"), run_ts)
    aqi = read_table(spark, lake.path("silver", "aqi"))
    aqi = None if aqi is None else read_silver(spark, lake.path("silver", "aqi"))
    msg = ""
    if aqi is None:
        msg = "no combined view: there is no AQI silver yet"
    else:
        rows["silver_combined"] = snapshots.publish(joins.combined(silver, aqi, run_ts),
                                                    lake.path("silver", "combined"), run_ts)
    return JobResult("weather", True, rows, msg)


def run_traffic(spark: SparkSession, lake: Lake, run_ts: str) -> JobResult:
    """JOB3: traffic cleaned in flight (no silver write), gold corridors written."""
    raw = read_bronze(spark, lake.bronze, "traffic", layout=lake.bronze_layout)
    if raw is None:
        return JobResult("traffic", True, message="skipped: no traffic records")
    gold = marts.corridor_gold(clean.clean_traffic(raw, run_ts), run_ts)
    return JobResult("traffic", True, {"gold_traffic": snapshots.publish(
        gold, lake.path("gold", "traffic"), run_ts)})


def run_pipeline(spark: SparkSession, lake: Lake, run_ts: str) -> DataFrame:
    """JOB4: AQI -> weather -> traffic; each may fail alone; status ok / partial."""
    results = []
    for fn in (run_aqi, run_weather, run_traffic):
        started = snapshots.now()
        try:
            results.append(fn(spark, lake, run_ts))
        except Exception as e:  # noqa: BLE001 - one failed job must not stop the others
            log.error("%s failed: %s", fn.__name__, e)
            results.append(JobResult(fn.__name__.removeprefix("run_"), False, message=str(e)[:500]))
        r = results[-1]
        snapshots.record_run(spark, lake.root, run_ts, r.job, "ok" if r.ok else "failed", r.rows, r.message,
                             started)
    status = "ok" if all(r.ok for r in results) else "partial"
    return spark.createDataFrame(
        [(r.job, r.ok, {k: int(v) for k, v in r.rows.items()}, r.message, status, run_ts)
         for r in results],
        "job string, ok boolean, rows map<string,bigint>, message string, status string, "
        "run_ts string")


def refresh_marts(spark: SparkSession, lake: Lake, run_ts: str = "") -> dict:
    """JOB5: rebuild the serving marts from gold; returns station and corridor counts."""
    started = snapshots.now()
    stations, weather, traffic = (snapshots.read(spark, lake.path("gold", x))
                                  for x in ("stations", "weather", "traffic"))
    out = {"stations": 0, "corridors": 0}
    if stations is not None:
        if weather is None:
            weather = spark.createDataFrame([], marts_weather_schema())
        out["stations"] = snapshots.publish(serving.station_current(stations, weather),
                                            lake.path("serving", "station_current"), run_ts)
    if traffic is not None:
        out["corridors"] = snapshots.publish(serving.traffic_current(traffic),
                                             lake.path("serving", "traffic_current"), run_ts)
    snapshots.record_run(spark, lake.root, run_ts, "refresh", "ok", out, "", started)
    return out


def run_requests(spark: SparkSession, lake: Lake, requests: DataFrame, run_ts: str, model=None) -> JobResult:
    """ML10 + ML12: requests are checked in one pass and written by whether they are accepted; the
    accepted ones are scored (with a model) into a mart of forecasts."""
    from airshed.ml import scoring
    path, started = lake.path("serving", "requests"), snapshots.now()
    checked = scoring.request_rows(requests).withColumn("accepted", F.col("rejected").isNull())
    rows = {"requests": write_table(checked, path, partition_by=["accepted"])}
    checked = spark.read.schema(checked.schema).parquet(path)
    if model is not None:
        rows["forecasts"] = snapshots.publish(scoring.score_requests(model, checked.where("accepted")),
                                              lake.path("serving", "request_forecasts"), run_ts)
    snapshots.record_run(spark, lake.root, run_ts, "requests", "ok", rows, "", started)
    return JobResult("requests", True, rows)


def marts_weather_schema() -> str:
    from airshed.functions import constants as K
    fields = ", ".join(f"{f} {'string' if f.startswith('weather_') else 'double'}"
                       for f in K.WEATHER_FIELDS)
    return f"station string, lat double, lon double, {fields}, last_updated string, processed_at string"


MARTS = [("gold", "stations"), ("gold", "ml_features"), ("gold", "weather"), ("gold", "traffic"),
         ("serving", "station_current"), ("serving", "traffic_current")]


def freshness(spark: SparkSession, lake: Lake) -> DataFrame:
    """VW5: the current snapshot of every mart: mart, version, rows, run_ts, refreshed_at."""
    out = spark.createDataFrame([], "mart string, version long, rows long, run_ts string, refreshed_at string")
    for layer, name in MARTS:
        newest = F.max_by(F.struct("version", "rows", "run_ts", "finished_at"), F.struct("version", "finished_at"))
        line = (snapshots.manifest(spark, lake.path(layer, name)).agg(newest.alias("m")).where("m is not null"))
        out = out.unionByName(line.select(F.lit(f"{layer}/{name}").alias("mart"), "m.version", "m.rows", "m.run_ts",
                                          F.col("m.finished_at").alias("refreshed_at")))
    return out


def health(spark: SparkSession, lake: Lake) -> DataFrame:
    """VW5: one row: the last refresh of the serving marts and the last run of the pipeline's jobs, with the
    status of that run (ok, partial, failed); NULLs before the first."""
    lines = snapshots.ledger(spark, lake.root).groupBy("job").agg(F.max_by(
        F.struct("job", "run_ts", "status", "finished_at"), "finished_at").alias("l")).select("l.*")
    is_job = F.col("job").isin("aqi", "weather", "traffic")
    # the newest line of each job: a handful
    one = lines.agg(F.max(F.when(F.col("job") == "refresh", F.col("finished_at"))).alias("last_refresh"),
                    F.max(F.when(is_job, F.col("finished_at"))).alias("pipeline_last_run"),
                    F.max_by("run_ts", F.when(is_job, F.col("finished_at"))).alias("pipeline_run_ts"),
                    F.collect_list(F.when(is_job, F.struct("run_ts", "status"))).alias("_lines"))
    statuses = F.transform(F.filter("_lines", lambda x: x["run_ts"] == F.col("pipeline_run_ts")),
                           lambda x: x["status"] == "ok")
    return one.withColumn("pipeline_status", F.when(F.size(statuses) == 0, None)
                          .when(F.forall(statuses, lambda x: x), "ok")
                          .when(F.exists(statuses, lambda x: x), "partial").otherwise("failed")).drop("_lines")
