"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They compose the same operators the jobs use, over the driver-table adapters, with a fixed
run stamp and averages rounded to ``DIGITS`` so the oracle can compare values exactly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions.classify import aqi_category
from airshed.functions.numeric import clamp_prediction
from airshed.functions.text import padded_id
from airshed.functions.timeparts import iso_utc
from airshed.ml import scoring
from airshed.operators import clean, joins, marts, normalize, payload, serving
from airshed.operators.dedup import latest_by
from airshed.plans import views
from airshed.sources import adapters as A
from airshed.sources.tables import table

RUN_TS = "2024-02-01T00:00:00+00:00"
DIGITS = 4
ONE_STATION = "st-0007"


# ------------------------------------------------------------------ silver / gold building blocks
def aqi_silver(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_aqi(A.aqi_raw(spark, sf), RUN_TS)


def silver_dirty_casts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_aqi(A.aqi_dirty(spark, sf), RUN_TS)


def gold_stations(spark: SparkSession, sf: str) -> DataFrame:
    return marts.station_gold(aqi_silver(spark, sf), RUN_TS, DIGITS)


def aqi_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest_by(aqi_silver(spark, sf), ["station"], ["timestamp"],
                     ["timestamp", "aqi", "aqi_category"])


def ml_features(spark: SparkSession, sf: str) -> DataFrame:
    return marts.ml_features(aqi_silver(spark, sf))


def traffic_silver(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_traffic(A.traffic_raw(spark, sf), RUN_TS)


def gold_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return marts.corridor_gold(traffic_silver(spark, sf), RUN_TS, DIGITS)


def traffic_bands(spark: SparkSession, sf: str) -> DataFrame:
    return marts.band_counts(traffic_silver(spark, sf), "congestion_level", "congestion_level")


def weather_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """SET1: weather and wind records read as one table."""
    return A.weather_raw(spark, sf).unionByName(A.wind_raw(spark, sf), allowMissingColumns=True)


def weather_wind_union(spark: SparkSession, sf: str) -> DataFrame:
    return weather_bronze(spark, sf).select("station", "timestamp", "source", "temp_c",
                                            "wind_speed_ms", "wind_deg")


def weather_silver(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_weather(weather_bronze(spark, sf), RUN_TS)


def gold_weather(spark: SparkSession, sf: str) -> DataFrame:
    return marts.weather_gold(weather_silver(spark, sf), RUN_TS)


def station_current(spark: SparkSession, sf: str) -> DataFrame:
    return serving.station_current(gold_stations(spark, sf), gold_weather(spark, sf))


def overview(spark: SparkSession, sf: str) -> DataFrame:
    return serving.overview(station_current(spark, sf), gold_traffic(spark, sf))


def worst_best_station(spark: SparkSession, sf: str) -> DataFrame:
    return serving.worst_best_station(station_current(spark, sf))


def worst_corridor(spark: SparkSession, sf: str) -> DataFrame:
    return serving.worst_corridor(gold_traffic(spark, sf))


def city_weather(spark: SparkSession, sf: str) -> DataFrame:
    return serving.city_weather(station_current(spark, sf))


# ------------------------------------------------------------------ joins
def combined(spark: SparkSession, sf: str) -> DataFrame:
    return joins.combined(weather_silver(spark, sf), aqi_silver(spark, sf), RUN_TS)


def uv_enrich(spark: SparkSession, sf: str) -> DataFrame:
    out = joins.uv_enrich(weather_silver(spark, sf), A.uv_raw(spark, sf))
    return out.select("station", "timestamp", "uv_index", "uv", "uv_max")


def source_fallback(spark: SparkSession, sf: str) -> DataFrame:
    primary, secondary = A.aqi_feeds(spark, sf)
    return joins.source_fallback(primary, secondary)


def _training_rows(spark: SparkSession, sf: str) -> DataFrame:
    return joins.hourly_training_rows(A.aq_hourly(spark, sf), A.wx_hourly(spark, sf))


def aq_weather_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return _training_rows(spark, sf).withColumn("time", iso_utc("time"))


def horizon_samples(spark: SparkSession, sf: str) -> DataFrame:
    return joins.horizon_samples(_training_rows(spark, sf)).withColumn("time", iso_utc("time"))


# ------------------------------------------------------------------ normalisers
def sensor_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.sensor_pivot(A.sensor_long(spark, sf))


def props_json(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    k = F.from_json(F.col("props"), "k INT").getField("k")
    rec = ev.select("event_id", padded_id("st-", F.col("user_id"), 4).alias("station"),
                    k.alias("k"))
    return rec.select("event_id", F.col("k").cast("long").alias("k"),
                      F.to_json(F.struct("station", "k")).alias("payload"))


def hourly_arrays_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly series packed as a day's parallel arrays (the forecast payload shape), then
    normalised back to rows: JSN7 zip + first 24, JSN8 inline.  A day holds at most 24 hourly
    entries, so each packed group is bounded."""
    aq = A.aq_hourly(spark, sf).withColumn("day", F.date_format("time", "yyyy-MM-dd"))
    packed = (aq.groupBy("station", "day")
                .agg(F.array_sort(F.collect_list(F.struct("time", "pm25", "aqi"))).alias("h"))
                .select("station", "day",
                        F.transform("h", lambda x: iso_utc(x["time"])).alias("time"),
                        F.transform("h", lambda x: x["pm25"]).alias("pm25"),
                        F.transform("h", lambda x: x["aqi"]).alias("aqi")))
    return normalize.explode_hourly(packed, ["station", "day"],
                                    {"time": F.col("time"), "pm25": F.col("pm25"),
                                     "aqi": F.col("aqi")}, limit=24)


# Payload round trips: feed records are rendered as the upstream API responses (JSON text)
# and normalised back with the payload normalisers.
def _meta(df):
    return F.col("station"), F.col("lat"), F.col("lon"), F.col("timestamp")


def aq_payload(spark: SparkSession, sf: str) -> DataFrame:
    """JSN2: the AQ 'current' response -> AQI record (no AQI -> no record)."""
    raw = A.aqi_raw(spark, sf)
    cur = F.struct(F.when(F.col("aqi") >= 0, F.col("aqi")).alias("us_aqi"),
                   F.col("pm25").alias("pm2_5"), F.col("pm10").alias("pm10"),
                   F.col("no2").alias("nitrogen_dioxide"), F.col("o3").alias("ozone"),
                   F.col("so2").alias("sulphur_dioxide"), F.col("co").alias("carbon_monoxide"))
    body = raw.select("station", "lat", "lon", "timestamp",
                      F.to_json(F.struct(cur.alias("current"))).alias("body"))
    return normalize.aq_current(body, *_meta(body))


def aq_fallback_payload(spark: SparkSession, sf: str) -> DataFrame:
    """JSN3: fallback response with a status gate and nested iaqi values."""
    raw = A.aqi_raw(spark, sf)
    iaqi = F.struct(*[F.struct(F.col(p).alias("v")).alias(p) for p in ["pm25", "pm10", "no2", "o3", "so2", "co"]])
    status = F.when(F.col("aqi") < 0, F.lit("error")).otherwise(F.lit("ok"))
    body = raw.select("station", "lat", "lon", "timestamp", F.to_json(F.struct(
        status.alias("status"),
        F.struct(F.col("aqi").cast("string").alias("aqi"), iaqi.alias("iaqi")).alias("data"))).alias("body"))
    return normalize.aq_fallback(body, *_meta(body))


def weather_payload(spark: SparkSession, sf: str) -> DataFrame:
    """JSN4: weather response flatten with defaults; a response without a wind block (calm,
    zero wind speed) is rejected."""
    raw = A.weather_raw(spark, sf)
    wind = F.when(F.col("wind_speed_ms") > 0.1, F.struct(
        F.col("wind_speed_ms").alias("speed"),
        F.when(F.col("wind_deg") > 0, F.col("wind_deg")).alias("deg"),
        F.col("wind_gust_ms").alias("gust")))
    body = raw.select("station", "lat", "lon", "timestamp", "uv_index", F.to_json(F.struct(
        F.struct(F.col("temp_c").alias("temp"), F.col("feels_like_c").alias("feels_like"),
                 F.col("humidity_pct").alias("humidity"), F.col("pressure_hpa").alias("pressure")).alias("main"),
        wind.alias("wind"), F.struct(F.col("clouds_pct").alias("all")).alias("clouds"),
        F.col("visibility_m").alias("visibility"),
        F.array(F.struct(F.col("weather_main").alias("main"),
                         F.col("weather_desc").alias("description"))).alias("weather"),
        F.when(F.col("rain_1h_mm") > 0, F.struct(F.col("rain_1h_mm").alias("1h"))).alias("rain"))).alias("body"))
    return normalize.weather_payload(body, *_meta(body), uv=F.col("uv_index"))


def traffic_payload(spark: SparkSession, sf: str) -> DataFrame:
    """JSN5: flow response with defaults (missing speed -> 0 when the line is returned)."""
    li = table(spark, sf, "lineitem")
    seg = F.struct(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("currentSpeed"),
                   F.lit(50.0).alias("freeFlowSpeed"), (F.lit(1.0) - F.col("l_discount")).alias("confidence"),
                   F.when(F.col("l_linestatus") == "F", F.lit(True)).alias("roadClosure"))
    body = li.select(padded_id("co-", F.col("l_suppkey"), 4).alias("corridor"),
                     F.lit(-6.2).alias("lat"), F.lit(106.8).alias("lon"),
                     iso_utc(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
                     F.to_json(F.struct(seg.alias("flowSegmentData"))).alias("body"))
    return normalize.traffic_payload(body, F.col("corridor"), F.col("lat"), F.col("lon"), F.col("timestamp"))


def uv_payload(spark: SparkSession, sf: str) -> DataFrame:
    """JSN6: UV response flatten incl. the nested safe exposure time."""
    raw = A.uv_raw(spark, sf)
    body = raw.select("station", "lat", "lon", "timestamp", F.to_json(F.struct(F.struct(
        F.col("uv").alias("uv"), F.col("uv_max").alias("uv_max"), F.col("uv_max_time").alias("uv_max_time"),
        F.col("ozone").alias("ozone"),
        F.struct(F.col("safe_exposure_min").alias("st2")).alias("safe_exposure_time")).alias("result"))).alias("body"))
    return normalize.uv_payload(body, *_meta(body))


# ------------------------------------------------------------------ views and functions
def stations_view(spark: SparkSession, sf: str) -> DataFrame:
    return views.stations(station_current(spark, sf))


def station_series(spark: SparkSession, sf: str) -> DataFrame:
    return views.station_series(ml_features(spark, sf))


def traffic_view(spark: SparkSession, sf: str) -> DataFrame:
    return views.traffic(gold_traffic(spark, sf))


def dashboard_stations(spark: SparkSession, sf: str) -> DataFrame:
    return views.dashboard_stations(station_current(spark, sf))


def dashboard_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return views.dashboard_traffic(gold_traffic(spark, sf))


def map_points(spark: SparkSession, sf: str) -> DataFrame:
    return views.map_points(station_current(spark, sf), gold_traffic(spark, sf))


def pretty_names(spark: SparkSession, sf: str) -> DataFrame:
    return map_points(spark, sf).select(F.col("id").alias("slug"), F.col("name").alias("pretty"))


def uv_bands(spark: SparkSession, sf: str) -> DataFrame:
    return views.uv_bands(A.uv_raw(spark, sf))


def wind_octant(spark: SparkSession, sf: str) -> DataFrame:
    return views.wind_octants(weather_silver(spark, sf))


def horizon_features(spark: SparkSession, sf: str) -> DataFrame:
    return views.scoring_features(station_current(spark, sf), RUN_TS)


def forecast_time_grid(spark: SparkSession, sf: str) -> DataFrame:
    return views.forecast_time_grid(station_current(spark, sf), RUN_TS)


# ------------------------------------------------------------------ responses of every form
def openaq_payload(spark: SparkSession, sf: str) -> DataFrame:
    """AGG9 over the sensor-list responses, folded in the row."""
    body = A.openaq_bodies(spark, sf)
    return normalize.openaq_payload(body, F.col("station"), F.col("location_id"), F.col("timestamp"))


def _openmeteo(spark: SparkSession, sf: str) -> DataFrame:
    body = A.openmeteo_bodies(spark, sf)
    return normalize.openmeteo_payload(body, *_meta(body))


def stored_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """JSN7: forecast records stored with their array of structs, and read back."""
    from airshed.plans.sinks import write_table
    from airshed.session import scratch_path

    path = scratch_path(spark, f"openmeteo-{uuid.uuid4().hex}")
    write_table(_openmeteo(spark, sf), path)
    return spark.read.parquet(path)


def openmeteo_payload(spark: SparkSession, sf: str) -> DataFrame:
    """JSN7 end to end: two subfields of every stored forecast hour, next to the current values."""
    stored = stored_forecasts(spark, sf)
    hours = F.arrays_zip(F.col("forecast_24h.time").alias("time"), F.col("forecast_24h.temp_c").alias("temp_c"))
    return stored.select("station", "timestamp", F.col("temp_c").alias("current_temp_c"), "cloud_cover_pct",
                         F.posexplode_outer(hours).alias("hour_no", "h")).select(
        "station", "timestamp", "current_temp_c", "cloud_cover_pct", F.col("hour_no").cast("long").alias("hour_no"),
        F.col("h.time").alias("time"), F.col("h.temp_c").alias("temp_c"))


def payload_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Responses by feed and kind of body, as VARIANT tells them apart."""
    return (A.dirty_bodies(spark, sf).groupBy("feed", payload.body_kind("body").alias("kind"))
            .agg(F.count("*").alias("bodies")))


def dirty_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """JSN2-JSN7, AGG9: which of the dirty responses give a record, and its main value."""
    raw = A.dirty_bodies(spark, sf)
    who, lat, lon, ts = F.col("event_id").cast("string"), F.lit(0.0), F.lit(0.0), F.lit("t")
    forms = {"aq": (normalize.aq_current, "station", "aqi"), "fallback": (normalize.aq_fallback, "station", "aqi"),
             "weather": (normalize.weather_payload, "station", "temp_c"),
             "traffic": (normalize.traffic_payload, "corridor", "current_speed_kmh"),
             "uv": (normalize.uv_payload, "station", "uv"),
             "openmeteo": (normalize.openmeteo_payload, "station", "temp_c")}
    out = normalize.openaq_payload(raw.where("feed = 'openaq'"), who, F.lit("1"), ts).select(
        F.lit("openaq").alias("feed"), F.col("station").alias("event_id"), F.col("pm25").alias("value"))
    for feed, (form, key, value) in forms.items():
        got = form(raw.where(F.col("feed") == feed), who, lat, lon, ts)
        out = out.unionByName(got.select(F.lit(feed).alias("feed"), F.col(key).alias("event_id"),
                                         F.col(value).cast("double").alias("value")))
    return out.withColumn("event_id", F.col("event_id").cast("long"))


# ------------------------------------------------------------------ jobs over written bronze
def _landed(spark: SparkSession, sf: str, parts: list) -> str:
    """Bronze of three feeds, landed as one batch for each condition of ``parts``; returns its root."""
    from airshed.session import scratch_path
    from airshed.streaming import landing

    root = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
    env = _envelopes(spark, sf, [t for t, *_ in STREAM_FEEDS if t not in ("aqi-raw", "weather-raw", "traffic-raw")])
    for i, part in enumerate(parts):
        landing.write_batch(env.where(part), i, root)
    return root


def job_rows(spark: SparkSession, sf: str) -> DataFrame:
    """JOB1-JOB5 over written bronze (SRC1, SRC2, SRC4, SNK1, SNK2): the rows that each run of the ledger
    wrote, by job and table."""
    from airshed.plans import jobs, snapshots

    root = _landed(spark, sf, [F.lit(True)])
    lake = jobs.Lake(bronze=f"{root}/bronze", root=f"{root}/lake")
    jobs.run_pipeline(spark, lake, RUN_TS)
    jobs.refresh_marts(spark, lake, RUN_TS)
    return snapshots.ledger(spark, lake.root).select("job", "status", F.explode("rows").alias("name", "rows"))


def bronze_audit(spark: SparkSession, sf: str) -> DataFrame:
    """SNK3: landed rows by folder, and whether there are files."""
    from airshed.plans import sinks

    root = _landed(spark, sf, [F.lit(True)])
    return sinks.bronze_audit(spark.read.text(f"{root}/bronze")).groupBy("dir").agg(
        F.sum("rows").alias("rows"), (F.min("files") > 0).alias("has_files"))


def incremental_stations(spark: SparkSession, sf: str) -> DataFrame:
    """JOB1 by affected dates: two batches that share dates, a run after each; the mart equals that of one
    run over everything."""
    return _incremental(spark, sf, "aqi", "stations")


def _incremental(spark: SparkSession, sf: str, feed: str, mart: str) -> DataFrame:
    from airshed.plans import incremental, jobs, snapshots
    from airshed.streaming import landing

    early = F.pmod(F.xxhash64("value"), F.lit(5)) > 0
    root = _landed(spark, sf, [early])
    lake = jobs.Lake(bronze="", root=f"{root}/lake")
    incremental.run_feed(spark, root, lake, feed, RUN_TS, DIGITS)
    env = _envelopes(spark, sf, [t for t, *_ in STREAM_FEEDS if t != f"{feed}-raw"])
    landing.write_batch(env.where(~early), 1, root)
    incremental.run_feed(spark, root, lake, feed, RUN_TS, DIGITS)
    return snapshots.read(spark, lake.path("gold", mart))


def station_detail(spark: SparkSession, sf: str) -> DataFrame:
    """VW1 / PRJ11: one station's record and series."""
    out = views.station_detail(station_current(spark, sf), ml_features(spark, sf), ONE_STATION)
    return out.select("station", "current_aqi", "aqi_category", "reading_count", "last_updated", "temp_c",
                      F.col("readings").cast("long").alias("readings"),
                      F.to_json(F.col("series.timestamp")).alias("times"))


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """ML4: samples in either side of the split, by sample and by target hour."""
    from airshed.ml import dataset
    samples = joins.horizon_samples(_training_rows(spark, sf))
    sides = [samples.select(F.lit(name).alias("key"), dataset.is_test(samples, keys=keys).alias("test"))
             for name, keys in (("sample", dataset.SAMPLE_KEY), ("target", dataset.TARGET_KEY))]
    return sides[0].unionByName(sides[1]).groupBy("key", "test").agg(F.count("*").alias("samples"))


# ------------------------------------------------------------------ requests
def request_features(spark: SparkSession, sf: str) -> DataFrame:
    """ML10 + ML12: feature rows of the accepted requests, with their own horizons."""
    return scoring.request_features(scoring.request_rows(A.forecast_requests(spark, sf)))


def request_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """ML10: requests with a field out of bounds."""
    return scoring.request_rejects(scoring.request_rows(A.forecast_requests(spark, sf)))


def request_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """ML12: the model's forecast for every accepted request and horizon."""
    return scoring.score_requests(trained(spark, sf).model, scoring.request_rows(A.forecast_requests(spark, sf)))


# ------------------------------------------------------------------ streaming landing
STREAM_FEEDS = [("aqi-raw", A.aqi_raw, "station"), ("weather-raw", A.weather_raw, "station"),
                ("wind-raw", A.wind_raw, "station"), ("uv-raw", A.uv_raw, "station"),
                ("traffic-raw", A.traffic_raw, "corridor"), ("openaq-raw", openaq_payload, "station"),
                ("openmeteo-raw", _openmeteo, "station")]


def _envelopes(spark: SparkSession, sf: str, without=()) -> DataFrame:
    """topic, value of every feed's records."""
    env = None
    for topic, fn, _key in STREAM_FEEDS:
        if topic in without:
            continue
        df = fn(spark, sf)
        e = df.select(F.lit(topic).alias("topic"), F.to_json(F.struct(*df.columns)).alias("value"))
        env = e if env is None else env.unionByName(e)
    return env


def landing_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """STR3 + SNK3: three feeds landed in four batches, compacted after three of them and again after the
    fourth, what is covered deleted. Rows, batches and stations by folder and feed, as a reader sees them."""
    from airshed.session import scratch_path
    from airshed.streaming import compaction, landing

    root = scratch_path(spark, f"compacted-{uuid.uuid4().hex}")
    env = _envelopes(spark, sf, [t for t, *_ in STREAM_FEEDS if t not in ("aqi-raw", "weather-raw", "uv-raw")])
    part = F.pmod(F.crc32(F.get_json_object("value", "$.station")), F.lit(4))
    for i in range(4):
        landing.write_batch(env.where(part == i), i, root)
        if i > 1:
            compaction.compact(spark, root, min_files=2)
            compaction.vacuum(spark, root)
    return compaction.read_landed(spark, root).groupBy("dir", "feed").agg(
        F.count("*").alias("rows"), F.countDistinct("batch").alias("batches"),
        F.countDistinct(F.get_json_object("value", "$.station")).alias("stations"))


def landing_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """STR1-STR7 + PRJ10: records and junk of six topics are published to a topic log, read from it by the
    admission-controlled source and landed in several sinks; wind records are derived from the weather
    ones. Rows, stations and corridors by sink, folder or reason, and feed."""
    from airshed.session import scratch_path
    from airshed.streaming import landing, topic_log

    base = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    ev = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    junk = ev.where(k < 4).select(
        F.when(k == 0, F.lit("alerts")).otherwise(F.lit("uv-raw")).alias("topic"),
        F.when(k == 0, F.col("props")).when(k == 1, F.lit('{"station": "cut')).when(k == 2, F.lit("[1, 2]"))
         .alias("value"))
    published = topic_log.publish(_envelopes(spark, sf, ("wind-raw",)).unionByName(junk), f"{base}/log")
    stream = topic_log.topic_source(spark, f"{base}/log", starting_offsets="earliest", min_records=1,
                                    topics=sorted(published))
    landing.start_landing(stream, base, f"{base}/checkpoint", available_now=True).awaitTermination()
    entity = F.coalesce(F.get_json_object("value", "$.station"), F.get_json_object("value", "$.corridor"))
    counts = [F.count("*").alias("rows"), F.countDistinct(entity).alias("entities")]
    landed = spark.read.text(f"{base}/bronze").groupBy(F.lit("bronze").alias("sink"), F.col("dir").alias("part"),
                                                       "feed").agg(*counts)
    rejected = landing.read_rejects(spark, base).groupBy(
        F.lit("rejects").alias("sink"), F.col("reason").alias("part"), F.col("topic").alias("feed")).agg(*counts)
    return landed.unionByName(rejected)


def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """STR1-STR7 end to end: every feed record is published as a ``{topic, value}`` envelope
    into a landing folder, the landing stream (availableNow) routes it to bronze, and the
    landed bronze is read back and parsed: rows and entities per bronze dir."""
    from airshed.session import scratch_path
    from airshed.streaming import ingest

    base = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    env = _envelopes(spark, sf)
    (env.write.mode("overwrite").option("compression", ingest.CODEC).option("maxRecordsPerFile", ingest.ROWS)
     .json(f"{base}/landing"))
    q = ingest.start_landing(ingest.file_source(spark, f"{base}/landing"), f"{base}/bronze",
                             f"{base}/_checkpoint", available_now=True)
    q.awaitTermination()
    landed = spark.read.text(f"{base}/bronze")
    entity = F.coalesce(F.get_json_object("value", "$.station"), F.get_json_object("value", "$.corridor"))
    return landed.groupBy("dir").agg(F.count(F.lit(1)).alias("rows"),
                                     F.countDistinct(entity).alias("entities"))


# ------------------------------------------------------------------ forecast model (rows-only)
_TRAINED: dict = {}


def trained(spark: SparkSession, sf: str):
    """Fit once per application and state of the data; later queries reuse the fitted pipeline."""
    from airshed.ml import model as M
    files = spark.read.parquet(f"{sf}/events.parquet").select("_metadata.file_path", "_metadata.file_size",
                                                              "_metadata.file_modification_time")
    state = files.distinct().agg(F.count("*"), F.sum(
        F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, sf, *state)
    if key not in _TRAINED:
        _TRAINED[key] = M.train(joins.horizon_samples(_training_rows(spark, sf)))
    return _TRAINED[key]


def train_metrics(spark: SparkSession, sf: str) -> DataFrame:
    from airshed.ml import model as M
    return M.metrics_frame(spark, trained(spark, sf))


def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    from airshed.ml import model as M
    return M.importances(spark, trained(spark, sf))


def nowcast(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.nowcast(trained(spark, sf).model, station_current(spark, sf), RUN_TS)


def forecast_curve(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.curve(trained(spark, sf).model, station_current(spark, sf), RUN_TS)


def forecast_peak(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.peak(forecast_curve(spark, sf))


def trend(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.trend(trained(spark, sf).model, station_current(spark, sf), RUN_TS)


def forecast_downsample(spark: SparkSession, sf: str) -> DataFrame:
    """SRT4: the curve every 3rd hour."""
    return scoring.downsample(forecast_curve(spark, sf))


def top_features(spark: SparkSession, sf: str) -> DataFrame:
    """AGG10: the five most important features."""
    from airshed.ml import model as M
    return M.top_importances(spark, trained(spark, sf), 5)


def dashboard_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """VW6: dashboard station rows with the +6 h forecast, its band and the trend label."""
    cur = station_current(spark, sf)
    t = trend(spark, sf).select("station", "forecast_aqi", "forecast_category", "delta", "trend")
    return views.dashboard_stations(cur).join(t, on="station", how="left")


# ------------------------------------------------------------------ forecast views, realised values
#: Taken from the realised AQI, so that the clamp at zero has values to work on.
REALISED_BIAS = 25.0


def realised_curve(spark: SparkSession, sf: str) -> DataFrame:
    """ML13 over a forecast that SQL can compute: per station and horizon the last realised target less
    a constant, clamped and rounded (FN16), with band and valid time."""
    pairs = joins.horizon_samples(_training_rows(spark, sf))
    raw = F.max_by("aqi_target", "time") - F.lit(REALISED_BIAS)
    f = pairs.groupBy("station", "horizon_h").agg(clamp_prediction(raw).alias("aqi_predicted"))
    f = f.withColumn("category", aqi_category("aqi_predicted"))
    return views.with_valid_time(f, RUN_TS)


def realised_peak(spark: SparkSession, sf: str) -> DataFrame:
    """AGG8 and SRT3 over the realised curve."""
    return scoring.peak(realised_curve(spark, sf))


def realised_downsample(spark: SparkSession, sf: str) -> DataFrame:
    """SRT4 over the realised curve."""
    return scoring.downsample(realised_curve(spark, sf))


def realised_trend(spark: SparkSession, sf: str) -> DataFrame:
    """JN9, JN6, FN11 and ML14 over the realised curve."""
    pairs = joins.now_vs_future(realised_curve(spark, sf))
    return views.trend_table(pairs, station_current(spark, sf))


def realised_dashboard(spark: SparkSession, sf: str) -> DataFrame:
    """VW4 and VW6: dashboard rows with forecast, band, delta and trend of the realised curve."""
    t = realised_trend(spark, sf).select("station", "forecast_aqi", "forecast_category", "delta", "trend")
    return views.dashboard_stations(station_current(spark, sf)).join(t, on="station", how="left")


def traffic_current(spark: SparkSession, sf: str) -> DataFrame:
    """JOB5: one row per corridor."""
    return serving.traffic_current(gold_traffic(spark, sf))


QUERIES = {
    "realised_curve": realised_curve,
    "realised_peak": realised_peak,
    "realised_downsample": realised_downsample,
    "realised_trend": realised_trend,
    "realised_dashboard": realised_dashboard,
    "traffic_current": traffic_current,
    "aqi_silver": aqi_silver,
    "silver_dirty_casts": silver_dirty_casts,
    "gold_stations": gold_stations,
    "aqi_latest": aqi_latest,
    "ml_features": ml_features,
    "traffic_silver": traffic_silver,
    "gold_traffic": gold_traffic,
    "traffic_bands": traffic_bands,
    "weather_wind_union": weather_wind_union,
    "weather_silver": weather_silver,
    "gold_weather": gold_weather,
    "station_current": station_current,
    "overview": overview,
    "worst_best_station": worst_best_station,
    "worst_corridor": worst_corridor,
    "city_weather": city_weather,
    "combined": combined,
    "uv_enrich": uv_enrich,
    "source_fallback": source_fallback,
    "aq_weather_hourly": aq_weather_hourly,
    "horizon_samples": horizon_samples,
    "sensor_pivot": sensor_pivot,
    "props_json": props_json,
    "hourly_arrays_explode": hourly_arrays_explode,
    "aq_payload": aq_payload,
    "aq_fallback_payload": aq_fallback_payload,
    "weather_payload": weather_payload,
    "traffic_payload": traffic_payload,
    "uv_payload": uv_payload,
    "stations_view": stations_view,
    "station_series": station_series,
    "traffic_view": traffic_view,
    "dashboard_stations": dashboard_stations,
    "dashboard_traffic": dashboard_traffic,
    "map_points": map_points,
    "pretty_names": pretty_names,
    "uv_bands": uv_bands,
    "wind_octant": wind_octant,
    "horizon_features": horizon_features,
    "forecast_time_grid": forecast_time_grid,
    "ingest_stream": ingest_stream,
    "landing_sinks": landing_sinks,
    "landing_compacted": landing_compacted,
    "job_rows": job_rows,
    "bronze_audit": bronze_audit,
    "incremental_stations": incremental_stations,
    "station_detail": station_detail,
    "split_counts": split_counts,
    "openaq_payload": openaq_payload,
    "openmeteo_payload": openmeteo_payload,
    "payload_kinds": payload_kinds,
    "dirty_payloads": dirty_payloads,
    "request_features": request_features,
    "request_rejects": request_rejects,
    "request_forecast": request_forecast,
    "train_metrics": train_metrics,
    "feature_importance": feature_importance,
    "nowcast": nowcast,
    "forecast_curve": forecast_curve,
    "forecast_peak": forecast_peak,
    "trend": trend,
    "forecast_downsample": forecast_downsample,
    "top_features": top_features,
    "dashboard_forecast": dashboard_forecast,
}
