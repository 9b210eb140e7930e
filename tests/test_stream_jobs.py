import json
import re
import os

from pyspark.sql import functions as F

from airshed.plans import jobs, sinks, snapshots
from airshed.streaming import ingest


def write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def aqi_rec(st, ts, aqi):
    return {"station": st, "lat": -6.1, "lon": 106.8, "timestamp": ts, "aqi": aqi, "pm25": 10,
            "pm10": 20, "no2": 5, "o3": 7, "so2": None, "co": 0.3, "source": "t"}


def weather_rec(st, ts, temp):
    return {"station": st, "lat": -6.1, "lon": 106.8, "timestamp": ts, "temp_c": temp,
            "feels_like_c": temp, "humidity_pct": 70, "pressure_hpa": 1000, "wind_speed_ms": 2,
            "wind_deg": 90, "clouds_pct": 10, "weather_main": "Clear", "weather_desc": "clear",
            "rain_1h_mm": 0, "uv_index": 4, "source": "t"}


def traffic_rec(c, ts, ratio):
    return {"corridor": c, "lat": -6.2, "lon": 106.8, "timestamp": ts, "current_speed_kmh": 30,
            "free_flow_kmh": 50, "congestion_ratio": ratio, "confidence": 1, "road_closure": False,
            "source": "t"}


def envelope(topic, rec):
    return json.dumps({"topic": topic, "value": json.dumps(rec)})


def test_landing_routes_and_restarts_without_duplicates(spark, tmpdir_path):
    src, bronze, ck = (os.path.join(tmpdir_path, d) for d in ("in", "bronze", "ck"))
    T = "2024-01-01T00:00:00+00:00"
    lines = [envelope("aqi-raw", aqi_rec("a", T, 50)), envelope("weather-raw", weather_rec("a", T, 30)),
             envelope("wind-raw", {"station": "a", "timestamp": T, "wind_speed_ms": 2}),
             envelope("alerts", {"x": 1}),                         # topic outside the routing map
             "{not json", envelope("traffic-raw", traffic_rec("c", T, 0.5))]
    write_lines(os.path.join(src, "batch1.json"), lines)
    for _ in range(2):                                           # restart over the same files
        ingest.start_landing(ingest.file_source(spark, src), bronze, ck, available_now=True).awaitTermination()
    landed = spark.read.text(bronze)
    counts = {r.dir: r.n for r in landed.groupBy("dir").agg(F.count("*").alias("n")).collect()}
    assert counts == {"aqi": 1, "weather": 2, "traffic": 1}
    audit = sinks.bronze_audit(landed).collect()
    assert sum(r.rows for r in audit) == 4


def test_pipeline_jobs_over_paths(spark, tmpdir_path):
    bronze = os.path.join(tmpdir_path, "bronze")
    T = "2024-01-01T0{}:00:00+00:00"
    d = "ingest_date=2024-01-01"
    write_lines(f"{bronze}/dir=aqi/{d}/part-0.txt",
                [json.dumps(aqi_rec("a", T.format(i), 20 * i)) for i in range(1, 5)] + ["garbage"])
    write_lines(f"{bronze}/dir=weather/{d}/part-0.txt",
                [json.dumps(weather_rec("a", T.format(i), 25 + i)) for i in range(1, 3)]
                + [json.dumps({"station": "a", "timestamp": T.format(1), "wind_speed_ms": 3})])
    # no traffic dir: that job is skipped with a message, the pipeline still completes
    lake = jobs.Lake(bronze=bronze, root=os.path.join(tmpdir_path, "lake"))
    status = {r.job: r for r in jobs.run_pipeline(spark, lake, "2024-01-02T00:00:00+00:00").collect()}
    assert all(r.ok for r in status.values()) and status["aqi"].status == "ok"
    assert status["aqi"].rows["silver_aqi"] == 4 and status["aqi"].rows["gold_stations"] == 1
    assert status["weather"].rows["silver_combined"] == 2
    assert "skipped" in status["traffic"].message
    feats = snapshots.read(spark, lake.path("gold", "ml_features"))
    assert dict(feats.dtypes)["date"] == "string" and feats.first().date == "2024-01-01"
    comb = snapshots.read(spark, lake.path("silver", "combined")).orderBy("timestamp").collect()
    assert [r.aqi for r in comb] == [20.0, 40.0]
    out = jobs.refresh_marts(spark, lake)
    assert out == {"stations": 1, "corridors": 0}
    marts = {r.mart for r in jobs.freshness(spark, lake).collect()}
    assert "serving/station_current" in marts


def test_plain_layout_and_missing(spark, tmpdir_path):
    from airshed.sources.bronze import read_bronze, read_json_dir
    from airshed.sources import schemas
    root = os.path.join(tmpdir_path, "b")
    write_lines(f"{root}/aqi/2024-01-01/000000000000.jsonl",
                [json.dumps(aqi_rec("a", "2024-01-01T00:00:00+00:00", 1))])
    assert read_bronze(spark, root, "aqi", layout="plain").count() == 1
    assert read_bronze(spark, root, "traffic", layout="plain") is None
    gold = os.path.join(tmpdir_path, "gold")
    write_lines(f"{gold}/part-00000.json", ['{"station": "a", "aqi": "1"}', "", "{broken"])
    write_lines(f"{gold}/other.json", ['{"station": "z"}'])
    got = read_json_dir(spark, gold, schemas.AQI).collect()
    assert [r.station for r in got] == ["a"]
    assert read_json_dir(spark, os.path.join(tmpdir_path, "nope"), schemas.AQI).count() == 0


def test_since_bound_prunes_dates(spark, tmpdir_path):
    from airshed.sources.bronze import read_bronze
    bronze = os.path.join(tmpdir_path, "bronze")
    for day, n in [("2024-01-01", 2), ("2024-01-02", 3)]:
        write_lines(f"{bronze}/dir=aqi/ingest_date={day}/part-0.txt",
                    [json.dumps(aqi_rec("a", f"{day}T0{i}:00:00+00:00", 10)) for i in range(n)])
    df = read_bronze(spark, bronze, "aqi", since="2024-01-02")
    assert df.count() == 3
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = read_bronze(spark, bronze, "aqi", since="2024-01-02")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)[1]
    assert "isnotnull(ingest_date" in filters and "isnotnull(dir" in filters


def test_kafka_without_connector_says_so(spark):
    import pytest
    with pytest.raises(RuntimeError, match="Kafka connector"):
        ingest.kafka_source(spark, "localhost:9", ["aqi-raw"])


def test_stream_to_marts_end_to_end(spark, tmpdir_path):
    src, bronze, ck = (os.path.join(tmpdir_path, d) for d in ("in", "bronze", "ck"))
    T = "2024-01-01T0{}:00:00+00:00"
    lines = ([envelope("aqi-raw", aqi_rec(st, T.format(i), 30 * i)) for st in "ab" for i in range(1, 4)]
             + [envelope("weather-raw", weather_rec("a", T.format(2), 31.0))]
             + [envelope("traffic-raw", traffic_rec("c", T.format(i), 0.1 * i)) for i in range(1, 6)])
    write_lines(os.path.join(src, "b1.json"), lines)
    ingest.start_landing(ingest.file_source(spark, src), bronze, ck, available_now=True).awaitTermination()
    lake = jobs.Lake(bronze=bronze, root=os.path.join(tmpdir_path, "lake"))
    status = {r.job: r for r in jobs.run_pipeline(spark, lake, "2024-01-02T00:00:00+00:00").collect()}
    assert status["aqi"].rows == {"silver_aqi": 6, "gold_stations": 2, "gold_ml_features": 6}
    assert status["traffic"].rows == {"gold_traffic": 1}
    assert jobs.refresh_marts(spark, lake) == {"stations": 2, "corridors": 1}
    cur = {r.station: r for r in snapshots.read(spark, lake.path("serving", "station_current")).collect()}
    assert cur["a"].temp_c == 31.0 and cur["b"].temp_c is None and cur["a"].latest_aqi == 90.0


def test_cli_runs_pipeline(spark, tmpdir_path):
    from airshed.plans import run
    bronze = os.path.join(tmpdir_path, "bronze")
    write_lines(f"{bronze}/dir=traffic/ingest_date=2024-01-01/part-0.txt",
                [json.dumps(traffic_rec("c", f"2024-01-01T0{i}:00:00+00:00", 0.5)) for i in range(3)])
    out = run.main(["--bronze", bronze, "--lake", os.path.join(tmpdir_path, "lake"),
                    "--run-ts", "2024-01-02T00:00:00+00:00"], spark=spark)
    assert out["marts"] == {"stations": 0, "corridors": 1}
    assert {j["job"]: j["ok"] for j in out["jobs"]} == {"aqi": True, "weather": True, "traffic": True}


def test_cli_scores_with_saved_model(spark, tmpdir_path):
    from datetime import datetime, timedelta

    from pyspark.sql import functions as F

    from airshed.ml import dataset, model
    from airshed.plans import run
    lake = os.path.join(tmpdir_path, "lake")
    rows = [(f"s{s}", datetime(2024, 1, 1) + timedelta(hours=h), float(h % 24 + s)) for s in range(3) for h in range(40)]
    df = spark.createDataFrame(rows, "station string, time timestamp, v double")
    aq = df.select("station", "time", F.col("v").alias("pm25"), F.col("v").alias("pm10"), F.lit(1.0).alias("no2"),
                   F.lit(1.0).alias("o3"), (F.col("v") + 5).alias("aqi"))
    wx = df.select("station", "time", F.lit(28.0).alias("temp_c"), F.lit(70.0).alias("humidity_pct"),
                   F.lit(2.0).alias("wind_speed_ms"))
    model.save(model.train(dataset.training_samples(aq, wx), num_trees=3, max_depth=5), f"{lake}/models/forecast")
    bronze = os.path.join(tmpdir_path, "bronze")
    write_lines(f"{bronze}/dir=aqi/ingest_date=2024-01-01/part-0.txt",
                [json.dumps(aqi_rec(st, "2024-01-01T01:00:00+00:00", 40)) for st in "ab"])
    out = run.main(["--bronze", bronze, "--lake", lake, "--run-ts", "2024-02-01T00:00:00+00:00", "--score"], spark=spark)
    assert out["forecast_rows"] == 50 and out["peaks"] == 2 and out["trend"] == 2


def test_wind_projection_from_weather_values(spark):
    rec = weather_rec("a", "2024-01-01T00:00:00+00:00", 30)
    rec["wind_gust_ms"] = 4.5
    df = spark.createDataFrame([(json.dumps(rec),)], "value string")
    out = ingest.wind_projection(df).first()
    assert out.topic == "wind-raw"
    wind = json.loads(out.value)
    assert wind["station"] == "a" and wind["wind_speed_ms"] == 2.0 and wind["wind_gust_ms"] == 4.5
    assert wind["source"] == "openweathermap" and "temp_c" not in wind


def test_json_sink_read_back_like_the_serving_layer(spark, tmpdir_path):
    from airshed.plans.sinks import write_table
    from airshed.sources.bronze import read_json_dir
    from pyspark.sql import types as T
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "station string, avg_aqi double")
    path = os.path.join(tmpdir_path, "gold_json")
    assert write_table(df, path, fmt="json") == 2
    schema = T.StructType([T.StructField("station", T.StringType()), T.StructField("avg_aqi", T.DoubleType())])
    got = sorted(tuple(r) for r in read_json_dir(spark, path, schema).collect())
    assert got == [("a", 1.5), ("b", None)]
