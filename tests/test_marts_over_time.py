"""Snapshots that replace each other whole, the run ledger, and runs over the dates that changed."""

import json
import os

import pytest
from pyspark.sql import functions as F

from airshed.functions.numeric import average_of, average_state, exact_avg, merged_state
from airshed.operators import clean, marts
from airshed.plans import incremental, jobs, snapshots
from airshed.sources import adapters as A
from airshed.streaming import landing

SF, RUN = "/root/testdata/sf0.001", "2024-02-01T00:00:00+00:00"


def test_failed_snapshot_leaves_the_old_one(spark, tmp_path):
    at = f"{tmp_path}/mart"
    assert snapshots.read(spark, at) is None
    assert snapshots.publish(spark.range(5), at, "r1") == 5
    old = snapshots.read(spark, at)
    bad = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        snapshots.publish(bad, at, "r2")
    assert snapshots.read(spark, at).count() == 5
    assert snapshots.publish(spark.range(7), at, "r3") == 7
    assert snapshots.read(spark, at).count() == 7 and old.count() == 5  # a reader of the old one goes on
    assert snapshots.read(spark, at, version=1).count() == 5
    line = snapshots.current(spark, at)
    assert (line["version"], line["rows"], line["run_ts"]) == (2, 7, "r3") and line["started_at"] <= line["finished_at"]


def test_killed_before_the_manifest(spark, tmp_path, monkeypatch):
    """Data without its line is not there; vacuum removes it."""
    at = f"{tmp_path}/mart"
    snapshots.publish(spark.range(3), at, "r1")
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_append", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            snapshots.publish(spark.range(4), at, "r2")
    assert snapshots.read(spark, at).count() == 3 and len(os.listdir(f"{at}/data")) == 2
    snapshots.publish(spark.range(5), at, "r3")
    snapshots.publish(spark.range(6), at, "r4")
    assert len(snapshots.vacuum(spark, at, keep=2)) == 2
    assert snapshots.read(spark, at).count() == 6 and snapshots.read(spark, at, version=2).count() == 5
    assert snapshots.vacuum(spark, f"{tmp_path}/nothing") == []


def test_health_and_freshness(spark, tmp_path):
    lake = jobs.Lake(bronze=f"{tmp_path}/none", root=f"{tmp_path}/lake")
    first = jobs.health(spark, lake).first()
    assert first.last_refresh is None and first.pipeline_last_run is None and first.pipeline_status is None
    assert jobs.freshness(spark, lake).count() == 0
    jobs.run_pipeline(spark, lake, "2024-01-01")
    jobs.refresh_marts(spark, lake, "2024-01-01")
    one = jobs.health(spark, lake).first()
    assert one.pipeline_status == "ok" and one.pipeline_run_ts == "2024-01-01" and one.last_refresh is not None
    snapshots.record_run(spark, lake.root, "2024-01-02", "aqi", "failed", {}, "x", snapshots.now())
    assert jobs.health(spark, lake).first().pipeline_status == "failed"
    snapshots.record_run(spark, lake.root, "2024-01-02", "weather", "ok", {"a": 1}, "", snapshots.now())
    two = jobs.health(spark, lake).first()
    assert (two.pipeline_status, two.pipeline_run_ts, two.last_refresh) == ("partial", "2024-01-02", one.last_refresh)
    snapshots.publish(spark.range(2), lake.path("gold", "stations"), "2024-01-02")
    assert [(r.mart, r.version, r.rows) for r in jobs.freshness(spark, lake).collect()] == [("gold/stations", 1, 2)]


@pytest.mark.parametrize("values", [[0.1, 0.2, None, 3.0], [1.0, 1e13], [None], [1e-9, 2.0], []])
def test_merged_averages(spark, values):
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "p int, v double")
    parts = df.groupBy("p").agg(average_state("v").alias("s"))
    got = parts.agg(merged_state("s").alias("s")).select(average_of(F.col("s"))).first()[0]
    want = df.agg(exact_avg("v")).first()[0]
    assert got == want or got == pytest.approx(want, rel=1e-15)


def land(spark, root, number, feeds):
    env = None
    for topic, df in feeds.items():
        e = df.select(F.lit(topic).alias("topic"), F.to_json(F.struct(*df.columns)).alias("value"))
        env = e if env is None else env.unionByName(e)
    landing.write_batch(env, number, root, derive_wind=False)


def rows(df):
    return sorted(map(repr, df.drop("processed_at").collect()))


def test_one_new_date_equals_a_full_run(spark, tmp_path):
    """Three waves: the older dates, the newest one, and late and repeated rows of an old date."""
    root, lake = f"{tmp_path}/landed", jobs.Lake(bronze="", root=f"{tmp_path}/lake")
    feeds = {"aqi-raw": A.aqi_raw(spark, SF), "traffic-raw": A.traffic_raw(spark, SF).limit(3000),
             "weather-raw": A.weather_raw(spark, SF)}
    feeds = {t: spark.createDataFrame(df.collect(), df.schema) for t, df in feeds.items()}
    day = F.col("timestamp").substr(1, 10)
    newest = {t: df.agg(F.max(day)).first()[0] for t, df in feeds.items()}
    oldest = {t: df.agg(F.min(day)).first()[0] for t, df in feeds.items()}
    late = F.xxhash64("timestamp") % 3 == 0
    waves = [{t: df.where((day < newest[t]) & ~((day == oldest[t]) & late)) for t, df in feeds.items()},
             {t: df.where(day == newest[t]) for t, df in feeds.items()},
             {t: df.where(day == oldest[t]) for t, df in feeds.items()}]
    seen = []
    for i, wave in enumerate(waves):
        land(spark, root, i, wave)
        for feed in incremental.FEEDS:
            got = incremental.run_feed(spark, root, lake, feed, RUN)
            seen.append((i, feed, got.rows["dates"]))
        if i == 0:
            before = {p: os.stat(p).st_mtime_ns for f in incremental.FEEDS for p in files(f"{tmp_path}/lake/silver/{f}")}
    assert all(n == 1 for i, _, n in seen if i)
    assert incremental.run_feed(spark, root, lake, "aqi", RUN).message == "no new batch"
    full = {"aqi": (clean.clean_aqi, marts.station_gold, "stations"), "traffic": (clean.clean_traffic, marts.corridor_gold, "traffic"),
            "weather": (clean.clean_weather, marts.weather_gold, "weather")}
    for feed, (cleaned, gold, mart) in full.items():
        silver = cleaned(incremental.bronze(spark, root, feed).drop("dir", "batch", "_date"), RUN)
        assert rows(snapshots.read(spark, lake.path("gold", mart))) == rows(gold(silver, RUN)), feed
        assert rows(incremental._dated(spark, lake.path("silver", feed)).select(silver.columns)) == rows(silver)
        # silver of the other dates is untouched
        now = {p: os.stat(p).st_mtime_ns for p in files(f"{tmp_path}/lake/silver/{feed}")}
        kept = [p for p in before if f"silver/{feed}/" in p and oldest[f"{feed}-raw"] not in p]
        assert kept and all(now[p] == before[p] for p in kept)


def files(at):
    return [os.path.join(d, f) for d, _, names in os.walk(at) for f in names if f.endswith(".parquet")]


def test_plan_reads_only_the_needed_batches(spark, tmp_path):
    root, lake = f"{tmp_path}/landed", jobs.Lake(bronze="", root=f"{tmp_path}/lake")
    rec = lambda day, h: json.dumps({"station": "s", "timestamp": f"{day}T{h:02d}:00:00+00:00", "aqi": 5})
    for i, day in enumerate(["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-02"]):
        env = spark.createDataFrame([("aqi-raw", rec(day, i))], "topic string, value string")
        landing.write_batch(env, i, root)
        if i < 3:
            incremental.run_feed(spark, root, lake, "aqi", RUN)
    last, upto, pairs = incremental.affected(spark, root, lake, "aqi")
    assert (last, upto, [tuple(r) for r in pairs.collect()]) == (2, 3, [("2024-01-02", 3)])
    index = incremental._parquet(spark, lake.path("state", "aqi") + "/dates", incremental.DATES).unionByName(pairs)
    got = incremental.records_of(spark, root, "aqi", index, pairs.select(F.col("date").alias("_d")))
    assert sorted(r.timestamp for r in got.collect()) == ["2024-01-02T01:00:00+00:00", "2024-01-02T03:00:00+00:00"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan json" in x or "Scan json" in x)
    assert "batch" in scan.split("PartitionFilters: ")[1].split("]")[0]


def test_failed_run_is_run_again(spark, tmp_path, monkeypatch):
    root, lake = f"{tmp_path}/landed", jobs.Lake(bronze="", root=f"{tmp_path}/lake")
    env = spark.createDataFrame([("aqi-raw", json.dumps({"station": "s", "timestamp": f"2024-01-0{i}T00:00:00+00:00",
                                                         "aqi": i})) for i in (1, 2)], "topic string, value string")
    landing.write_batch(env, 0, root)
    with monkeypatch.context() as m:
        m.setattr(snapshots, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            incremental.run_feed(spark, root, lake, "aqi", RUN)
    assert incremental.run_feed(spark, root, lake, "aqi", RUN).rows == {"dates": 2, "gold_stations": 1}
    assert snapshots.read(spark, lake.path("gold", "stations")).first().reading_count == 2
    assert incremental.run_feed(spark, root, lake, "traffic", RUN).rows == {"dates": 0}
