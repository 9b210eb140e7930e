"""Compaction of landed batches: the same records, fewer files, never both copies, nothing from a failed run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airshed.plans import incremental, jobs
from airshed.sources import bronze
from airshed.streaming import compaction, landing


def batch(spark, first, n=20):
    i = F.col("id")
    record = F.to_json(F.struct(F.concat(F.lit("s"), (i % 5).cast("string")).alias("station"), i.cast("string").alias("aqi"),
                                F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + i * 3600),
                                              "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("timestamp")))
    rows = spark.range(first, first + n).select(F.lit("aqi-raw").alias("topic"), record.alias("value"))
    return rows.unionByName(rows.limit(3)).unionByName(rows.select(F.lit("uv-raw").alias("topic"), "value").limit(2))


def seen(spark, root):
    return sorted(map(tuple, compaction.read_landed(spark, root).collect()))


@pytest.fixture
def root(spark, tmp_path):
    at = f"file://{tmp_path}/lake"
    for i in range(3):
        landing.write_batch(batch(spark, 20 * i), i, at)
    return at


def test_records_stay_and_files_go(spark, root, tmp_path):
    before = seen(spark, root)
    files = {(r["dir"], r["rows"]): r["files"] for r in compaction.audit(spark, root).collect()}
    assert files[("aqi", 69)] >= 3 and files[("uv", 6)] >= 3 and len(before) == 75
    old = compaction.read_landed(spark, root)  # a reader from before
    assert compaction.compact(spark, root, min_files=2) == 2
    assert seen(spark, root) == before  # the covered batches are still there and are not read
    assert old.count() == 75
    assert {r["files"] for r in compaction.audit(spark, root).collect()} == {1}
    assert compaction.vacuum(spark, root) == 6  # three batches of two folders
    assert seen(spark, root) == before and compaction.vacuum(spark, root) == 0
    assert compaction.compact(spark, root, min_files=1) == 0  # nothing new
    landing.write_batch(batch(spark, 60), 3, root)
    assert len(seen(spark, root)) == 100
    assert compaction.compact(spark, root, min_files=2) == 0  # one file is not worth it
    assert compaction.compact(spark, root, min_files=1) == 2
    assert len(seen(spark, root)) == 100 and {r["files"] for r in compaction.audit(spark, root).collect()} == {1}
    assert compaction.vacuum(spark, root) == 3  # two batch folders, the first run
    assert len(seen(spark, root)) == 100
    assert len(list((tmp_path / "lake" / "compacted").glob("run=*"))) == 1


def test_unfinished_batches_and_failed_runs_are_not_committed(spark, root, monkeypatch, tmp_path):
    before = seen(spark, root)
    for p in (tmp_path / "lake" / "done" / "batch=2").glob("*"):
        p.unlink()  # batch 2 is still being written
    whole = compaction._contents
    monkeypatch.setattr(compaction, "_contents", lambda df: whole(df).withColumn("code", F.rand()))
    with pytest.raises(RuntimeError, match="not committed"):
        compaction.compact(spark, root, min_files=2)
    monkeypatch.setattr(compaction, "_contents", whole)
    assert compaction.commits(spark, root).count() == 0 and seen(spark, root) == before
    assert compaction.compact(spark, root, min_files=2) == 2
    assert {r["upto"] for r in compaction.commits(spark, root).collect()} == {1}
    assert compaction.vacuum(spark, root) == 5  # two batches of two folders, the failed run
    assert seen(spark, root) == before


def test_jobs_read_compacted_bronze(spark, root, tmp_path):
    """Readers and date-wise runs give the same over compacted bronze, and prune dates."""
    read = lambda: sorted(map(repr, bronze.read_bronze(spark, root, "aqi", layout="landed").collect()))
    assert read() == sorted(map(repr, bronze.read_bronze(spark, f"{root}/bronze", "aqi").select(
        *bronze.read_bronze(spark, root, "aqi", layout="landed").columns).collect()))
    before = read()
    mart = lambda name: sorted(repr(r) for r in _gold(spark, root, f"file://{tmp_path}/{name}"))
    plain = mart("plain")
    compaction.compact(spark, root, min_files=2)
    compaction.vacuum(spark, root)
    assert read() == before and mart("merged") == plain and len(plain) == 5
    tomorrow = (dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=2)).strftime("%Y-%m-%d")
    assert bronze.read_bronze(spark, root, "aqi", layout="landed", since=tomorrow) is None
    assert bronze.read_bronze(spark, root, "weather", layout="landed") is None


def _gold(spark, root, lake):
    from airshed.plans import snapshots
    at = jobs.Lake(bronze="", root=lake)
    assert incremental.run_feed(spark, root, at, "aqi", "2024-01-01T00:00:00").ok
    return snapshots.read(spark, at.path("gold", "stations")).collect()


def test_nothing_landed(spark, tmp_path):
    at = f"file://{tmp_path}/none"
    assert compaction.compact(spark, at) == 0 and compaction.vacuum(spark, at) == 0
    assert compaction.read_landed(spark, at).count() == 0 and compaction.audit(spark, at).count() == 0
