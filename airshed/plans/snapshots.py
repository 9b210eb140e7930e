"""Marts as snapshots, and the ledger of runs.

A mart is a folder with ``data/<version>-<id>/`` for every snapshot and ``manifest/``, one line per finished
snapshot. A snapshot counts once its line is there, and that is written last: a run that fails on the way
leaves the mart as it was, and readers of the old snapshot are not disturbed. One writer per mart.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, folder string, rows long, run_ts string, started_at string, finished_at string"
LEDGER = ("run_ts string, job string, status string, rows map<string,long>, message string, "
          "started_at string, finished_at string")


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The lines of an append-only folder; none if it is not there yet."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def _append(spark: SparkSession, path: str, row: tuple, schema: str) -> None:
    """One line: a file that the commit of its job moves into place whole."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The finished snapshots of a mart."""
    return _lines(spark, f"{path}/manifest", MANIFEST)


def current(spark: SparkSession, path: str):
    """The manifest's line of the newest snapshot, or None."""
    return manifest(spark, path).orderBy(F.desc("version"), F.desc("finished_at")).first()


def publish(df: DataFrame, path: str, run_ts: str) -> int:
    """SNK1 + SNK2: writes ``df`` as the next snapshot and then makes it the current one; returns its rows."""
    spark = df.sparkSession
    started, last = now(), current(spark, path)
    version = last["version"] + 1 if last else 1
    folder = f"data/{version:08d}-{uuid.uuid4().hex}"
    counted = Observation()
    df.hint("rebalance").observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path}/{folder}")
    rows = int(counted.get["rows"])
    _append(spark, f"{path}/manifest", (version, folder, rows, run_ts, started, now()), MANIFEST)
    return rows


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """SRC4: a mart's current snapshot (or a given one); None if there is none."""
    line = (current(spark, path) if version is None
            else manifest(spark, path).where(F.col("version") == version).first())
    return spark.read.parquet(f"{path}/{line['folder']}") if line else None


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Deletes what no reader of the ``keep`` newest snapshots needs, unfinished ones included; returns the
    deleted folders. Not to be run while a snapshot is written."""
    lines = manifest(spark, path).orderBy(F.desc("version")).limit(keep).collect()
    wanted = {r["folder"].split("/")[1] for r in lines}
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    fs = at.getFileSystem(conf)
    if not wanted or not fs.exists(at):
        return []
    gone = [f.getPath() for f in fs.listStatus(at) if f.getPath().getName() not in wanted]
    for folder in gone:
        fs.delete(folder, True)
    return sorted(folder.getName() for folder in gone)


def record_run(spark: SparkSession, root: str, run_ts: str, job: str, status: str, rows: dict, message: str,
               started_at: str) -> None:
    """JOB4: one line in the run ledger of a lake."""
    _append(spark, f"{root}/ledger", (run_ts, job, status, {k: int(v) for k, v in rows.items()}, message,
                                      started_at, now()), LEDGER)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Every finished run: run_ts, job, status, rows by table, message, start and end."""
    return _lines(spark, f"{root}/ledger", LEDGER)
