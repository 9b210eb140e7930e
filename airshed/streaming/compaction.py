"""Compaction of landed bronze (STR3, SNK3): the small files that batches leave, merged by folder and date.

``compact`` merges the finished batches of each (dir, ingest_date) that has many files into one folder
``compacted/run=<id>/dir=<name>/ingest_date=<yyyy-mm-dd>/`` (Parquet, ordered by batch, so that a range of
batches is found by its statistics). It audits what it wrote against what it read, and then commits all of
them with one file of lines in ``compactions/``. ``read_landed`` is the one way to read: a (dir, date) comes
from the folder that its newest line names, plus the batches after that line. A reader takes the log's files
once, so it sees a record exactly once whenever a compaction commits; a run that fails before its
commit is never seen. ``vacuum`` deletes what is covered. One compaction runs at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.streaming.landing import finished_batches

LOG = "number long, run string, dir string, ingest_date date, upto long, rows long, files_before long"
RAW = "value string, dir string, ingest_date date, batch long, feed string"
KEY = ["dir", "ingest_date"]
MIN_FILES = 8  # a folder and date with fewer files is left as it is
ROWS = 20_000_000  # in a file, at most


def _read(spark: SparkSession, fmt: str, path: str, schema: str) -> DataFrame:
    """The rows below ``path`` and the file of each; none if it is not there yet."""
    try:
        # text takes no types of the folders' columns, which are missing where no folder is left
        df = spark.read.load(path, fmt, schema=None if fmt == "text" else schema)
        if "dir" in df.columns:
            types = spark.createDataFrame([], schema).schema
            return df.select(*[F.col(f.name).cast(f.dataType) for f in types],
                             F.col("_metadata.file_path").alias("file"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return spark.createDataFrame([], f"{schema}, file string")


def commits(spark: SparkSession, root: str) -> DataFrame:
    """Every committed compaction: a line for each (dir, date) of each run."""
    return _read(spark, "json", f"{root}/compactions", LOG).drop("file")


def _live(spark: SparkSession, root: str) -> DataFrame:
    """The newest line of each (dir, date): a few lines a day, so it can be broadcast."""
    return (commits(spark, root).groupBy(*KEY)
            .agg(F.max_by(F.struct("number", "run", "upto"), "number").alias("c")).select(*KEY, "c.*"))


def _parts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """What has been compacted, and the batches that have not; each with the file of its records."""
    live = F.broadcast(_live(spark, root))
    names = ["value", *KEY, "batch", "feed", "file"]
    merged = _read(spark, "parquet", f"{root}/compacted", f"{RAW}, run string")
    merged = merged.join(live.select("run", *KEY), ["run", *KEY], "left_semi")
    raw = _read(spark, "text", f"{root}/bronze", RAW).join(live.select(*KEY, "upto"), KEY, "left")
    raw = raw.where(F.col("upto").isNull() | (F.col("batch") > F.col("upto")))
    return merged.select(*names), raw.select(*names)


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """value, dir, ingest_date, batch, feed of every landed record, compacted or not."""
    merged, raw = _parts(spark, root)
    return merged.unionByName(raw).drop("file")


def records(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The records of one folder with the fields of ``schema``, and ``ingest_date`` and ``batch``."""
    return (read_landed(spark, root).where(F.col("dir") == name)
            .select(F.from_json("value", schema).alias("r"), "ingest_date", "batch")
            .select("r.*", "ingest_date", "batch"))


def audit(spark: SparkSession, root: str) -> DataFrame:
    """SNK3: files and rows that a reader meets, by folder and date."""
    merged, raw = _parts(spark, root)
    return (merged.unionByName(raw).groupBy(*KEY)
            .agg(F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("rows")))


def _contents(df: DataFrame) -> DataFrame:
    """By folder and date: rows, and a sum of row hashes, equal for equal sets of rows with repeats."""
    code = F.xxhash64("value", "batch", "feed").cast("decimal(38,0)")
    return df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"), F.sum(code).alias("code"))


def compact(spark: SparkSession, root: str, min_files: int = MIN_FILES) -> int:
    """Merges the finished batches of every folder and date with at least ``min_files`` files of single
    batches; returns how many folders and dates were merged. Records of unfinished batches stay."""
    upto = finished_batches(spark, root).agg(F.max("batch")).first()[0]
    if upto is None:
        return 0
    merged, raw = _parts(spark, root)
    raw = raw.where(F.col("batch") <= upto)
    due = (raw.groupBy(*KEY).agg(F.countDistinct("file").alias("files_before"))
           .where(F.col("files_before") >= min_files))
    due = spark.createDataFrame(due.collect(), due.schema)  # a few lines a day: fixed for the whole run
    if due.isEmpty():
        return 0
    source = merged.unionByName(raw).drop("file").join(F.broadcast(due.select(*KEY)), KEY, "left_semi")
    run = uuid.uuid4().hex
    out = f"{root}/compacted/run={run}"
    (source.hint("rebalance", *KEY).sortWithinPartitions(*KEY, "batch").write.partitionBy(*KEY)
     .option("maxRecordsPerFile", ROWS).parquet(out))
    written = _read(spark, "parquet", out, RAW)
    lines = (_contents(source).alias("a").join(_contents(written).alias("b"), KEY, "full")
             .join(due, KEY, "left").select(*KEY, "files_before", F.col("a.rows").alias("rows"), F.expr(
                 "a.rows <=> b.rows and a.code <=> b.code").alias("same"))).collect()
    if not all(r["same"] for r in lines):
        raise RuntimeError(f"compaction {run} wrote other records than it read; it is not committed")
    number = (commits(spark, root).agg(F.max("number")).first()[0] or 0) + 1
    spark.createDataFrame([(number, run, r["dir"], r["ingest_date"], upto, r["rows"], r["files_before"])
                           for r in lines], LOG).coalesce(1).write.mode("append").json(f"{root}/compactions")
    return len(lines)


def vacuum(spark: SparkSession, root: str) -> int:
    """Deletes batches that have been compacted and folders that no line of the log needs; returns their
    number. To be run when no reader from before the last compaction is left, and no compaction runs."""
    live = _live(spark, root).collect()
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(conf)

    def under(folder: str) -> list:
        at = path(folder)
        return [f.getPath() for f in fs.listStatus(at)] if fs.exists(at) else []

    gone = [p for c in live for p in under(f"{root}/bronze/dir={c['dir']}/ingest_date={c['ingest_date']}")
            if p.getName().startswith("batch=") and int(p.getName()[6:]) <= c["upto"]]
    kept = {(c["run"], c["dir"], str(c["ingest_date"])) for c in live}
    for run in under(f"{root}/compacted") if live else []:
        parts = [day for folder in under(run.toString()) for day in under(folder.toString())
                 if "=" in day.getName()]
        old = [d for d in parts if (run.getName()[4:], d.getParent().getName()[4:], d.getName()[12:]) not in kept]
        gone += [run] if len(old) == len(parts) else old
    for folder in gone:
        fs.delete(folder, True)
    return len(gone)
