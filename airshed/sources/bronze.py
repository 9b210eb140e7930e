"""Bronze / gold readers over paths (SRC1-SRC4, SET1).

Bronze layout written by the landing stream: ``<root>/dir=<name>/ingest_date=<yyyy-mm-dd>/``
with JSON lines.  ``dir`` and ``ingest_date`` are partition columns, so a date bound prunes
directories before any file is listed.  The plain upstream layout ``<root>/<name>/<date>/*``
is read with ``layout="plain"``, and the root of ``streaming.landing``, compacted or not, with
``layout="landed"``.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.sources import schemas
from airshed.streaming import compaction

log = logging.getLogger("airshed.sources")


def read_bronze(spark: SparkSession, root: str, name: str, schema=None, layout: str = "partitioned",
                since: str | None = None) -> DataFrame | None:
    """SRC1 + SRC2: every landed record of one bronze dir, or None (with a warning) when the
    dir is missing or empty.  Malformed lines survive as NULL fields (PERMISSIVE) and drop
    out at the silver ``dropna``."""
    schema = schema or schemas.BY_DIR[name]
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    try:
        if layout == "plain":
            df = reader.json(f"{root}/{name}/*/*")
        elif layout == "landed":
            df = compaction.records(spark, root, name, schema).drop("batch").withColumn("dir", F.lit(name))
            if since is not None:
                df = df.filter(F.col("ingest_date") >= F.lit(since).cast("date"))
        else:
            full = T.StructType([*schema.fields, T.StructField("dir", T.StringType()),
                                 T.StructField("ingest_date", T.DateType())])
            # the root, not dir=<name>: there the stream's commit log names the files that count
            df = (spark.read.option("mode", "PERMISSIVE").schema(full).json(root)
                  .filter(F.col("dir") == name).select(*[f.name for f in full.fields]))
            if since is not None:
                df = df.filter(F.col("ingest_date") >= F.lit(since).cast("date"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            log.warning("bronze folder %s has no records; its job does nothing", name)
            return None
        raise
    if df.isEmpty():
        log.warning("bronze folder %s has no records; its job does nothing", name)
        return None
    return df


def read_json_dir(spark: SparkSession, path: str, schema) -> DataFrame:
    """SRC3: only ``part-*.json`` files, malformed lines skipped, empty frame when missing."""
    try:
        return (spark.read.schema(schema).option("mode", "DROPMALFORMED")
                .option("pathGlobFilter", "part-*.json").json(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """SRC4: a silver / gold Parquet table, or None when it has not been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
