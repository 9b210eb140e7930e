"""Sinks (SNK1-SNK3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> int:
    """SNK1 + SNK2: overwrite ``path`` and return the row count observed *during* the write
    (no second pass over the data).

    No ``coalesce(1)`` (it would pull the whole upstream stage into one task).  Instead a
    ``rebalance`` hint lets AQE size the output: partitions of the written columns are
    gathered (few files per date instead of one per task and date), a hot date is split
    over several tasks, small ones are merged.
    """
    obs = Observation()
    df = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = counted.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)
    return int(obs.get["rows"])


def bronze_audit(bronze: DataFrame) -> DataFrame:
    """SNK3: landed files and rows per bronze dir and ingest date."""
    return (bronze.select("dir", "ingest_date", F.col("_metadata.file_path").alias("file"))
                  .groupBy("dir", "ingest_date")
                  .agg(F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("rows")))
