"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session defaults: UTC wall clock, AQE with partition coalescing and skew-join splitting.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Cluster profile for inputs in the 10-100 TB range.  Shuffles start wide (AQE merges small
# partitions down to the advisory size after each map stage, so starting wide only costs
# map-side bookkeeping), file splits are large enough to keep task counts manageable, hot
# partitions are split by the skew-join rule, and the runtime broadcast threshold is the only
# place a join side is broadcast without an explicit, bounded dimension.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    "spark.sql.files.maxRecordsPerFile": "50000000",
}


def get_spark(master: str | None = None, app: str = "airshed",
              shuffle_partitions: int | None = None, conf: dict | None = None,
              profile: str = "local") -> SparkSession:
    """Return (or create) a session with the engine's defaults.

    On a cluster ``master`` stays None, spark-submit decides, and ``profile="cluster"`` adds
    the large-input sizing above; tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if profile == "cluster":
        settings.update(CLUSTER_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Only a local session without one gets
    a private folder; elsewhere a missing setting is an error, as executors could not read it.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="airshed-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for a written intermediate table."""
    return os.path.join(checkpoint_dir(spark), name)
