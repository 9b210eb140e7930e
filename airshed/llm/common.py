"""Helpers shared by the training-data operators."""

from __future__ import annotations

import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of letters and digits: everything that is not ASCII punctuation, space or control.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_text(name: str) -> Column:
    """An id as text, for Python stages: pandas would turn a column of integers that has a null into
    floating numbers and round ids above 2**53. ``as_id`` turns it back."""
    return F.col(name).cast("string").alias(name)


def as_id(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text, lower-cased; none for null."""
    found = F.array_remove(F.split(lower_ascii(text), NO_WORD), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``). Local sessions without
    one get a folder of their own; elsewhere a missing setting is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(at := tempfile.mkdtemp(prefix="airshed-"))
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes ``df`` to the shared folder and reads it back."""
    path = f"{shared_dir(df.sparkSession)}/airshed-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """Marks ``df`` for broadcast if a count shows that it has at most ``max_rows`` rows;
    beyond that the join shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df
