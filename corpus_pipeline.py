"""Corpus pipeline: language ID, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. Stages handle nulls in any column, empty texts and empty tables as their operators say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm import decontamination, jaccard, language, mixing, sharding
from airshed.llm.common import small, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHINGLE = 5  # words, of near duplicates
NUM, DEN = 4, 5  # least similarity of near duplicates
LEAST_SCORE = 0.5  # of the language: texts below it are not in one language
IDS = 4_000_000  # lists of keys up to this length are broadcast


def _row(docs: DataFrame) -> Column:
    """One number for a row's id and text together: lists of such numbers are short enough to broadcast."""
    return F.xxhash64(docs["doc_id"], mixing.text_key(docs["text"]))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose number is in ``gone`` (_gone)."""
    gone = small(written(gone.distinct(), "gone"), IDS)
    return docs.join(gone, _row(docs) == F.col("_gone"), "left_anti").select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those of which no language has LEAST_SCORE; ``lang`` is kept as it
    is. The tagger learns from the rows of ``docs`` that are not held out."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    tagger = language.train(language.sample(docs, ~F.coalesce(held, F.lit(False))))
    return language.filter_texts(docs, tagger, LEAST_SCORE).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each component of linked documents: those whose
    sets of SHINGLE words have a similarity of NUM / DEN or more (op9_jaccard has its own values)."""
    return jaccard.keep_one(docs, NUM, DEN, SHINGLE).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    keyed = docs.select(_row(docs).alias("_gone"), "text")
    hits = decontamination.find_hits(keyed, table(spark, sf_dir, "benchmark"), ["_gone"])
    return _without(docs, hits.where(F.size("spans") > 0).select("_gone"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix says: not at all, once or repeatedly."""
    copies = mixing.mix_documents(docs).groupBy(F.xxhash64("doc_id", "text_key").alias("_number")).agg(
        F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    other = small(written(copies.where("_copies <> _rows"), "copies"), IDS)
    found = docs.join(other, _row(docs) == F.col("_number"), "left")
    # equal rows share what the mix takes of them as evenly as whole copies allow
    once = found.where("_rows is null or _rows = 1")
    many = (found.where("_rows > 1").groupBy(*COLUMNS).agg(F.first("_copies").alias("_copies")))
    times = F.coalesce("_copies", F.lit(1)).cast("int")
    out = once.select(*COLUMNS, times.alias("_t")).unionByName(
        many.select(*COLUMNS, times.alias("_t")))
    return out.where("_t > 0").select(*COLUMNS, F.explode(F.array_repeat(F.lit(1), F.col("_t")))
                                      .alias("_c")).drop("_c")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    return sharding.shard_documents(docs)


STAGES = [("language ID", language_id), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination_stage),
          ("mixing to target weights", mix_sources), ("sharding", shard)]

#: Cube sampling and a trained tagger have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
