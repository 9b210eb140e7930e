"""The corpus pipeline, stage by stage, on its own input."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from airshed.llm import common, mixing

RNG = np.random.default_rng(8)
WORDS = {"en": [f"the{x}ing" for x in "abcdefghij"], "fr": [f"é{x}eaux" for x in "abcdefghij"]}
ITEM = " ".join(RNG.choice(WORDS["en"], 30))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, " ".join(RNG.choice(WORDS[x], int(RNG.integers(30, 90)))), x, f"s{i % 3}", 5)
            for i, x in enumerate(["en", "fr"] * 60)]
    rows += [(200, rows[0][1], "en", "s0", 5), (201, rows[0][1] + " tail", "en", "s1", 5),
             (202, f"start {ITEM} end", "en", "s0", 5), (203, None, None, None, None),
             (204, "123 ... 4", None, "s1", 9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(
        f"{at}/benchmark.parquet")
    return at


def test_stages(spark, folder):
    docs = common.table(spark, folder, "documents")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    one = common.written(pipeline.language_id(spark, docs, folder), "one")
    assert ids(one) == [i for i in ids(docs) if i not in (203, 204)]
    two = common.written(pipeline.near_duplicates(spark, one, folder), "two")
    assert set(ids(one)) - set(ids(two)) >= {200} and 0 in ids(two)
    three = common.written(pipeline.decontamination_stage(spark, two, folder), "three")
    assert set(ids(two)) - set(ids(three)) == {202}
    four = common.written(pipeline.mix_sources(spark, three, folder), "four")
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix_documents(three).collect() if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in four.groupBy("doc_id").count().collect()} == taken
    for stage in (one, two, three, four):
        assert tuple(stage.columns) == pipeline.COLUMNS
    last = pipeline.shard(spark, four, folder)
    assert last.count() == four.count()
    sizes = [r["count"] for r in last.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_near_duplicates_threshold(spark, folder):
    """A copy with a passage of an eighth of the text added is a near duplicate; one of a third is not."""
    base = [f"w{i}" for i in range(200)]
    texts = [base, [*base, *[f"n{i}" for i in range(25)]], [*base, *[f"m{i}" for i in range(67)]],
             [*base[:100], *[f"p{i}" for i in range(40)], *base[100:]]]
    docs = spark.createDataFrame(
        [(i, " ".join(t), None, None, None) for i, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.near_duplicates(spark, docs, folder)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]


def test_run_repeats(spark, folder):
    first, second = (sorted(map(tuple, pipeline.run(spark, folder).drop("grown_shard").collect()))
                     for _ in range(2))
    assert first == second


def test_empty_and_repeated(spark, folder):
    docs = common.table(spark, folder, "documents")
    none = docs.limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0
    twice = docs.union(docs.where("doc_id < 4")).withColumn("n_chars", F.lit(None).cast("long"))
    kept = pipeline.near_duplicates(spark, twice, folder)
    assert kept.groupBy("doc_id").count().where("count > 1").count() == 0


def test_large_ids_beside_null(spark, folder):
    """Every stage keeps ids above 2**53 as they are, beside null ids and ids with two texts."""
    big = 2 ** 53 + 1
    docs = common.table(spark, folder, "documents")
    texts = [r["text"] for r in docs.where("doc_id between 10 and 13").orderBy("doc_id").collect()]
    extra = spark.createDataFrame(
        [(big, texts[0], "en", "s0", 5), (big + 2, texts[1], "fr", "s0", 5), (None, texts[2] + " more", "en", "s1", 5),
         (big + 4, f"start {ITEM} end of it", "en", "s0", 5), (big + 6, "a copy: " + texts[3], "fr", "s2", 5),
         (big + 6, " ".join(f"the{x}{y}ing" for x in "klmn" for y in "opqr"), "en", "s2", 5)], docs.schema)
    docs = docs.where("doc_id is null or doc_id not between 10 and 13").unionByName(extra)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    want = {big, big + 2, None, big + 6}
    for _, stage in pipeline.STAGES[:3]:
        docs = common.written(stage(spark, docs, folder), "ids")
        assert want <= ids(docs), stage.__name__
    assert big + 4 not in ids(docs) and docs.where(f"doc_id = {big + 6}").count() == 2
    mixed = common.written(pipeline.mix_sources(spark, docs, folder), "mixed")
    taken = {(r["doc_id"], r["text_key"]): r["copies"] for r in mixing.mix_documents(docs).collect() if r["copies"]}
    got = mixed.groupBy("doc_id", mixing.text_key(F.col("text")).alias("k")).count().collect()
    assert {(r["doc_id"], r["k"]): r["count"] for r in got} == taken
    assert ids(pipeline.shard(spark, mixed, folder)) == ids(mixed)
