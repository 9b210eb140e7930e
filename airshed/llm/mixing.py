"""Mixing sources to target weights by the cube method.

Each source gets a target number of words; a document of the source is wanted ``target /
source_size`` times. The whole part of that is taken outright. The fraction is an inclusion
probability, and the cube method turns the probabilities into 0 or 1: it moves them along directions
in the null space of the balancing constraints (words and documents of the source), so that both
totals stay where they are, until every one but a few has reached a border. This flight runs over
blocks of bounded size in parallel; what each block leaves open (at most two documents) flies on
together with the block's KEEP smallest, until one block per source is left: the landing. There
the document total is let go first, then the last one is rounded, and single documents are turned
where that brings the words nearer to the target.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import small, written

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
BLOCK = 8192
KEEP = 24  # the smallest documents of a block fly with the landing
MAX_SOURCES = 1_000_000  # more sources than this are joined by a shuffle
_EPS = 1e-9


def _step(p: list[float], at: list[int], u: list[float], rng) -> None:
    """Moves p[at] along u to a border of the cube, up or down, so that the mean stays."""
    up = down = float("inf")
    for i, d in zip(at, u, strict=True):
        if d:
            up = min(up, (1 - p[i]) / d if d > 0 else -p[i] / d)
            down = min(down, p[i] / d if d > 0 else (p[i] - 1) / d)
    by = up if rng.random() * (up + down) < down else -down
    for i, d in zip(at, u, strict=True):
        x = p[i] + by * d
        p[i] = 0.0 if x < _EPS else 1.0 if x > 1 - _EPS else x


def _open(p: list[float], at: list[int]) -> list[int]:
    return [i for i in at if 0.0 < p[i] < 1.0]


def fly(p: list[float], size: list[float], rng, land: bool = False) -> list[float]:
    """Flight over all units in order, three at a time; at most two units stay open, of different
    size. With ``land`` none does."""
    at: list[int] = []
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        at.append(i)
        while len(at) >= 3 or len(at) == 2 and size[at[0]] == size[at[1]]:
            if len(at) == 2:
                u = [1.0, -1.0]
            else:
                a, b, c = (size[j] for j in at)
                u = [b - c, c - a, a - b] if a != b or b != c else [1.0, -1.0, 0.0]
            _step(p, at, u, rng)
            at = _open(p, at)
    if land:
        if len(at) == 2:
            scale = max(size[at[0]], size[at[1]])
            _step(p, at, [size[at[1]] / scale, -size[at[0]] / scale], rng)
            at = _open(p, at)
        for i in at:
            p[i] = float(p[i] >= 0.5)
    return p


def settle(p: list[float], size: list[float], off: float) -> list[float]:
    """Turns units, large ones first, where that brings the taken words (``off`` too few) nearer to
    the target."""
    for i in sorted(range(len(p)), key=lambda i: -size[i]):
        by = size[i] if p[i] == 0.0 else -size[i]
        if abs(off - by) < abs(off):
            p[i], off = 1.0 - p[i], off - by
    return p


def _flight(land: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # large documents first: those left open at the end are small
        pdf = pdf.sort_values(["size", "_tie", "_id"], ascending=[False, True, True],
                              kind="stable", na_position="last")
        rng = np.random.default_rng([int(pdf["_seed"].iloc[0]) & 0x7FFFFFFF, len(pdf)])
        p, size = pdf["_p"].tolist(), pdf["size"].astype(float).tolist()
        if land:
            wanted = float(np.dot(p, size))
            p = fly(p, size, rng, True)
            return pdf.assign(_p=settle(p, size, wanted - float(np.dot(p, size))))
        kept = len(p) - KEEP if len(p) > KEEP else 0
        return pdf.assign(_p=fly(p[:kept], size[:kept], rng) + p[kept:])
    return run


def source_targets(sizes: DataFrame, source: str, size: str, weights=WEIGHTS,
                   cap: float = CAP) -> DataFrame:
    """Adds ``target`` to one row per source: the total size shared by weight (weights repeat in
    code point order, null last), no source above ``cap`` times its size, the excess shared again
    by weight. Sources fill up in the order of cap * size / weight; those that do not fill up get
    ``level * weight``."""
    order = Window.orderBy(F.col(source).asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    fill = Window.orderBy("_full", F.col(source).asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    rest = F.sum(size).over(every) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))
    return (sizes.withColumn("_w", w).withColumn("_most", cap * F.col(size).cast("double"))
            .withColumn("_full", F.col("_most") / F.col("_w"))
            .withColumn("_level", rest / F.sum("_w").over(after))
            .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_full"),
                                               F.col("_level"))).over(every))
            .withColumn("target", F.least("_most", F.coalesce(F.col("_level") * F.col("_w"),
                                                              "_most")))
            .drop("_w", "_most", "_full", "_level"))


def mix(df: DataFrame, ident: Column, tie: Column, source: Column, size: Column, weights=WEIGHTS,
        cap: float = CAP, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """One row per row of ``df``: _id, _tie, source, size, source_size, target, copies (how often the
    mix takes the row).

    ``size`` is a whole number of at least 0; rows of size 0 cannot add to a target and are taken
    like others of their source. A null source is a source. Equal rows count one by one. The
    result depends on the rows alone, not on their order or partitioning.
    """
    # the flights are Python: an id travels as text (see common.as_text)
    kind = df.select(ident.alias("_id")).schema["_id"].dataType
    rows = df.select(ident.cast("string").alias("_id"), tie.alias("_tie"), source.alias("source"),
                     size.cast("long").alias("size"))
    own = F.col("_id").cast(kind)
    stats = rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count("*").alias("_rows"))
    stats = written(source_targets(stats, "source", "source_size", weights, cap), "targets")
    stats = small(stats.withColumnRenamed("source", "_source"), MAX_SOURCES)
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place = F.xxhash64(F.lit(seed), own, "_tie", "size")
    rows = (rows.join(stats, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
            .withColumn("_whole", F.floor(wanted + _EPS).cast("int"))
            .withColumn("_p", F.greatest(wanted - F.col("_whole"), F.lit(0.0)))
            .withColumn("_p", F.when(F.col("_p") < _EPS, 0.0).otherwise(F.col("_p")))
            .withColumn("_blocks", F.ceil(F.col("_rows") / block).cast("long"))
            .withColumn("_block", F.pmod(place, F.greatest("_blocks", F.lit(1).cast("long"))))
            .drop("_rows", "_blocks")
            .withColumn("_seed", F.xxhash64(F.lit(seed), "source", "_block")))
    level, done, still = 0, [], rows
    while True:
        last = level > 0 and not still.groupBy("source").count().where(F.col("count") > block).head(1)
        flown = (still.groupBy("source", "_block")
                 .applyInPandas(_flight(last), still.schema))
        flown = written(flown, f"flight{level}")
        if last:
            done.append(flown)
            break
        is_open = (F.col("_p") > 0) & (F.col("_p") < 1)
        done.append(flown.where(~is_open))
        level += 1
        # open documents of about block / 4 former blocks fly on together
        many = flown.where(is_open).groupBy("source").count()
        many = small(many.withColumnRenamed("source", "_source"), MAX_SOURCES)
        still = (flown.where(is_open)
                 .join(many, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
                 .withColumn("_block", F.when(F.col("count") <= block, F.lit(0).cast("long"))
                             .otherwise(F.pmod(F.xxhash64(F.lit(seed + level), own, "_tie"),
                                               F.ceil(F.col("count") * 2 / block).cast("long"))))
                 .drop("count")
                 .withColumn("_seed", F.xxhash64(F.lit(seed + level), "source", "_block")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(own.alias("_id"), "_tie", "source", "size", "source_size", "target",
                      (F.col("_whole") + F.col("_p").cast("int")).alias("copies"))


def word_count(text: Column) -> Column:
    """Number of runs of anything but white space; 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")), F.lit(0))


def text_key(text: Column) -> Column:
    return F.coalesce(F.md5(text.cast("binary")), F.lit(""))


def mix_documents(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The mix of ``documents``: doc_id, size (words), source_size, target, taken (words the mix
    takes, repeats counted), copies, source, text_key. Null texts have no words."""
    mixed = mix(docs, F.col("doc_id"), text_key(F.col("text")), F.col("source"),
                word_count(F.col("text")), seed=seed)
    return mixed.select(F.col("_id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies",
                        "source", F.col("_tie").alias("text_key"))
