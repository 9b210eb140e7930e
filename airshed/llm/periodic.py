"""Periodic runs: stretches of words that repeat with a period, found by descending-LCP Kruskal.

The suffixes of a batch of texts are sorted; neighbours in that order are united by decreasing length of
their common prefix (LCP). Each class keeps its positions in text order. When two classes are united at
LCP l, a pair of positions that is now adjacent, lies d <= l apart and stems from both classes has the
common prefix l exactly: the text repeats with period d from the first of them to d + l words later. No
position of the class lies between, so d is the smallest period. Seeds of one run share its period and its
end, and the run's first word is the least of them: no extension step is needed.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 12  # words of a run
CHUNK = 250_000  # words whose suffixes are sorted together (a longer text stands alone)
SMALL = 24  # positions that are inserted singly
RUNS = "array<struct<start:long,length:long,period:long>>"


def _classes(ids: np.ndarray) -> list[np.ndarray]:
    """Per k, the class of each position by its 2**k words, as the number of smaller positions. Classes of
    one position stay as they are, so only ties are sorted again; at last all positions differ."""
    counts = np.bincount(ids)
    rank = (np.cumsum(counts) - counts)[ids].astype(np.int32)
    tied = np.flatnonzero(counts[ids] > 1)
    levels, step = [rank], 1
    while len(tied):
        old = rank[tied].astype(np.int64)
        key = old * len(ids) + rank[tied + step]
        order = np.argsort(key, kind="stable")
        tied, old, key = tied[order], old[order], key[order]
        here = np.arange(len(tied))
        new = np.r_[True, key[1:] != key[:-1]]
        first = np.maximum.accumulate(np.where(new, here, 0))
        group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], here, 0))
        rank = rank.copy()
        rank[tied] = old + first - group
        levels.append(rank)
        alone = new & np.r_[new[1:], True]
        tied = tied[~alone]
        step *= 2
    return levels


def _neighbours(levels: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in suffix order and the LCP of each with the next; only those whose 2**k <= least first
    words occur twice, and 0 where the LCP is below least."""
    k = min(least.bit_length() - 1, len(levels) - 1)
    at = np.flatnonzero(np.bincount(levels[k])[levels[k]] > 1)
    at = at[np.argsort(levels[-1][at], kind="stable")]
    a, b = at[:-1], at[1:]
    lcp = np.zeros(len(a), np.int64)
    for i in range(len(levels) - 1, -1, -1):
        lcp += (levels[i][a + lcp] == levels[i][b + lcp]).astype(np.int64) << i
    return at, np.where(lcp >= least, lcp, 0)


def runs(ids: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) by start, then period, of the maximal runs of at least ``least`` and
    two periods' words. ``ids`` are codes from 0; the last code must be unique (texts of a batch each end
    in a code of their own, so that no run crosses them)."""
    if len(ids) < 3:
        return np.empty((0, 3), np.int64)
    # the first seed of such a run has an LCP of at least half its length
    at, lcp = _neighbours(_classes(ids), max(1, (least + 1) // 2))
    order = np.argsort(-lcp, kind="stable")
    order = order[lcp[order] > 0]
    root = list(range(len(at)))
    kept: list[list[int]] = [[p] for p in at.tolist()]
    found: dict[tuple[int, int], int] = {}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    def seed(p: int, q: int, level: int) -> None:
        if q - p <= level:
            key = q - p, q + level
            if found.get(key, q) > p:
                found[key] = p

    for i, level in zip(order.tolist(), lcp[order].tolist(), strict=True):
        x, y = find(i), find(i + 1)
        if len(kept[x]) < len(kept[y]):
            x, y = y, x
        big, few = kept[x], kept[y]
        root[y], kept[y] = x, []
        spots = [bisect(big, p) for p in few]
        last = len(few) - 1
        for j, (p, spot) in enumerate(zip(few, spots, strict=True)):
            if spot and (not j or spots[j - 1] < spot):
                seed(big[spot - 1], p, level)
            if spot < len(big) and (j == last or spots[j + 1] > spot):
                seed(p, big[spot], level)
        if last < SMALL:
            for j in range(last, -1, -1):
                big.insert(spots[j], few[j])
        else:
            big += few
            big.sort()  # two sorted stretches: a merge
    out = [(s, e - s, d) for (d, e), s in found.items() if e - s >= least]
    return np.array(sorted(out, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _chunks(texts: list[str | None]) -> Iterator[list[list[bytes]]]:
    """The words (between ASCII white space) of texts, some CHUNK words together."""
    chunk, size = [], 0
    for text in texts:
        words = (text or "").encode().split()
        if chunk and size + len(words) > CHUNK:
            yield chunk
            chunk, size = [], 0
        chunk.append(words)
        size += len(words) + 1
    yield chunk


def _collapsed(chunk: list[list[bytes]], least: int) -> Iterator[tuple[list[dict], str]]:
    """Per text its runs and the words that stay."""
    codes: dict[bytes, int] = {}
    ids = [codes.setdefault(w, len(codes)) for words in chunk for w in words]
    sizes = np.array([len(words) for words in chunk])
    first = np.cumsum(sizes + 1) - sizes - 1
    all_ids = np.empty(len(ids) + len(chunk), np.int64)
    ends = first + sizes
    all_ids[ends] = len(codes) + np.arange(len(chunk))
    inside = np.ones(len(all_ids), bool)
    inside[ends] = False
    all_ids[inside] = ids
    found = runs(all_ids, least)
    # a word goes if a run holds it after its first period
    steps = np.zeros(len(all_ids) + 1, np.int64)
    np.add.at(steps, found[:, 0] + found[:, 2], 1)
    np.add.at(steps, found[:, 0] + found[:, 1], -1)
    stays = np.cumsum(steps) == 0
    cuts = np.searchsorted(found[:, 0], np.r_[first, len(all_ids)])
    for i, words in enumerate(chunk):
        own = found[cuts[i]:cuts[i + 1]]
        if not len(own):
            yield [], b" ".join(words).decode()
            continue
        rows = [{"start": s - int(first[i]), "length": n, "period": p} for s, n, p in own.tolist()]
        yield rows, b" ".join(compress(words, stays[first[i]:ends[i]].tolist())).decode()


def find_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), least: int = LEAST,
              text: str = "text") -> DataFrame:
    """Per row of ``docs``: the columns ``keep`` as they are, ``runs`` (start in words, length, period, by
    start, then period) and ``collapsed`` (the words outside runs and those of each run's first period,
    joined by one space).

    A null, empty or blank text has no runs and collapses to "". Repeated rows are returned as often, with
    equal results. A text of any length is sorted whole in its task: memory is about 4 bytes a word for
    each doubling up to its longest repeat. Other columns, whatever their names, are not read.
    """
    # internal names, so that no kept column can clash with the text's
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                         F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for batch in batches:
            at = 0
            for chunk in _chunks(batch.column(len(keep)).to_pylist()):
                out = list(_collapsed(chunk, least))
                part = batch.slice(at, len(chunk))
                at += len(chunk)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([r for r, _ in out], kind),
                     pa.array([s for _, s in out], pa.string())],
                    names=[*(f"k{i}" for i in range(len(keep))), "runs", "collapsed"])

    schema = ", ".join([*(f"k{i} {source.schema[i].dataType.simpleString()}" for i in range(len(keep))),
                        f"runs {RUNS}", "collapsed string"])
    return source.mapInArrow(run, schema).select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "runs", "collapsed")


def with_tail_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``documents``, where every tenth text (by the checksum of its id) is given a
    periodic tail from word a on, with period p. Texts without id or words stay as they are."""
    check = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(check % 10 == 0, F.lit(False))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    docs = docs.select("doc_id", "text", F.floor(check / 10).alias("g"),
                       F.when(chosen, words).alias("w"))
    docs = docs.withColumn("n", F.size("w")).withColumn(
        "a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    left = F.col("n") - F.col("a")
    docs = docs.withColumn("p", (1 + F.floor(left / (3 + F.col("g") % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")),
                                    F.ceil(left / F.col("p")).cast("int")))
    made = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), left)), " ")
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text"))
                       .alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the longest run (ties: first start, then
    least period), runs_sha256 and collapsed_sha256 of the result of ``find_runs``."""
    line: Column = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))),
        F.lit("\n"))), "")
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return (found.select("doc_id", "runs", "collapsed", top.alias("top")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.p")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.p")).cast("long").alias("exponent_milli"),
        sha(line).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256")))
