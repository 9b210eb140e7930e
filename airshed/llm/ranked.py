"""Ranked lexical search by a document FP-tree with branch and bound.

Documents are restricted to the items' terms. In blocks, their terms are ordered by falling document
frequency, so that documents with the same frequent terms share paths of a trie. Every subtree knows the
largest tf of each term and the smallest length factor m in it; a score grows with tf and falls with m, so
these bound all scores below. Per item the trie is walked depth first, best bound first, and subtrees whose
bound is under the item's worst kept score are left out. The best of each task are merged by Spark.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.llm.common import words, written

BEST = 50
BLOCK_DOCS, BLOCK_ENTRIES = 8192, 1_000_000  # of one trie: whichever comes first
LEAF = 48  # documents that are scored together
PASS_TERMS = 40_000  # terms of the items that are searched in one pass
SEEDS = 64  # one document of so many gives first thresholds
SALTS = 256  # groups in which the tasks' results of an item are merged first

#: ASCII that is no letter or digit separates; A-Z become lower case; other bytes stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32
               for c in range(256))


def tokens(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


class Trie:
    """A block of documents as a trie, in arrays. ``at`` bounds the documents' entries in ``term`` (ranks
    by falling frequency, rising within a document) and ``tf``; ``m`` and ``ids`` are by document."""

    def __init__(self, at, term, tf, m, n_terms: int):
        keys = term.astype(">u4").tobytes()
        sizes = np.diff(at)
        order = np.array(sorted(range(len(m)), key=lambda d: keys[4 * at[d]:4 * at[d + 1]]), np.int64)
        self.order = order
        self.at = np.r_[0, np.cumsum(sizes[order])]
        pick = np.arange(self.at[-1]) + np.repeat(at[:-1][order] - self.at[:-1], sizes[order])
        self.term, self.m = term[pick], m[order]
        tf = tf[pick].astype(np.int64)
        # of a document's score, all but the term's weight
        self.part = 1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(self.m, sizes[order]))
        self.spans: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self._grow(0, len(m), 0)
        # leaves first: maxima of their entries; then every node's from its children's
        self.most = np.zeros((len(self.spans), n_terms), np.int64)
        self.least = np.array([self.m[lo:hi].min() if hi > lo else 1 << 40 for lo, hi in self.spans])
        leaf_of = np.zeros(len(m), np.int64)
        for node, (lo, hi) in enumerate(self.spans):
            if not self.children[node]:
                leaf_of[lo:hi] = node
        np.maximum.at(self.most, (np.repeat(leaf_of, sizes[order]), self.term), tf)
        for node in range(len(self.spans) - 1, -1, -1):
            if self.children[node]:
                self.most[node] = self.most[self.children[node]].max(axis=0)

    def _grow(self, lo: int, hi: int, depth: int) -> None:
        """Makes the node of documents lo..hi, which share their first ``depth`` terms. Parents come before
        their children. A stack, as paths can be long."""
        todo = [(lo, hi, depth, -1)]
        while todo:
            lo, hi, depth, parent = todo.pop()
            node = len(self.spans)
            self.spans.append((lo, hi))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if hi - lo <= LEAF:
                continue
            first, last = self._path(lo)[depth:], self._path(hi - 1)[depth:]
            n = min(len(first), len(last))
            differ = np.flatnonzero(first[:n] != last[:n])
            depth += int(differ[0]) if len(differ) else n  # sorted: the whole range shares that far
            here = self.at[lo:hi] + depth
            there = here < self.at[lo + 1:hi + 1]
            nxt = np.where(there, self.term[np.minimum(here, len(self.term) - 1)].astype(np.int64), -1) \
                if len(self.term) else np.full(hi - lo, -1)
            cuts = np.r_[0, np.flatnonzero(nxt[1:] != nxt[:-1]) + 1, hi - lo] + lo
            if len(cuts) == 2:  # equal vectors: split in halves, which are leaves at last
                middle = (lo + hi) // 2
                todo += [(lo, middle, depth, node), (middle, hi, depth, node)]
                continue
            start = int(cuts[0])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if b - a > LEAF:  # a child of its own; the small ones before it are one leaf
                    if a > start:
                        todo.append((start, a, depth, node))
                    todo.append((a, b, depth, node))
                    start = b
                elif b - start > LEAF:
                    todo.append((start, a, depth, node))
                    start = a
            if hi > start:
                todo.append((start, hi, depth, node))

    def _path(self, doc: int) -> np.ndarray:
        return self.term[self.at[doc]:self.at[doc + 1]]

    def search(self, ranks: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: Best,
               ids, absent) -> int:
        """Adds the block's documents to ``best``; ``dense`` holds the weights by rank. Returns the number
        of scored documents."""
        def bounds(nodes: list[int]) -> np.ndarray:
            tf = self.most[nodes][:, ranks]
            low = self.least[nodes]
            return (weights * (1_000_000_000 * tf // (1000 * tf + 20 * low[:, None]))).sum(axis=1)

        scored, stack = 0, [(int(bounds([0])[0]), 0)]
        while stack:
            bound, node = stack.pop()
            if bound < best.least or not bound:
                continue
            if self.children[node]:
                below = sorted(zip(bounds(self.children[node]).tolist(), self.children[node], strict=True))
                stack += below  # the best bound is walked first
                continue
            lo, hi = self.spans[node]
            a, b = self.at[lo], self.at[hi]
            total = np.r_[0, np.cumsum(dense[self.term[a:b]] * self.part[a:b])]
            score = total[self.at[lo + 1:hi + 1] - a] - total[self.at[lo:hi] - a]
            scored += hi - lo
            good = np.flatnonzero(score >= max(best.least, 1))
            if len(good):
                docs = self.order[lo + good]
                best.add(score[good], ids[docs], absent[docs])
        return scored


class Best:
    """The ``size`` best of one item: by falling score, then rising id, null ids last."""

    def __init__(self, size: int, least: int):
        self.size, self.least = size, least
        self.score = np.empty(0, np.int64)
        self.ids, self.absent = np.empty(0, np.int64), np.empty(0, bool)

    def add(self, score, ids, absent) -> None:
        score, ids, absent = (np.r_[a, b] for a, b in zip(
            (self.score, self.ids, self.absent), (score, ids, absent), strict=True))
        order = np.lexsort((ids, absent, -score))[:self.size]
        self.score, self.ids, self.absent = score[order], ids[order], absent[order]
        if len(order) == self.size:
            self.least = max(self.least, int(self.score[-1]))


def _vectors(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), term (numbers of those in ``terms``) and tf of each text that has a
    term."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows, n, term, tf = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found = tokens(text) if text else []
                if found:
                    counts = Counter(map(known.get, found))
                    counts.pop(None, None)
                    rows.append(i)
                    n.append(len(found))
                    term.append(list(counts))
                    tf.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                 pa.array(term, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32()))],
                names=["doc_id", "n", "term", "tf"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, term array<int>, tf array<int>")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """ids, absent, n, sizes, term, tf of the documents of a block."""
    held, docs, entries = [], 0, 0
    for batch in batches:
        for a in range(0, batch.num_rows, 1024):
            part = batch.slice(a, 1024)
            ids, n, term, tf = part.columns
            held.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                         n.to_numpy(), term.value_lengths().to_numpy(), term.flatten().to_numpy(),
                         tf.flatten().to_numpy()))
            docs += part.num_rows
            entries += len(held[-1][4])
            if docs >= BLOCK_DOCS or entries >= BLOCK_ENTRIES:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, docs, entries = [], 0, 0
    if docs:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _search(vectors: DataFrame, queries, n_docs: int, n_words: int, best: int) -> DataFrame:
    """The ``best`` of every task: item (its number), task, doc_id, score. ``queries`` is a broadcast of
    (rank by frequency and weight of every term, terms of each item, first threshold of each item)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, weight, items, least = queries.value
        tops = [Best(best, x) for x in least]
        by_rank = np.empty_like(weight)
        by_rank[rank] = weight
        dense = np.zeros_like(weight)
        for ids, absent, n, sizes, term, tf in _blocks(batches):
            at = np.r_[0, np.cumsum(sizes)]
            ranks = rank[term]
            order = np.lexsort((ranks, np.repeat(np.arange(len(sizes)), sizes)))
            trie = Trie(at, ranks[order], tf[order], 50 + 50 * n * n_docs // n_words, len(weight))
            for own, top in zip(items, tops, strict=True):
                dense[own] = by_rank[own]
                trie.search(own, by_rank[own], dense, top, ids, absent)
                dense[own] = 0
        for i, top in enumerate(tops):
            if len(top.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top.score), i, np.int32)),
                     pa.array(top.ids, mask=top.absent), pa.array(top.score)],
                    names=["item", "doc_id", "score"])

    return vectors.mapInArrow(run, "item int, doc_id long, score long").select(
        "item", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("task"), "doc_id", "score")


def _merged(found: DataFrame, best: int) -> DataFrame:
    """The ``best`` of each item, ranked: first within groups of tasks, so that no window holds the
    results of all tasks."""
    by = [F.desc("score"), F.asc_nulls_last("doc_id")]
    rank = F.row_number()
    some = found.withColumn("rank", rank.over(Window.partitionBy("item", "task").orderBy(*by)))
    return (some.where(F.col("rank") <= best)
            .withColumn("rank", rank.over(Window.partitionBy("item").orderBy(*by)))
            .where(F.col("rank") <= best).select("item", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """The ``best`` highest-scoring rows of ``docs`` (doc_id, text) for each item of ``items`` (item_id,
    text): item_id, rank (from 1), doc_id, score; scores above 0 only.

    Ties go by doc_id, null ids last; repeated rows of ``docs`` are ranked each. Rows of ``items`` with one
    item_id are one item, that of all their terms (a null item_id is an id). Null and empty texts have no
    term: as documents they count nowhere, as items they have no rows. Texts of any length are read whole.
    Other columns, whatever their names, are not read. Results do not depend on partitions or blocks.
    """
    spark = docs.sparkSession
    item_terms = written(items.select("item_id", F.explode(words(F.col("text"))).alias("term"))
                         .distinct(), "items")
    passes = -(-item_terms.count() // PASS_TERMS)
    out = [_one_pass(spark, docs, item_terms.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == i),
                     best) for i in range(passes)]
    if not out:
        return item_terms.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                                 F.lit(0).cast("long").alias("score"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _one_pass(spark: SparkSession, docs: DataFrame, item_terms: DataFrame, best: int) -> DataFrame:
    # about PASS_TERMS rows: the items are dealt to passes by their number of terms
    rows = item_terms.collect()
    terms = {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
    of_item: dict = {}
    for r in rows:
        of_item.setdefault(r["item_id"], []).append(terms[r["term"]])
    names = list(of_item)
    vectors = written(_vectors(docs, {t.encode(): i for t, i in terms.items()}), "vectors")
    n_docs, n_words = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(terms), np.int64)
    for r in vectors.select(F.explode("term").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]  # at most one row for each of the pass's terms
    rank = np.empty(len(terms), np.int64)
    rank[np.lexsort((np.arange(len(terms)), -df))] = np.arange(len(terms))
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    own = [np.sort(rank[t]) for t in of_item.values()]

    def queries(least: list[int]):
        return spark.sparkContext.broadcast((rank, weight, own, least))

    # What some documents reach is a threshold that the whole search need not go below.
    seeds = vectors.where(F.pmod(F.xxhash64("doc_id"), F.lit(SEEDS)) == 0)
    least = [0] * len(names)
    first = _merged(_search(seeds, queries(least), n_docs, n_words, best), best)
    for r in first.where(F.col("rank") == best).collect():  # at most one row an item
        least[r["item"]] = r["score"]
    found = _merged(_search(vectors, queries(least), n_docs, n_words, best), best)
    kind = item_terms.schema["item_id"].dataType.simpleString()
    ids = spark.createDataFrame(list(enumerate(names)), f"item int, item_id {kind}")
    return found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
