"""Size-aware heavy-light join: documents whose shingle sets have a Jaccard similarity of at least
num / den.

Sets that link differ in few elements, at most H = (den - num) / (den + num) of both sizes.

* Small sets (light): each set enumerates its subsets of the sizes that a linked partner must share
  with it; linked sets have a subset in common.
* Large sets (heavy): elements are dealt by hash to more cells than H, so linked sets agree in
  some cell as a whole. Each set stands in the inverted list of each of its cells, for its own
  size class and the next; the lists are scanned for sets that meet. Some cells are spare, so a set
  needs only its fullest cells, one more than can differ and all of their least size: of two linked
  sets, the one with the lower least size has every cell that the other one has and that agrees.
  Cells of few elements, which unrelated sets share, thus need no list.

The boundary is the size with the smallest number of rows to shuffle, from a histogram of sizes. Equal
sets are one class from the start. In each list every set is compared with the one that meets most
others; what links is one component. Two sets of a list can then only link across components if they differ from
the leader in the same elements; those differences, short for near copies, are compared in blocks,
and a block returns links, not pairs. No link between components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import as_id, as_text, free_name, small, written
from airshed.llm.components import components

SHINGLE = 3
NUM, DEN = 9, 10
SPARE = 9  # with this many elements in a cell or more, few cells are spare
LIST_COST = 4  # of a row in an inverted list, which is compared set by set, in rows of subsets
MOST_SMALL = 48  # largest boundary that is considered
BLOCK = 1000  # sets of one leader that a task compares with as many others
IDS = 4_000_000  # lists of ids up to this length are broadcast

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Scrambles 64-bit numbers, one to one."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * salt + 1)) % 2**64)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


@lru_cache(4)
def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, 0xD6E8FEB86659FD93, np.uint64))


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """The set of 64-bit hashes of k words (A-Z lower-cased, split at white space), sorted. A text of
    fewer words is one shingle; a text without words has none."""
    raw = np.frombuffer(b" " + (text or "").encode("utf-8", "replace").lower() + b" ", np.uint8)
    gap = _SPACE[raw]
    start = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    if not len(start):
        return np.zeros(0, np.uint64)
    end = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    at = np.flatnonzero(~gap)
    size = end - start
    place = at - np.repeat(start, size)
    longest = 1 << max(6, int(size.max()).bit_length())
    h = np.add.reduceat((raw[at] + np.uint64(1)) * _powers(longest).take(place),
                        np.cumsum(size) - size)
    h = _mix(h, 1)
    if len(h) < k:
        whole = np.array([len(h)], np.uint64)
        for x in h:
            whole = _mix(whole * np.uint64(3) + x, 2)
        return whole
    total = h[:len(h) - k + 1]
    for i in range(1, k):
        total = _mix(total * np.uint64(3) + h[i:len(h) - k + 1 + i], 2)
    return np.unique(total)


class Plan:
    """How sets of each size are keyed, for a threshold and a boundary."""

    def __init__(self, boundary: int, num: int = NUM, den: int = DEN):
        self.boundary, self.num, self.den = boundary, num, den
        self.top_small = boundary * den // num  # partners of small sets list subsets as well
        self.lows = [boundary + 1]  # smallest size of each class

    def drops(self, s: int) -> int:
        """Most elements of a set of size s that a linked set need not have."""
        least = -(-s * self.num // self.den)
        return s - -(-(s + least) * self.num // (self.num + self.den))

    def size_class(self, s: int) -> int:
        while self.lows[-1] <= s:
            self.lows.append(self.lows[-1] * self.den // self.num + 1)
        return next(i for i in range(len(self.lows) - 1, -1, -1) if self.lows[i] <= s)

    def cells(self, j: int) -> tuple[int, int]:
        """(cells, spare ones) of class j."""
        while len(self.lows) <= j:
            self.lows.append(self.lows[-1] * self.den // self.num + 1)
        top = self.lows[j] * self.den // self.num
        most = 2 * top * (self.den - self.num) // (self.den + self.num)
        spare = 2 + (most // 20 if self.den + self.num >= 2 * SPARE * (self.den - self.num)
                     else most * 3 // 10)
        return most + 1 + spare, spare

    def differ(self, s: int, j: int) -> int:
        """Most elements in which a set of size s and a linked one of at most the top of class j differ."""
        top = self.lows[j] * self.den // self.num
        return (s + min(top, s * self.den // self.num)) * (self.den - self.num) // (
            self.den + self.num)

    def keys(self, x: np.ndarray) -> np.ndarray:
        s, out = len(x), []
        if 0 < s <= self.top_small:
            total = x.sum(dtype=np.uint64)
            for d in range(self.drops(s) + 1):
                gone = (np.array([sum(c) % 2**64 for c in combinations(x.tolist(), d)], np.uint64)
                        if d > 1 else x if d else np.zeros(1, np.uint64))
                out.append(_mix(_mix(total - gone, 3) + np.uint64(s - d), 4))
        if s > self.boundary:
            own = self.size_class(s)
            y = _mix(x, 5)
            for j in (own, own + 1):
                m, _ = self.cells(j)
                cell = (y % np.uint64(m)).astype(np.int64)
                sums = np.zeros(m, np.uint64)
                np.add.at(sums, cell, y)
                filled = np.bincount(cell, minlength=m)
                # full enough: the differ + 1 fullest cells and those of equal size
                which = np.flatnonzero(filled >= np.sort(filled)[m - 1 - self.differ(s, j)])
                out.append(_mix(sums[which] ^ _mix(which.astype(np.uint64)
                                                   + np.uint64(j << 32), 6), 7))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def cost(self, s: int) -> int:
        """Rows that a set of size s adds."""
        rows = 0
        if 0 < s <= self.top_small:
            rows += sum(comb(s, d) for d in range(self.drops(s) + 1))
        if s > self.boundary:
            own = self.size_class(s)
            rows += LIST_COST * (self.cells(own)[0] + self.cells(own + 1)[0])
        return rows


def choose_boundary(histogram: dict[int, int], num: int = NUM, den: int = DEN) -> int:
    """The boundary with the smallest total cost for ``histogram`` (size: number of sets)."""
    return min(range(1, MOST_SMALL + 1), key=lambda b: (
        sum(n * Plan(b, num, den).cost(s) for s, n in histogram.items()), b))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _slices(batches: Iterator[pd.DataFrame], rows: int = 1000) -> Iterator[pd.DataFrame]:
    """The batches in slices: what a task holds besides the batch is a slice's sets or keys."""
    for batch in batches:
        for i in range(0, len(batch), rows):
            yield batch.iloc[i:i + rows]


def _sets(docs: DataFrame, plan: Plan, k: int) -> DataFrame:
    """doc_id, key (hash of the text), n (size of the set), node and check (hashes of the set), keys.
    Keys are given once per set and task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done = set()
        for batch in _slices(batches):
            rows = []
            for doc_id, key, text in zip(batch["doc_id"], batch["key"], batch["text"], strict=True):
                x = shingles(text, k)
                node = int(_signed(_mix(x, 8).sum(dtype=np.uint64, keepdims=True))[0])
                check = int(_signed(_mix(x, 9).sum(dtype=np.uint64, keepdims=True))[0])
                keys = None if node in done else _signed(plan.keys(x))
                done.add(node)
                rows.append((doc_id, key, len(x), node, check, keys))
            yield pd.DataFrame(rows, columns=["doc_id", "key", "n", "node", "check", "keys"])

    return docs.select(as_text("doc_id"), F.xxhash64("text").alias("key"), "text").mapInPandas(
        run, "doc_id string, key long, n long, node long, check long, keys array<long>").select(
        as_id("doc_id"), "key", "n", "node", "check", "keys")


def _contents(docs: DataFrame, k: int) -> DataFrame:
    """node and x, the set as an array, for each row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            sets = [shingles(t, k) for t in batch["text"]]
            yield pd.DataFrame({
                "node": [int(_signed(_mix(x, 8).sum(dtype=np.uint64, keepdims=True))[0])
                         for x in sets], "x": [_signed(x) for x in sets]})

    return docs.select("text").mapInPandas(run, "node long, x array<long>")


def _against_leader(lists: DataFrame, contents: DataFrame, num: int, den: int) -> DataFrame:
    """For each set and each leader of one of its lists: node, leader, n, same (do they link?) and d, the
    elements that only one of them has."""
    pairs = lists.where("node <> leader").select("node", "leader").distinct()
    left = contents.select("node", F.col("x").alias("xa"))
    right = contents.select(F.col("node").alias("leader"), F.col("x").alias("xb"))
    d = F.concat(F.array_except("xa", "xb"), F.array_except("xb", "xa"))
    both = F.size("xa") + F.size("xb")
    return (pairs.join(left, "node").join(right, "leader")
            .select("node", "leader", F.size("xa").alias("n"), both.alias("_both"), d.alias("d"))
            .withColumn("same", (F.col("_both") - F.size("d")) * den
                        >= (F.col("_both") + F.size("d")) * num).drop("_both"))


def _others(met: DataFrame, roots: DataFrame, num: int, den: int) -> DataFrame:
    """Links between sets of one leader that are not in one component yet, one at least for each two
    components that link. Sets differ from each other where their differences to the leader
    differ, so these short arrays decide. Large groups meet in blocks of BLOCK."""
    sizes = met.groupBy("leader").agg(F.count("*").alias("many")).where("many > 1")
    at = roots.select(F.col("node").alias("_r"), "root")
    met = (met.join(sizes, "leader").join(at, F.col("node") == F.col("_r"), "left").drop("_r")
           .withColumn("root", F.coalesce("root", "node")).withColumnRenamed("root", "own")
           .join(at, F.col("leader") == F.col("_r"), "left").drop("_r")
           .withColumn("root", F.coalesce("root", "leader")))
    blocks = F.ceil(F.col("many") / BLOCK)
    block = F.pmod(F.xxhash64("node"), blocks)
    met = written(met.select("leader", "node", "own", "root", "n", "d", blocks.alias("_blocks"),
                             block.alias("_block")), "members")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    left_out = met.where("own <> root").withColumn("i", F.col("_block")).withColumn("j", every)
    anyone = met.withColumn("j", F.col("_block")).withColumn("i", every)
    keys = ["leader", "i", "j"]
    cols = [*keys, "node", "own", "n", "d"]

    def compare(some: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = []
        others = others.set_axis(cols, axis=1)
        if len(some) and len(others):
            some, others = some.sort_values("node"), others.sort_values("node")
            sizes = others["d"].map(len).to_numpy()
            tokens, place = np.unique(np.concatenate([*others["d"], np.zeros(0, np.int64)]),
                                      return_inverse=True)
            order = np.argsort(place, kind="stable")
            holder = np.repeat(np.arange(len(others)), sizes)[order]
            begin = np.searchsorted(place[order], np.arange(len(tokens) + 1))
            nodes, own, n = (others[c].to_numpy() for c in ("node", "own", "n"))
            for node, root, size, d in zip(some["node"], some["own"], some["n"], some["d"],
                                           strict=True):
                at = np.searchsorted(tokens, d)
                at = at[(at < len(tokens)) & (tokens[np.minimum(at, len(tokens) - 1)] == d)] \
                    if len(tokens) else at[:0]
                held = [holder[begin[t]:begin[t + 1]] for t in at]
                common = np.bincount(np.concatenate([*held, np.zeros(0, np.int64)]).astype(np.int64),
                                     minlength=len(others))
                apart = len(d) + sizes - 2 * common
                hit = ((size + n - apart) * den >= (size + n + apart) * num) & (own != root)
                for other in np.unique(own[hit], return_index=True)[1]:  # one per component
                    found.append((node, nodes[hit][other]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    anyone = anyone.select(*[F.col(c).alias(f"{c}_of") for c in cols])
    return (left_out.select(cols).groupBy(*keys)
            .cogroup(anyone.groupBy(*[f"{c}_of" for c in keys]))
            .applyInPandas(compare, "a long, b long"))


def link(docs: DataFrame, num: int = NUM, den: int = DEN, boundary: int | None = None,
         k: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles (of k words), component_id, the
    smallest doc_id that links reach. Texts without words link with nothing. Sets stand for themselves as sums of
    64-bit hashes; a candidate pair links only after its sets have been compared."""
    return _linked(docs, num, den, boundary, k).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _linked(docs: DataFrame, num: int, den: int, boundary: int | None, k: int) -> DataFrame:
    """doc_id, key (hash of the text), n, component (a number of its own; null without words) and
    component_id of each row."""
    docs = docs.select("doc_id", "text")
    if boundary is None:
        words = F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
        sizes = (docs.where(F.length("text") <= 40 * MOST_SMALL)  # longer texts are large sets
                 .groupBy(F.greatest(words - (k - 1), F.lit(1)).alias("s")).count()
                 .where(F.col("s") <= 2 * MOST_SMALL).collect())
        boundary = choose_boundary({r["s"]: r["count"] for r in sizes}, num, den)
    sets = written(_sets(docs, Plan(boundary, num, den), k), "sets")
    full = sets.where("n > 0")
    classes = full.groupBy("node", "check", "n").agg(F.min("doc_id").alias("first"),
                                                     F.min("key").alias("key"))

    by_key = Window.partitionBy("key")
    lists = (full.where(F.col("keys").isNotNull())
             .select("node", "n", F.explode("keys").alias("key"))
             .withColumn("_low", F.min("node").over(by_key))
             .withColumn("_top", F.max("node").over(by_key))
             .where("_low <> _top").select("key", "node", "n").distinct())
    lists = written(lists, "lists")
    # The leader of a list is its set with the most company in all lists: of near copies, the one that
    # the others were made from.
    company = (lists.join(lists.groupBy("key").agg(F.count("*").alias("many")), "key")
               .groupBy("node").agg(F.sum("many").alias("company")))
    lists = lists.join(company, "node")
    leaders = lists.groupBy("key").agg(F.max(F.struct("company", "node"))["node"].alias("leader"))
    lists = written(lists.join(leaders, "key").drop("company"), "led")

    # A text of each set, found by its hash: ids can be null. Other texts of that hash do no harm.
    texts = small(classes.join(lists.select("node").distinct(), "node", "left_semi")
                  .select(F.col("key").alias("_key")).distinct(), IDS)
    contents = written(_contents(docs.join(texts, F.xxhash64("text") == F.col("_key"), "left_semi"), k)
                       .dropDuplicates(["node"]), "contents")

    met = written(_against_leader(lists, contents, num, den), "met")
    links = met.where("same").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    roots = components(links)
    more = written(_others(met, roots, num, den), "more")
    if more.head(1):
        roots = components(links.union(more))

    roots = written(roots, "roots")
    whole = (classes.join(roots, "node").groupBy("root")
             .agg(F.min("first").alias("component_id")))
    member = (roots.join(whole, "root").select("node", "root", "component_id"))
    alone = classes.groupBy("node", "check", "n").agg(F.min("first").alias("first"))
    at = (alone.join(member, "node", "left")
          .select("node", "check", F.coalesce("root", "node").alias("component"),
                  F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("component_id"))
                  .alias("component_id")))
    out = sets.join(at, ["node", "check"], "left")
    return out.select("doc_id", "key", "n", F.when(F.col("n") > 0, F.col("component")).alias("component"),
                      "component_id")


def keep_one(docs: DataFrame, num: int = NUM, den: int = DEN, k: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id (null last), of equal ids that
    with the smallest hash of its text, of equal rows any one. A row goes by its id and text together, so
    an id that occurs with two texts loses only the one that is a copy. Rows without words stay."""
    found = written(_linked(docs, num, den, None, k).where("component is not null")
                    .select("doc_id", "key", "component"), "components")
    row = F.xxhash64("doc_id", "key")
    best = found.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("best"))
    best = best.select("component", F.xxhash64("best.doc_id", "best.key").alias("_best"))
    gone = written(found.withColumn("_row", row).join(best, "component")
                   .where(F.col("_row") != F.col("_best")).select("_row").distinct(), "gone")
    own, gone_row, repeated = (free_name(docs, x) for x in ("_own", "_gone", "_repeated"))
    marked = docs.select("*", F.xxhash64("doc_id", F.xxhash64("text")).alias(own))
    gone = small(gone.select(F.col("_row").alias(gone_row)), IDS)
    kept = marked.join(gone, F.col(own) == F.col(gone_row), "left_anti")
    # rows that repeat a kept row, id and text, are one document
    twice = written(found.groupBy(row.alias(repeated)).count().where("count > 1").select(repeated), "twice")
    if not twice.head(1):
        return kept.select(docs.columns)
    twice, same = small(twice, IDS), F.col(own) == F.col(repeated)
    again = kept.join(twice, same, "left_semi").dropDuplicates([own])
    return kept.join(twice, same, "left_anti").select(docs.columns).unionByName(again.select(docs.columns))
