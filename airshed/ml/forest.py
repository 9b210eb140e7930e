"""Random forest whose trees and nodes stay distributed (ML5).

Trees are grown from the top: while a node holds more rows than ``LOCAL_ROWS``, its split is found from
histograms that every task sums over its own rows. The rows of a smaller node are shuffled to one task, which
grows the rest of that branch. Branches are rows of a Parquet table in the shared checkpoint folder; no task and
no driver holds the forest. The driver sees the upper nodes only, about trees * rows / LOCAL_ROWS of them.

The settings are MLlib's: variance impurity, at most 32 bins a feature, every feature tried at every split, each
tree on Poisson draws of the rows. A draw depends on the row's hash and the tree, not on the partition layout.
"""

from __future__ import annotations

import json
import math
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.ml import native
from airshed.session import checkpoint_dir, scratch_path

LOCAL_ROWS = 1_000_000  # a branch is grown by one task if its node drew no more rows
OPEN_NODES = 1_024    # nodes whose histograms one pass sums; a task holds and sends 9 kB for each
BLOCK_ROWS = 4_096    # rows whose scores meet again in one group, 12 B for each tree
BATCH_BYTES = 2**21   # what a task passes on to the shuffle at once
MAX_BINS = 32
LEAF, BRANCH = -1, -2
#: A node: feature tried (or LEAF; in an upper tree, BRANCH), last bin that goes left, left child (the right
#: one follows it), mean of the target.
NODE = np.dtype([("feature", "i1"), ("cut", "u1"), ("left", "<i4"), ("value", "<f8")])
PARTS = "tree int, part int, nodes binary, gains array<double>"


# ------------------------------------------------------------------ rows, draws, bins
def thresholds(df: DataFrame, features) -> list[list[float]]:
    """Per feature the values that separate its bins: midpoints of neighbouring values if there are at most
    32, else 31 quantiles."""
    shares = [i / MAX_BINS for i in range(1, MAX_BINS)]
    found = df.agg(*[F.percentile_approx(f, shares, 10_000).alias(f"q_{f}") for f in features],
                   *[F.approx_count_distinct(f).alias(f"n_{f}") for f in features]).first()
    few = [f for f in features if found[f"n_{f}"] <= 2 * MAX_BINS]
    values = df.agg(*[F.array_sort(F.collect_set(f)).alias(f) for f in few]).first() if few else {}
    out = []
    for f in features:
        v = values[f] if f in few else []
        if 0 < len(v) <= MAX_BINS:
            out.append([(a + b) / 2 for a, b in zip(v, v[1:])])
        else:
            out.append(sorted(set(found[f"q_{f}"] or [])))
    return out


def binned(batch: pa.RecordBatch, features, cuts) -> np.ndarray:
    """The bins of a batch's rows, a line for each feature."""
    out = np.empty((len(features), batch.num_rows), np.uint8)
    for i, (f, c) in enumerate(zip(features, cuts)):
        x = batch.column(f).to_numpy(zero_copy_only=False).astype(float)
        if np.isnan(x).any():
            raise ValueError(f"feature {f} has a null or NaN")
        out[i] = np.searchsorted(c, x)
    return out


def drawn(keys: np.ndarray, tree: int, seed: int, rate: float | None) -> np.ndarray:
    """How often a tree draws each row: Poisson of the rate (None: every row once), from a hash of row and tree."""
    if rate is None:
        return np.ones(len(keys), np.uint8)
    z = keys.view(np.uint64) + np.uint64(_add(tree, seed))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53
    return np.searchsorted(_chances(rate), u, side="right").astype(np.uint8)


def _add(tree: int, seed: int) -> int:
    return ((seed + 1) * 0xD1342543DE82EF95 + (tree + 1) * 0x9E3779B97F4A7C15) % 2**64


def _chances(rate: float | None) -> np.ndarray:
    """The cumulated chances of 0, 1, 2 ... draws."""
    return np.cumsum([math.exp(-rate) * rate**k / math.factorial(k) for k in range(0 if rate is None else 40)])


def walked(nodes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The node in which each row ends."""
    at = np.zeros(bins.shape[1], np.int32)
    rows = np.arange(bins.shape[1])
    while len(rows):
        n = nodes[at[rows]]
        inner = n["feature"] >= 0
        rows, n = rows[inner], n[inner]
        at[rows] = n["left"] + (bins[n["feature"], rows] > n["cut"])
    return at


# ------------------------------------------------------------------ splits
def best_cut(counts: np.ndarray, sums: np.ndarray, min_leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """For nodes x bins: the cut after which the squared error falls most and by how much (-1: no cut)."""
    n, s = counts.cumsum(1), sums.cumsum(1)
    left, right, a = n[:, :-1], n[:, -1:] - n[:, :-1], s[:, :-1]
    ok = (left >= min_leaf) & (right >= min_leaf)
    gain = np.full(left.shape, -1.0)
    np.divide(a * a, left, out=gain, where=ok)
    gain += np.divide((s[:, -1:] - a) ** 2, right, out=np.zeros_like(gain), where=ok)
    gain -= np.where(ok, s[:, -1:] ** 2 / np.maximum(n[:, -1:], 1), 0)
    cut = gain.argmax(1)
    return cut, gain[np.arange(len(gain)), cut]


def grown(bins: np.ndarray, y: np.ndarray, draws: np.ndarray, depth: int, min_leaf: int):
    """The branch over these rows, level by level: its nodes and each feature's gain. Rows are ordered by
    content first, so that sums don't depend on the order in which a shuffle brought them."""
    order = np.lexsort((draws, *bins, y))
    bins, y, w = np.ascontiguousarray(bins[:, order]), y[order], draws[order].astype(float)
    width = bins.max(1).astype(int) + 1
    node, m, levels, gains = np.zeros(len(y), np.int64), 1, [], np.zeros(len(bins))
    last = 0  # nodes before and on this level
    while m:
        n = np.bincount(node, w, m)
        mean = np.bincount(node, w * y, m) / n
        error = np.bincount(node, w * (y - mean[node]) ** 2, m)
        level = np.zeros(m, NODE)
        level["feature"], level["value"] = LEAF, mean
        levels.append(level)
        last += m
        can = (n >= 2 * min_leaf) & (error > 2.0**-52 * n) & (depth > 0)
        keep = can[node]
        bins, y, w, node = bins[:, keep], y[keep], w[keep], (np.cumsum(can) - 1)[node[keep]]
        ids, m = np.flatnonzero(can), int(can.sum())
        best, feature, cut = 1e-12 * error[ids], np.full(m, LEAF), np.zeros(m, int)
        residual = w * (y - mean[ids][node])
        for f, k in enumerate(width):
            if k > 1 and m:
                cell = node * k + bins[f]
                c, g = best_cut(np.bincount(cell, w, m * k).reshape(m, k),
                                np.bincount(cell, residual, m * k).reshape(m, k), min_leaf)
                more = g > best
                best[more], feature[more], cut[more] = g[more], f, c[more]
        split = feature >= 0
        np.add.at(gains, feature[split], best[split])
        rank = np.cumsum(split) - 1
        level["feature"][ids], level["cut"][ids] = feature, cut
        level["left"][ids[split]] = last + 2 * rank[split]
        keep = split[node]
        bins, y, w, node = bins[:, keep], y[keep], w[keep], node[keep]
        node = 2 * rank[node] + (bins[feature[node], np.arange(len(node))] > cut[node])
        m, depth = 2 * int(split.sum()), depth - 1
    return np.concatenate(levels), gains


# ------------------------------------------------------------------ fit
def _upper_trees(jvm, points: DataFrame, n: int, centre: float, features, cuts, trees, depth, min_leaf, rate, seed):
    """The upper nodes of each tree, level by level, until a branch fits one task. Returns them with the
    depth of every node and the gains of their splits."""
    tops = {t: [(BRANCH, 0, 0, 0.0)] for t in range(trees)}
    depths, gains = {t: [0] for t in range(trees)}, []
    todo = [(t, 0) for t in range(trees)] if depth and n * (rate or 1) > LOCAL_ROWS else []
    shape = (len(features), MAX_BINS, 3)  # rows, sums of the target and (first feature only) of its squares

    def sums(batches, tops, nodes):
        found = {}
        slots = {}
        for t, i in nodes:
            slots.setdefault(t, {})[i] = len(slots.get(t, {}))
        for b in batches:
            bins, keys = binned(b, features, cuts), b.column("_key").to_numpy()
            y = b.column("_y").to_numpy() - centre
            for t, slot in slots.items():
                c = drawn(keys, t, seed, rate)
                rows = np.flatnonzero(c)
                number = np.full(len(tops[t]), -1)
                number[list(slot)] = list(slot.values())
                at = number[walked(tops[t], bins[:, rows])]
                rows, at = rows[at >= 0], at[at >= 0]
                w = c[rows].astype(float)
                total = found.setdefault(t, np.zeros((len(slot), *shape)))
                for f in range(len(features)):
                    cell = at * MAX_BINS + bins[f, rows]
                    for j, x in enumerate((w, w * y[rows], w * y[rows] ** 2)[:2 if f else 3]):
                        total[:, f, :, j] += np.bincount(cell, x, len(slot) * MAX_BINS).reshape(-1, MAX_BINS)
        for t, total in found.items():
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([t] * len(total), pa.int32()), "node": pa.array(list(slots[t]), pa.int32()),
                "sums": pa.array([x.tobytes() for x in total], pa.binary())})

    def choose(pdf):
        parts = sorted(pdf["sums"])
        total = np.sum([np.frombuffer(p).reshape(shape) for p in parts], 0)
        n, s, q = total[0].sum(0)
        best, out = 1e-12 * (q - s * s / n), (LEAF, 0, 0.0, 0.0, 0.0, 0.0, 0.0)
        for f in range(len(features) if q - s * s / n > 2.0**-52 * n else 0):
            cut, gain = (x[0] for x in best_cut(total[f:f + 1, :, 0], total[f:f + 1, :, 1], min_leaf))
            if gain > best:
                left, right = total[f, :cut + 1].sum(0), total[f, cut + 1:].sum(0)
                best, out = gain, (f, int(cut), float(gain), left[0], right[0], centre + left[1] / left[0],
                                   centre + right[1] / right[0])
        return pd.DataFrame([(pdf["tree"].iloc[0], pdf["node"].iloc[0], *out, centre + s / n)],
                            columns=["tree", "node", "feature", "cut", "gain", "n_left", "n_right", "m_left",
                                     "m_right", "mean"])

    sent = "tree int, node int, sums binary"
    chosen = ("tree int, node int, feature int, cut int, gain double, n_left double, n_right double, m_left double, "
              "m_right double, mean double")
    while todo:
        now, todo = todo[:OPEN_NODES], todo[OPEN_NODES:]
        arrays = {t: np.array(tops[t], NODE) for t in {t for t, _ in now}}
        # no more tasks than cores: each sends its own sums
        few = points.coalesce(points.sparkSession.sparkContext.defaultParallelism)
        if jvm:
            told = native.packed(len(features), trees, depth, min_leaf, MAX_BINS, BLOCK_ROWS, centre, cuts,
                                 _chances(rate), arrays, adds=lambda t: _add(t, seed), open_nodes=now)
            splits = jvm.groups(jvm.rows(few, "sums", told, sent), "tree int, node int", "choose", told, chosen)
        else:
            splits = few.mapInArrow(lambda batches: sums(batches, arrays, now), sent).groupBy(
                "tree", "node").applyInPandas(choose, chosen)
        splits = splits.orderBy("tree", "node").collect()
        for s in splits:
            nodes, deep = tops[s.tree], depths[s.tree][s.node]
            if s.feature == LEAF:
                nodes[s.node] = (LEAF, 0, 0, s["mean"])
                continue
            nodes[s.node] = (s.feature, s.cut, len(nodes), s["mean"])
            gains.append((s.tree, s.feature, s.gain))
            for rows, mean in ((s.n_left, s.m_left), (s.n_right, s.m_right)):
                large = rows > LOCAL_ROWS
                nodes.append((LEAF if large and deep + 1 >= depth else BRANCH, 0, 0, mean))
                depths[s.tree].append(deep + 1)
                if large and deep + 1 < depth:
                    todo.append((s.tree, len(nodes) - 1))
    return {t: np.array(v, NODE) for t, v in tops.items()}, depths, gains


def fit(df: DataFrame, label: str, features, trees: int, depth: int, min_leaf: int, rate: float | None,
        seed: int) -> Forest:
    """The forest over the rows. ``df`` is read several times: it should be materialised."""
    spark, features = df.sparkSession, list(features)
    checkpoint_dir(spark)
    n, centre = df.agg(F.count("*"), F.avg(F.col(label).cast("double"))).first()
    cuts, jvm = thresholds(df, features), native.kernels(spark)
    points = df.select(*[F.col(f).cast("double").alias(f) for f in features],
                       F.xxhash64(*sorted(df.columns)).alias("_key"), F.col(label).cast("double").alias("_y"))
    tops, depths, gains = _upper_trees(jvm, points, n, centre, features, cuts, trees, depth, min_leaf, rate, seed)

    def dealt(batches):
        for b in batches:
            bins, keys, y = binned(b, features, cuts), b.column("_key").to_numpy(), b.column("_y").to_numpy()
            yield from _batches(dealt_rows(tops, bins, keys, y, seed, rate), [
                ("tree", pa.int32()), ("part", pa.int32()), ("bins", pa.binary()), ("y", pa.binary()),
                ("draws", pa.binary())])

    def grow(key, pdf):
        bins = np.concatenate([np.frombuffer(x, np.uint8).reshape(len(features), -1) for x in pdf["bins"]], 1)
        y, c = np.frombuffer(b"".join(pdf["y"])), np.frombuffer(b"".join(pdf["draws"]), np.uint8)
        tree, part = (int(k) for k in key)
        nodes, gain = grown(bins, y, c, depth - depths[tree][part], min_leaf)
        return pd.DataFrame({"tree": [tree], "part": [part], "nodes": [nodes.tobytes()], "gains": [list(gain)]})

    path = scratch_path(spark, f"forest-{uuid.uuid4().hex}")
    upper = []
    for t, top in tops.items():
        own = [sum(g for tree, f, g in gains if (tree, f) == (t, i)) for i in range(len(features))]
        upper.append((t, UPPER, top.tobytes(), [float(g) for g in own]))
        upper += [(t, int(i), top[i:i + 1].tobytes(), [0.0] * len(features))
                  for i in np.flatnonzero(top["feature"] == LEAF)]
    if jvm:
        told = native.packed(len(features), trees, depth, min_leaf, MAX_BINS, BLOCK_ROWS, centre or 0.0, cuts,
                             _chances(rate), tops, depths, lambda t: _add(t, seed))
        rows = jvm.rows(points, "deal", told, "tree int, part int, n int, rows binary")
        grown_parts = jvm.groups(rows, "tree int, part int", "grow", told, PARTS)
    else:
        rows = points.mapInArrow(dealt, "tree int, part int, bins binary, y binary, draws binary")
        grown_parts = rows.groupBy("tree", "part").applyInPandas(grow, PARTS)
    grown_parts.write.parquet(f"{path}/parts")
    local_frame(spark, upper, [("tree", pa.int32()), ("part", pa.int32()), ("nodes", pa.binary()),
                               ("gains", pa.list_(pa.float64()))]).write.mode("append").parquet(f"{path}/parts")
    head = json.dumps({"features": features, "cuts": cuts, "trees": trees})
    local_frame(spark, [(head,)], [("value", pa.string())]).write.text(f"{path}/head")
    return load(spark, path)


def dealt_rows(tops, bins, keys, y, seed: int, rate: float | None):
    """The rows that each branch draws: tree, branch, bins, target, draws."""
    for t, top in tops.items():
        c = drawn(keys, t, seed, rate)
        for part, r in _by_branch(top, bins, np.flatnonzero(c)):
            yield t, part, bins[:, r].tobytes(), y[r].tobytes(), c[r].tobytes()


def routed_rows(tops, copies, bins, ids):
    """The branch that scores each row, per block of rows: tree, branch, copy, block, places in it, bins."""
    for i in range(0, len(ids), BLOCK_ROWS):
        block, own = int(ids[i]), bins[:, i:i + BLOCK_ROWS]
        at, share = (ids[i:i + BLOCK_ROWS] - block).astype("<i4"), zlib.crc32(block.to_bytes(8, "little"))
        for t, top in tops.items():
            for part, r in _by_branch(top, own, np.arange(len(at)), leaves=True):
                yield t, part, share % copies.get((t, part), 1), block, at[r].tobytes(), own[:, r].tobytes()


def _by_branch(top: np.ndarray, bins: np.ndarray, rows: np.ndarray, leaves: bool = False):
    """(branch, its rows) of an upper tree; with ``leaves`` also those that end on a leaf of it."""
    at = walked(top, bins[:, rows])
    order = np.argsort(at, kind="stable")
    parts, starts = np.unique(at[order], return_index=True)
    for part, r in zip(parts, np.split(rows[order], starts[1:])):
        if leaves or top["feature"][part] == BRANCH:
            yield int(part), r


def _batches(rows, columns: list):
    """The rows in batches of little more than BATCH_BYTES, so that neither side of the pipe holds those of all
    trees."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) if isinstance(x, bytes) else 8 for x in row)
        if size >= BATCH_BYTES:
            yield _batch(held, columns)
            held, size = [], 0
    if held:
        yield _batch(held, columns)


def _batch(rows: list, columns: list) -> pa.RecordBatch:
    parts = zip(*rows) if rows else [[] for _ in columns]
    return pa.RecordBatch.from_arrays([pa.array(list(v), kind) for v, (_, kind) in zip(parts, columns)],
                                      names=[c for c, _ in columns])


def local_frame(spark: SparkSession, rows: list, columns: list) -> DataFrame:
    """A few rows of the driver as a frame. They go by Arrow: a plain list passes through Python workers of their
    own kind, which then stay beside those of the fit, one for each core."""
    return spark.createDataFrame(pa.Table.from_batches([_batch(rows, columns)]))


# ------------------------------------------------------------------ the fitted forest
UPPER = -1  # the part that holds a tree's upper nodes


@dataclass
class Forest:
    """A fitted forest: its folder, and the upper trees, which route rows to their branches."""

    path: str
    features: list[str]
    cuts: list[list[float]]
    trees: int
    tops: dict[int, np.ndarray]
    importances: np.ndarray

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``, the mean of the trees. Rows meet the branches in a shuffle, block by block."""
        spark = df.sparkSession
        checkpoint_dir(spark)
        x = df.withColumn("_row", F.monotonically_increasing_id()).checkpoint(eager=True)
        parts = spark.read.parquet(f"{self.path}/parts").where(F.col("part") != UPPER).select("tree", "part", "nodes")
        features, cuts, tops = self.features, self.cuts, self.tops

        def tally(batches):
            for b in batches:
                bins = binned(b, features, cuts)
                out = [(t, part, len(r)) for t, top in tops.items()
                       for part, r in _by_branch(top, bins, np.arange(b.num_rows), leaves=True)]
                yield _batch(out, [("tree", pa.int32()), ("part", pa.int32()), ("n", pa.int64())])

        # a branch that many rows reach is copied, each copy for a share of their blocks
        copies, jvm = {}, native.kernels(spark)
        numbers = [F.col(f).cast("double").alias(f) for f in features]
        told = lambda: native.packed(len(features), self.trees, 0, 0, MAX_BINS, BLOCK_ROWS, 0.0, cuts, [], tops,
                                     copies=copies)
        if x.count() > LOCAL_ROWS:
            own = x.select(*numbers)
            reached = (jvm.rows(own, "tally", told(), "tree int, part int, n long") if jvm else
                       own.mapInArrow(tally, "tree int, part int, n long"))
            reached = (reached.groupBy("tree", "part")
                        .agg(F.sum("n").alias("n")).where(F.col("n") > LOCAL_ROWS).collect())
            copies = {(r.tree, r.part): -(-r.n // LOCAL_ROWS) for r in reached}

        def route(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                bins, ids = binned(b, features, cuts), b.column("_row").to_numpy()
                yield from _batches(routed_rows(tops, copies, bins, ids), [
                    ("tree", pa.int32()), ("part", pa.int32()), ("copy", pa.int32()), ("block", pa.int64()),
                    ("at", pa.binary()), ("bins", pa.binary())])

        def score(key, blocks, found):
            if len(blocks) and not len(found):
                raise ValueError(f"the forest lacks branch {key}")
            if not len(blocks):
                return pd.DataFrame([], columns=["block", "tree", "at", "value"])
            nodes = np.frombuffer(found["nodes"].iloc[0], NODE)
            bins = [np.frombuffer(x, np.uint8).reshape(len(features), -1) for x in blocks["bins"]]
            ends = np.cumsum([x.shape[1] for x in bins])
            values = np.split(nodes["value"][walked(nodes, np.concatenate(bins, 1))], ends[:-1])
            return pd.DataFrame({"block": blocks["block"], "tree": key[0], "at": blocks["at"],
                                 "value": [v.tobytes() for v in values]})

        trees = self.trees

        def mean(key, pdf):
            at = [np.frombuffer(a, "<i4") for a in pdf["at"]]
            total = np.zeros(max(a.max() for a in at) + 1)
            seen = np.zeros(len(total), int)
            for i in np.argsort(pdf["tree"].to_numpy(), kind="stable"):
                total[at[i]] += np.frombuffer(pdf["value"].iloc[i])
                seen[at[i]] += 1
            rows = np.flatnonzero(seen)
            if (seen[rows] != trees).any():
                raise ValueError("a row was not scored by every tree")
            return pd.DataFrame({"_row": int(key[0]) + rows, "prediction": total[rows] / trees})

        keys = ["tree", "part", "copy"]
        many = local_frame(spark, [(t, p, int(n)) for (t, p), n in copies.items()],
                           [("tree", pa.int32()), ("part", pa.int32()), ("n", pa.int32())])
        found = parts.join(F.broadcast(many), ["tree", "part"], "left").select(
            "tree", "part", "nodes", F.explode(F.sequence(F.lit(0), F.coalesce("n", F.lit(1)) - 1)).alias("copy"))
        if jvm:
            rows = jvm.rows(x.select(*numbers, "_row"), "route", told(),
                            "tree int, part int, copy int, block long, n int, rows binary")
            scored = jvm.cogroups(rows, found.select("nodes", *keys), "tree int, part int, copy int", "score", told(),
                "block long, tree int, n int, scores binary")
            scored = jvm.groups(scored, "block long", "mean", told(), "_row long, prediction double")
        else:
            rows = x.select("_row", *features).mapInArrow(
                route, "tree int, part int, copy int, block long, at binary, bins binary")
            scored = (rows.groupBy(*keys).cogroup(found.groupBy(*keys))
                          .applyInPandas(score, "block long, tree int, at binary, value binary")
                          .groupBy("block").applyInPandas(mean, "_row long, prediction double"))
        return x.join(scored, "_row").drop("_row")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        spark.read.parquet(f"{self.path}/parts").write.mode("overwrite").parquet(f"{path}/parts")
        spark.read.text(f"{self.path}/head").write.mode("overwrite").text(f"{path}/head")


def load(spark: SparkSession, path: str) -> Forest:
    head = json.loads(spark.read.text(f"{path}/head").first()["value"])
    parts = spark.read.parquet(f"{path}/parts")
    tops = {r.tree: np.frombuffer(bytes(r.nodes), NODE)
            for r in parts.where(F.col("part") == UPPER).select("tree", "nodes").orderBy("tree").collect()}
    of = parts.groupBy("tree").agg(*[F.sum(F.col("gains")[i]).alias(f"g{i}") for i in range(len(head["features"]))])
    gains = np.array([r[1:] for r in of.orderBy("tree").collect()], float)
    # as MLlib: each tree's gains as shares, then the trees' shares together
    shares = (gains / np.where(gains.sum(1, keepdims=True) > 0, gains.sum(1, keepdims=True), 1)).sum(0)
    return Forest(path, head["features"], head["cuts"], head["trees"], tops, shares / (shares.sum() or 1))
