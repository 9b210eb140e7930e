"""Exact top-k search by sequential reading of sorted lists, without random access.

Each dimension of a block of vectors is a list sorted by component. A query reads the lists in
step, from the end that adds most to its inner product. What has been read bounds each score: an
unread component adds at least the smallest and at most the next entry of its list. Reading stops
once no vector outside the best k by lower bound can reach them by upper bound; the candidates
left are then scored exactly. Blocks of candidates and of queries meet in tasks of bounded size, and
the k best of each block are merged by a window over the query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES = 4096  # vectors in a block, about
QUERIES = 1024
DEPTHS = (0.5, 0.875)  # parts of the lists after which bounds are compared


def _exact_type(x: np.ndarray, q: np.ndarray):
    """float32 if every partial sum is a whole number below 2**24, else float64, and by how much bounds may
    be off: nothing if the sums are whole numbers below 2**53."""
    top = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1])
    if 4 * top < 2**24:
        return np.float32, 0.0
    return np.float64, 0.0 if 4 * top < 2**53 else top * (x.shape[1] + 8) * 2.0**-50


def _whole_scores(x: np.ndarray, q: np.ndarray) -> list[int]:
    """Inner products of whole doubles of any size, in whole numbers."""
    own = [int(v) for v in q]
    return [sum(int(a) * b for a, b in zip(row, own, strict=True)) for row in x]


def read_lists(x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query (row of ``q``, ``own`` its id) the k best rows of ``x`` by inner product, ties to
    the smaller id, rows with the query's id left out: (query index, id, score). Scores are exact; those
    that a 64-bit integer cannot hold are an error."""
    n, d = x.shape
    kind, off = _exact_type(x, q)
    x, q = x.astype(kind), q.astype(kind)
    order = np.argsort(-x, axis=0, kind="stable")
    rank = np.empty((n, d), np.int32)  # place of each vector in each list
    np.put_along_axis(rank, order, np.arange(n, dtype=np.int32)[:, None], axis=0)
    lists = np.take_along_axis(x, order, axis=0)  # descending
    pos, neg = np.maximum(q, 0), np.minimum(q, 0)  # read from the top, from the bottom
    same = own[:, None] == ids[None, :]
    left = {i: None for i in range(len(q))}  # query -> candidates, once reading has stopped
    active = np.arange(len(q))
    for part in DEPTHS if n > 8 * k and d else ():
        t = min(n - 1, int(n * part))
        top, bottom = rank < t, rank >= n - t
        p, m = pos[active], neg[active]
        seen = p @ np.where(top, x, 0).T + m @ np.where(bottom, x, 0).T
        unread_top, unread_bottom = (~top).T.astype(kind), (~bottom).T.astype(kind)
        low = seen + (p * lists[-1]) @ unread_top + (m * lists[0]) @ unread_bottom
        high = seen + (p * lists[t]) @ unread_top + (m * lists[n - 1 - t]) @ unread_bottom
        low[same[active]] = -np.inf
        kth = np.partition(low, n - k, axis=1)[:, n - k]
        may = (high + 2 * off >= kth[:, None]) & ~same[active]
        few = may.sum(axis=1) <= max(64, 8 * k)
        for i in np.flatnonzero(few):
            left[active[i]] = np.flatnonzero(may[i])
        active = active[~few]
        if not len(active):
            break
    out_q, out_id, out_s = [], [], []
    whole = q[active] @ x.T  # read to the end: every bound is the score
    rows = {int(a): whole[i] for i, a in enumerate(active)}
    for i, cand in left.items():
        if cand is None:
            score = np.where(same[i], -np.inf, rows[i]).astype(np.float64)
            valid = n - int(same[i].sum())
            if valid > k:
                kth = np.partition(score, n - k)[n - k]
                cand = np.flatnonzero((score >= kth - 2 * off) & ~same[i])
            else:
                cand = np.flatnonzero(~same[i])
            score = score[cand]
        else:
            score = (x[cand] @ q[i]).astype(np.float64)
        if off:  # doubles cannot hold such sums
            whole_score = _whole_scores(x[cand], q[i])
            best = sorted(range(len(cand)), key=lambda j: (-whole_score[j], ids[cand[j]]))[:k]
            out_s += [whole_score[j] for j in best]
        else:
            best = np.lexsort((ids[cand], -score))[:k]
            out_s += score[best].astype(np.int64).tolist()
        out_q += [i] * len(best)
        out_id += ids[cand][best].tolist()
    return np.array(out_q, np.int64), np.array(out_id, np.int64), np.array(out_s, np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, candidates: int = CANDIDATES,
          per_block: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best ``vectors`` for each of ``queries``; both
    have vec_id and x (array of whole doubles). Rows of the query's vec_id are its own and left
    out, repeated rows count once, and vectors of other lengths than the query's do not meet it.
    """
    def prepared(df: DataFrame, per: int) -> tuple[DataFrame, int]:
        df = df.dropDuplicates(["vec_id", "x"])
        return df, max(1, -(-df.count() // per))

    cand, n_cand = prepared(vectors, candidates)
    query, n_query = prepared(queries, per_block)
    zero = F.lit(0).cast("long")
    block = lambda n: F.pmod(F.xxhash64("vec_id", "x"), F.lit(n))
    cand = (cand.withColumn("cb", block(n_cand)).withColumn("d", F.size("x"))
            .withColumn("qb", F.explode(F.sequence(zero, zero + (n_query - 1)))))
    query = (query.withColumn("qb", block(n_query)).withColumn("d", F.size("x"))
             .withColumn("cb", F.explode(F.sequence(zero, zero + (n_cand - 1)))))

    def search(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(q):
            return pd.DataFrame({"query_id": [], "q": [], "vec_id": [], "score": []}, dtype="int64")
        c, q = c.sort_values("vec_id"), q.reset_index(drop=True)
        i, ids, score = read_lists(np.array(c["x"].tolist(), np.float64).reshape(len(c), -1),
                                   c["vec_id"].to_numpy(),
                                   np.array(q["x"].tolist(), np.float64).reshape(len(q), -1),
                                   q["vec_id"].to_numpy(), k)
        return pd.DataFrame({"query_id": q["vec_id"].to_numpy()[i], "q": q["h"].to_numpy()[i],
                             "vec_id": ids, "score": score})

    found = (cand.select("d", "cb", "qb", "vec_id", "x").groupBy("d", "cb", "qb")
             .cogroup(query.select("d", "cb", "qb", "vec_id", "x", F.xxhash64("x").alias("h"))
                      .groupBy("d", "cb", "qb"))
             .applyInPandas(search, "query_id long, q long, vec_id long, score long"))
    best = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and x = floor(256 * component); rows without id, without vector, or with a null or
    non-finite component are left out."""
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (embeddings.where(F.col("vec_id").isNotNull() & e.isNotNull() & finite)
            .select("vec_id", F.transform(e, lambda v: F.floor(v.cast("double") * 256)
                                          .cast("double")).alias("x")))


def search_embeddings(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k best vectors for each vector whose id is divisible by ``every``."""
    x = whole_vectors(embeddings)
    return top_k(x, x.where(F.col("vec_id") % every == 0), k)
