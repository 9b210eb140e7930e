"""op4 and op6, the registered queries, against plain Python and numpy over all rows."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest

from airshed.llm import quality, queries

WORDS = re.compile("[^\x20\x09-\x0d]+")
SOURCES = [("b", 400), ("a", 30), (None, 60), ("é", 200), ("Z", 500), ("", 3)]


def targets(sizes: dict) -> dict:
    """Weights 5, 2, 1 by code point, null last; what is above 3 times a source's size is shared again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    free = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    left, want = float(sum(sizes.values())), {}
    while free:
        share = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return want | share
        for s in over:
            want[s] = 3.0 * sizes[s]
            left -= want[s]
            del free[s]
    return want


@pytest.fixture(scope="module")
def at(spark, tmp_path_factory):
    r = random.Random(5)
    folder = str(tmp_path_factory.mktemp("mix"))
    rows, labels = [], []
    for s, n in SOURCES:
        for _ in range(n):
            i = len(rows)
            good = r.random() < 0.5
            words = r.choices(["alpha", "beta, and", "gamma.", "Delta"] if good else ["xx", "!!", "999", "AAAA"],
                              k=r.randint(0, 120))
            rows.append((i, r.choice([" ", "\t", "\n", "  "]).join(words) or r.choice([None, "", "  "]), s))
            if r.random() < 0.6:
                labels.append((i, int(good != (r.random() < 0.15))))
    rows += rows[:25]  # repeated rows
    labels += [(0, 1), (0, 0), (1, None), (None, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, labels


def test_mixing_query(spark, at):
    folder, rows, _ = at
    count = [len(WORDS.findall(t or "")) for _, t, _ in rows]
    sizes: dict = {}
    for (_, _, s), n in zip(rows, count, strict=True):
        sizes[s] = sizes.get(s, 0) + n
    want = targets(sizes)
    assert any(want[s] == 3 * sizes[s] for s in sizes) and any(want[s] < 3 * sizes[s] for s in sizes)
    got = queries.QUERIES["op4_mixing"](spark, folder).collect()
    source = {i: s for i, _, s in rows}
    assert sorted((r.doc_id, r.size) for r in got) == sorted((i, n) for (i, _, _), n in zip(rows, count, strict=True))
    taken: dict = {}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] = taken.get(s, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= max(3, 0.01 * want[s]), s
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.QUERIES["op4_mixing"](spark, folder).collect()))


def bucket(key: str, n: int) -> int:
    return zlib.crc32(key.encode()) % n


def test_quality_query(spark, at):
    """Normal equations of all rows at once, and the isotonic fit by its max-min formula."""
    folder, rows, labels = at
    x = np.array([quality.statistics(t) for _, t, _ in rows])
    by_id: dict = {}
    for i, q in labels:
        if i is not None and q is not None and bucket(str(i), 5):
            by_id.setdefault(i, []).append(q)
    taught = [k for k, (i, _, _) in enumerate(rows) if i in by_id]
    y = np.array([np.mean(by_id[rows[k][0]]) for k in taught])
    to_fit = np.array([bucket(f"{rows[k][0]}c", 4) != 0 for k in taught])
    known = x[taught]
    mean, scale = known[to_fit].mean(axis=0), known[to_fit].std(axis=0)
    rng = np.random.default_rng(1)
    w = rng.normal(0, 1 / quality.WIDTH, (quality.STATISTICS, quality.FOURIER))
    b = rng.uniform(0, 2 * np.pi, quality.FOURIER)

    def features(v):
        z = np.clip((v - mean) / np.where(scale > 1e-12, scale, 1.0), -8, 8)
        return np.c_[np.sqrt(2 / quality.FOURIER) * np.cos(z @ w + b), np.ones(len(v))]

    z = features(known[to_fit])
    beta = np.linalg.solve(z.T @ z + quality.RIDGE * np.diag([1.0] * quality.FOURIER + [1e-9]), z.T @ y[to_fit])
    s = features(known[~to_fit]) @ beta
    bins = np.clip(np.floor((s + 0.5) / 2 * quality.BINS), 0, quality.BINS - 1).astype(int)
    order = sorted(set(bins))
    n = np.array([(bins == i).sum() for i in order])
    total = np.array([y[~to_fit][bins == i].sum() for i in order])
    fitted = [max(min(total[a:c + 1].sum() / n[a:c + 1].sum() for c in range(i, len(order))) for a in range(i + 1))
              for i in range(len(order))]
    got = {r.doc_id: r for r in queries.QUERIES["op6_quality"](spark, folder).collect()}
    place = {i: v for i, v in zip(order, fitted, strict=True)}
    for k, i in zip(np.array(taught)[~to_fit], bins, strict=True):  # between its pool's neighbours
        low = max((v for v in fitted if v < place[i]), default=place[i])
        high = min((v for v in fitted if v > place[i]), default=place[i])
        assert low - 1e-6 <= got[rows[k][0]].score <= high + 1e-6
    centre = (np.array(order) + 0.5) / quality.BINS * 2 - 0.5
    pools = sorted(set(np.round(fitted, 12)))
    same = [np.isclose(fitted, v, atol=1e-10) for v in pools]
    knots = [np.average(centre[m], weights=n[m]) for m in same]
    want = np.clip(np.interp(features(x) @ beta, knots, pools), 0, 1)
    for k, (i, _, _) in enumerate(rows):
        assert got[i].score == pytest.approx(want[k], abs=1e-4)
        assert got[i].held_out == (bucket(str(i), 5) == 0)
        assert got[i].predicted == int(got[i].score >= 0.3)
    assert len(got) == len({i for i, _, _ in rows})
