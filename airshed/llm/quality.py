"""Quality scores by random Fourier features and ridge regression.

Document statistics (shares of kinds of characters, words, lines, repeats) are standardised and
mapped to random Fourier features, whose inner products approximate a Gaussian kernel. Each
partition sums its share of the normal equations; the sums, of fixed size, are solved on the
driver. Isotonic regression on labelled rows kept out of the fit turns ridge scores into
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import as_id, as_text, written

FOURIER = 384  # random features
WIDTH = 3.0  # of the kernel, in standard deviations of a statistic
RIDGE = 1.0
PARTS = 256  # most partial sums of the normal equations
BINS = 2000  # of the histogram that calibration sums over all its rows

_KIND = np.zeros(256, np.int64)  # kind of each byte
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz",
                             b"0123456789", b" \t\r", b"\n", b".,;:'\"", b"!?", b"$%#&*@",
                             b"|<>{}[]()=/\\_^~`+-"), start=1):
    _KIND[list(_chars)] = _k
_KIND[128:] = 10
STATISTICS = 25


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a text; a null text is an empty one."""
    raw = (text or "").encode()
    n = max(1, len(raw))
    kind = _KIND[np.frombuffer(raw, np.uint8)]
    kinds = np.bincount(kind, minlength=11)
    gap = np.ones(len(raw) + 2, bool)
    gap[1:-1] = (kind == 4) | (kind == 5)
    start = np.flatnonzero(gap[:-1] & ~gap[1:])  # of the words
    end = np.flatnonzero(~gap[:-1] & gap[1:])
    many, rows = max(1, len(start)), max(1, raw.count(b"\n") + 1)
    unique = len(set(raw.split()))
    lines = len(set(raw.split(b"\n")))
    tail = np.bincount(kind[end - 1], minlength=11) / many
    share = kinds / n
    some = share[share > 0]
    return [float(np.log1p(len(raw))), float(np.log1p(many)), *share[1:].tolist(),
            float(-(some * np.log(some)).sum()), len(raw) / many, unique / many, lines / rows,
            float(np.log1p(len(raw) / rows)), float((kind[start] == 1).sum()) / many,
            *tail[[5, 6, 7, 8, 9]].tolist(), float((end - start).max(initial=0)) ** 0.5,
            raw.count(b"http") / many]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    beta: np.ndarray
    knots: np.ndarray  # ridge scores, rising
    values: np.ndarray  # calibrated, rising

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        f = np.sqrt(2.0 / len(self.b)) * np.cos(z @ self.w + self.b)
        return np.hstack([f, np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.round(np.clip(np.interp(self.ridge(x), self.knots, self.values), 0, 1), 9)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (mean x, mean y) of each pool, for x in rising order."""
    pools: list[list[float]] = []
    for a, b, w in zip(x, y, weight, strict=True):
        pools.append([a * w, b * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return (np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools]))


def _stack(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), STATISTICS)


def _sum_equations(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over all rows of ``train`` (x, y)."""
    d = len(model.b) + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((d, d + 1))
        for batch in batches:
            z = model.features(_stack(batch["x"]))
            total[:, :d] += z.T @ z
            total[:, d] += z.T @ batch["y"].to_numpy(np.float64)
        yield pd.DataFrame({"i": range(d), "v": list(total)})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.array(pdf["v"].tolist())
        rows = rows[np.lexsort(rows.T[::-1])]  # the sum does not depend on the order of arrival
        return pd.DataFrame({"i": pdf["i"].iloc[:1].to_numpy(), "v": [rows.sum(axis=0)]})

    schema = "i int, v array<double>"
    rows = (train.coalesce(PARTS).mapInPandas(partial, schema)
            .groupBy("i").applyInPandas(add, schema).collect())  # FOURIER + 1 rows
    total = np.zeros((d, d + 1))
    for r in rows:
        total[r["i"]] = r["v"]
    return total[:, :d], total[:, d]


def fit(train: DataFrame, calibrate: DataFrame, seed: int = 1) -> Model:
    """Fits on ``train`` and calibrates on ``calibrate`` (x: statistics, y: 0 to 1), all their rows.
    Without rows every score is one half."""
    x = [F.get("x", F.lit(i)) for i in range(STATISTICS)]
    row = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
                    *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(x)]).first()
    got = np.array([np.nan if v is None else v for v in row], np.float64)
    mean, scale = np.nan_to_num(got[:STATISTICS]), np.nan_to_num(got[STATISTICS:])
    rng = np.random.default_rng(seed)
    model = Model(mean, np.where(scale > 1e-12, scale, 1.0),
                  rng.normal(0, 1 / WIDTH, (STATISTICS, FOURIER)),
                  rng.uniform(0, 2 * np.pi, FOURIER), np.zeros(FOURIER + 1),
                  np.array([0.0]), np.array([0.5]))
    zz, zy = _sum_equations(train, model)
    if not zz[-1, -1]:
        return model
    model.beta = np.linalg.solve(zz + RIDGE * np.diag([1.0] * FOURIER + [1e-9]), zy)

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            s = model.ridge(_stack(batch["x"]))
            at = np.clip(np.floor((s + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64)
            yield pd.DataFrame({"bin": at, "y": batch["y"].to_numpy(np.float64)})

    sums = (calibrate.mapInPandas(binned, "bin long, y double").groupBy("bin")
            .agg(F.sum("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect())
    if sums:  # at most BINS rows
        n = np.array([r["n"] for r in sums], np.float64)
        at = (np.array([r["bin"] for r in sums]) + 0.5) / BINS * 2 - 0.5
        model.knots, model.values = isotonic(at, np.array([r["y"] for r in sums]) / n, n)
    return model


def _bucket(key: Column, n: int) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % n


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out (crc32 of the id as text, mod 5, is 0), score, predicted.

    Learns ``labels.quality`` of the rows that are not held out; a quarter of them, by another
    hash, calibrates. Ids with several labels count with their mean; rows without id or label do
    not teach. Null and empty texts have the statistics of an empty text.
    """
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"],
                                "x": [statistics(t) for t in batch["text"]]})

    measured = written(docs.select(as_text("doc_id"), "text").mapInPandas(
        measure, "doc_id string, x array<double>").select(as_id("doc_id"), "x"), "statistics")
    taught = (labels.where(F.col("quality").isNotNull() & (_bucket(F.col("doc_id"), 5) != 0))
              .groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("y")))
    taught = written(measured.join(taught, "doc_id"), "labelled")
    keep = _bucket(F.concat(F.col("doc_id").cast("string"), F.lit("c")), 4) == 0
    model = fit(taught.where(~keep), taught.where(keep))

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"],
                                "score": model.score(_stack(batch["x"]))})

    held = F.coalesce(_bucket(F.col("doc_id"), 5) == 0, F.lit(False))
    return (measured.select(as_text("doc_id"), "x").mapInPandas(apply, "doc_id string, score double")
            .select(as_id("doc_id"), "score").select("doc_id", held.alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted")))
