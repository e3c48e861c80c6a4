"""A quality classifier: kernel ridge on document statistics through random Fourier features, then isotonic calibration.

The statistics are counted once for each text and kept in a scratch table. The
features approximate a Gaussian kernel over the standardised statistics. Each
partition of the training rows sums its part of the normal equations, by fold; the
driver adds a fixed number of such sums and solves them. Scores of held-out folds
calibrate the score by isotonic regression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.labelled import TRAINING_ROWS, remainder, training_labels
from tidefeed.llm.storage import cut, ship, sliced

FEATURES, RIDGE, FOLDS, SEED = 256, 1e-3, 5, 17
#: Sums of the normal equations that reach the driver.
SUMS = 8

_CLASSES = [b" ", b"\n", b"0123456789", bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(128, 256)), b"|", b"!", b".,;:?", b"'\"()-", b"#$%&*@^~+=<>{}[]\\/_"]
N_STATISTICS = len(_CLASSES) + 14


def statistics(text: bytes) -> np.ndarray:
    """Lengths, shares of character classes, and measures of repetition of a whole text, each finite."""
    out = np.zeros(N_STATISTICS, np.float32)
    n = len(text)
    if not n:
        return out
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(np.float64)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x]
    w, k = max(len(words), 1), max(len(lines), 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    different, different_lines = set(words), set(lines)
    p = counts[counts > 0] / n
    out[: len(_CLASSES)] = [counts[np.frombuffer(c, np.uint8)].sum() / n for c in _CLASSES]
    out[len(_CLASSES) :] = [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), min(sizes.mean(), 50), min(sizes.std(), 50), np.log1p(sizes.max()), (sizes <= 3).mean(),
        len(different) / w, len(different) / w**0.75, sum(map(bytes.__eq__, words, words[1:])) / w,
        len(different_lines) / k, sum(map(len, different_lines)) / n, -(p * np.log(p)).sum(), min(w / k, 500) / 500,
    ]
    return out


def statistics_table(docs: DataFrame) -> DataFrame:
    """``(doc_id, stats)`` of every row; a null text counts as empty."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            rows = [statistics(t or b"") for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(rows, pa.list_(pa.float32()))], names=["doc_id", "stats"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, stats array<float>")


@dataclass
class Kernel:
    """The map from statistics to random Fourier features."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @classmethod
    def fit(cls, mean: np.ndarray, deviation: np.ndarray) -> Kernel:
        rng = np.random.default_rng(SEED)
        d = len(mean)
        width = np.sqrt(d)  # of the Gaussian; the median distance of standardised points is about the root of 2 d
        return cls(mean, 1 / np.maximum(deviation, 1e-6), rng.standard_normal((d, FEATURES)) / width, rng.uniform(0, 2 * np.pi, FEATURES))

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) * self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ self.directions + self.phases), np.ones((len(z), 1))])


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (mean score, mean label) of the pools; equal scores are one point.

    Labels are drawn to a half by one row's weight, and never fall as the score rises.
    """
    at, back = np.unique(score, return_inverse=True)
    weight = np.bincount(back).astype(float)
    pools: list[list[float]] = []  # weight, sum of labels, sum of scores
    for x, w, y in zip(at, weight, np.bincount(back, label), strict=True):
        pools.append([w, y, w * x])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    table = np.array(pools)
    return table[:, 2] / table[:, 0], np.maximum.accumulate((table[:, 1] + 0.5) / (table[:, 0] + 1))


@dataclass
class QualityModel:
    kernel: Kernel
    weights: np.ndarray
    at: np.ndarray
    level: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.kernel(stats) @ self.weights, self.at, self.level), 0, 1)


def fit(rows: DataFrame) -> QualityModel | None:
    """From ``(doc_id, stats, label)``, of bounded size; None of an empty table or a single class."""
    first = rows.select("label", F.posexplode("stats").alias("i", "x")).groupBy("i").agg(F.avg("x"), F.stddev_pop("x"), F.min("label"), F.max("label")).orderBy("i").collect()
    if not first or first[0][3] == first[0][4]:
        return None
    kernel = Kernel.fit(np.array([r[1] for r in first]), np.array([r[2] for r in first]))
    d = FEATURES + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, right = np.zeros((FOLDS, d, d)), np.zeros((FOLDS, d))
        for b in batches:
            z, y, fold = kernel(np.array(b.column(0).to_pylist(), np.float64).reshape(b.num_rows, -1)), b.column(1).to_numpy(), b.column(2).to_numpy()
            for f in range(FOLDS):
                own = fold == f
                gram[f] += z[own].T @ z[own]
                right[f] += z[own].T @ y[own]
        yield pa.record_batch([pa.array([gram.tobytes()]), pa.array([right.tobytes()])], names=["gram", "right"])

    rows = cut(rows.select("stats", "label", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")).repartition(SUMS), "training")
    parts = rows.coalesce(SUMS).mapInArrow(sums, "gram binary, right binary").collect()
    gram = sum(np.frombuffer(p[0]).reshape(FOLDS, d, d) for p in parts)
    right = sum(np.frombuffer(p[1]).reshape(FOLDS, d) for p in parts)
    n = gram[:, -1, -1].sum()
    solve = lambda g, r: np.linalg.solve(g + RIDGE * n * np.eye(d), r)
    total = gram.sum(0), right.sum(0)
    folds = [solve(total[0] - gram[f], total[1] - right[f]) for f in range(FOLDS)]

    def held_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z, fold = kernel(np.array(b.column(0).to_pylist(), np.float64).reshape(b.num_rows, -1)), b.column(2).to_numpy()
            score = np.einsum("nd,nd->n", z, np.array(folds)[fold])
            yield pa.record_batch([pa.array(score), b.column(1)], names=["score", "label"])

    pairs = rows.mapInArrow(held_out, "score double, label double").collect()
    at, level = isotonic(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    return QualityModel(kernel, solve(*total), at, level)


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, bound: int = TRAINING_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Learns from the labelled rows whose crc32(doc_id) mod ``folds`` isn't ``held``,
    ``bound`` of them at most. Null and empty texts have zero statistics and are scored
    like any other; a null id isn't held out. Without labels of both classes all
    scores are 0.5. Equal texts get equal scores; other columns are ignored; no rows, no rows.
    """
    stats = cut(statistics_table(docs), "statistics")
    known = training_labels(labels, "quality", remainder(folds) != held, bound)
    model = fit(stats.join(F.broadcast(known), "doc_id").select("doc_id", "stats", "label"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(1).to_pylist(), np.float64).reshape(b.num_rows, -1)
            yield pa.record_batch([b.column(0), pa.array(model.score(x) if model else np.full(len(x), 0.5))], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(remainder(folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
