"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

Statistics of a text are standardised and mapped to ``DIM`` cosines whose random
directions, drawn from a fixed seed, make their inner products a Gaussian kernel of
width ``WIDTH``. Every task sums x x' and x y over its labelled rows; the driver solves
the ridge equations of fixed size. Raw scores of the labelled rows, by equations of the other half of
them, are then counted in ``BINS`` bins, and pooling adjacent violators makes them a rising map to [0, 1].

Every labelled row of the training folds is used, every document is scored. What the
driver gets is of fixed size, as is what tasks get. The statistics are worked out once
and written to the shared folder; labels meet them by id, not the texts.

Defined results: a null or empty text has the score of all-zero statistics; labels of
null quality or of ids that are not there are not used; an id labelled twice counts
twice; documents that repeat are scored alike; with no label every score is 0.5. An empty table gives no row; other columns are not read; texts are
taken whole, a few MB of them at a time and one at least; equal texts have equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank, materialize, release, summed, text_batches
from .textstats import FEATURES, features

DIM, WIDTH, RIDGE, SEED, BINS = 256, 4.0, 1.0, 20240, 2000
#: Standardised statistics beyond this are cut to it.
REACH = 6.0
N = len(FEATURES)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and ``x``, the statistics of the text as float64 in a binary column."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blank(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release("rff")
        for batch in text_batches(batches, "text"):
            values = [np.array(features(t)).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.binary())], names=["doc_id", "x"])

    return chosen.mapInArrow(run, "doc_id long, x binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, N)


def _vectors(frame: DataFrame, size: int, add) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                add(total, _matrix(batch.column("x")), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "half")))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    return summed(frame.select("x", "y", "half").mapInArrow(run, "v binary"), size)


class Model:
    """A fitted classifier; small and of fixed size."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.directions = rng.normal(size=(N, DIM)) / WIDTH
        self.phases = rng.uniform(0, 2 * np.pi, DIM)
        self.beta = np.zeros(DIM + 1)
        self.low, self.high = 0.0, 1.0
        self.steps = np.full(BINS, 0.5)

    def map(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -REACH, REACH)
        return np.hstack([np.sqrt(2 / DIM) * np.cos(z @ self.directions + self.phases), np.ones((len(x), 1))])

    def bin(self, raw: np.ndarray) -> np.ndarray:
        return np.clip((raw - self.low) / (self.high - self.low) * BINS, 0, BINS - 1).astype(np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.steps[self.bin(self.map(x) @ self.beta)]


def isotonic(good: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The rising fit of good / total by bin; empty bins take what lies between their neighbours."""
    held = np.flatnonzero(total > 0)
    if not len(held):
        return np.full(len(total), 0.5)
    pools: list[list[float]] = []
    for k in held:
        pools.append([good[k], total[k], 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            g, t, n = pools.pop()
            pools[-1] = [pools[-1][0] + g, pools[-1][1] + t, pools[-1][2] + n]
    fit = np.repeat([g / t for g, t, _ in pools], [int(n) for *_, n in pools])
    return np.interp(np.arange(len(total)), held, fit)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``labels`` (doc_id, y of 0 or 1) and the ``statistics`` of the documents.

    The scores that are calibrated are those of a ridge that has not seen the row: the normal equations
    are summed for either half of the ids, each half is scored by the other's solution, and the classifier itself is solved from both.
    """
    held = stats.join(labels.where("y is not null").select("doc_id", "y"), "doc_id")
    held = materialize(held.select("x", F.col("y").cast("double").alias("y"), F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")), "rff-train")

    def moments(total, x, y, half):
        total[:N] += x.sum(0)
        total[N : 2 * N] += (x * x).sum(0)
        total[2 * N] += len(x)

    sums = _vectors(held, 2 * N + 1, moments)
    n = max(sums[-1], 1.0)
    mean = sums[:N] / n
    model = Model(mean, np.sqrt(np.maximum(sums[N : 2 * N] / n - mean**2, 0)) + 1e-9)
    if not sums[-1]:
        return model
    d = DIM + 1

    def normal(total, x, y, half):
        z = model.map(x)
        for k, part in enumerate(total.reshape(2, -1)):
            own, target = z[half == k], y[half == k]
            part[: d * d] += (own.T @ own).ravel()
            part[d * d :] += own.T @ target

    def solved(sums):
        return np.linalg.solve(sums[: d * d].reshape(d, d) + RIDGE * np.eye(d), sums[d * d :])

    sums = _vectors(held, 2 * (d * d + d), normal).reshape(2, -1)
    model.beta = solved(sums.sum(0))
    model.low, model.high = -0.5, 1.5
    others = [solved(sums[1]), solved(sums[0])]  # by half: learned from the other

    def counted(total, x, y, half):
        z = model.map(x)
        k = model.bin(np.where(half == 0, z @ others[0], z @ others[1]))
        total[:BINS] += np.bincount(k, weights=y, minlength=BINS)
        total[BINS:] += np.bincount(k, minlength=BINS)

    sums = _vectors(held, 2 * BINS, counted)
    model.steps = isotonic(sums[:BINS], sums[BINS:])
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``score`` of every row of ``stats``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_matrix(batch.column("x"))), pa.float64())], names=["doc_id", "score"])

    return stats.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 0):
    """Whether a document's labels are kept from learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out and score of every document, learned from ``labels.quality`` of the other folds."""
    stats = materialize(statistics(docs, text), "rff-stats")
    train = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).where(~held_out())
    return score(stats, fit(stats, train)).select("doc_id", held_out().alias("held_out"), "score")
