"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio.

Every 4-byte n-gram of a text falls into one of ``BUCKETS`` hash buckets. Two
multinomials over the buckets, both with add-one smoothing, are counted: ``raw`` from
every document, ``target`` from trusted ones. A text's score is the mean over its
n-grams of log(target / raw); it passes where that is the threshold or more, each
document by itself, without chance.

Labels are those of the training folds: of ids whose crc32 (as text) modulo ``FOLDS`` is not 0. The
trusted documents are all those labelled good. Up to ``HELD_IDS`` of their ids go to every task; more are
joined to the documents, with the same counts. The threshold is the ratio that parts good from
rejected ones best, of all labelled documents that pass the base rules: the middle of the range of
ratios for which most good ones pass and most others fail. It is counted from the scores, joined to
the labels without the texts. The raw counts
cover all data. Counts take one vector of fixed size a task, summed by tasks and then
the driver; the weights, as large, go to every task.

Defined results: a null or empty text has no words, fails the base rules and scores 0;
rows that repeat count as often as they are there; with no trusted document every
score is that of the smoothed uniform target, and without labels of both kinds the threshold is ``THRESHOLD``.
An empty table gives no row and no weight but zero; other columns are not read; texts are taken whole, a few MB of them
at a time and one at least; a ratio equal to the threshold passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank, materialize, summed, text_batches
from .textstats import base_counts

BUCKETS = 1 << 14
WIDTH = 4
THRESHOLD = 0.0
FOLDS = 5
#: Bins of the ratios between -8 and 8 that the threshold is taken from.
BINS = 6400
#: Ids of trusted documents up to which every task gets them all; beyond, they are joined.
HELD_IDS = 1 << 20
#: Limits of the base rules: fewest words, and the most words of a hundred in repeated windows.
MIN_WORDS, MAX_REPEATED = 50, 50


def buckets(raw: bytes) -> np.ndarray:
    """The bucket of every n-gram of a text's bytes."""
    codes = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if len(codes) < WIDTH:
        return np.zeros(0, np.uint32)
    n = len(codes) - WIDTH + 1
    grams = codes[:n].copy()
    for k in range(1, WIDTH):
        grams |= codes[k : k + n] << np.uint32(8 * k)
    return grams * np.uint32(0x9E3779B1) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def trusted(labels: DataFrame) -> np.ndarray | DataFrame:
    """The ids of the trusted documents, sorted; if more than ``HELD_IDS``, as a table of distinct ones."""
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct()
    if good.count() > HELD_IDS:
        return good
    return np.sort(good.toArrow().column("doc_id").to_numpy())


def training(labels: DataFrame) -> DataFrame:
    """The labels of the training folds."""
    return labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0)


def _ratio(raw: bytes, learned: np.ndarray) -> float:
    found = buckets(raw)
    return float(learned[found].mean()) if len(found) else 0.0


def _failed(n_words, repeated):
    """Whether the base rules reject a text."""
    return (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n_words)


def threshold(docs: DataFrame, learned: np.ndarray, labels: DataFrame, text: str = "text") -> float:
    """The ratio that parts documents labelled good from others best."""
    return cut_of(judge(docs, learned, text), labels)


def cut_of(judged: DataFrame, labels: DataFrame) -> float:
    """The threshold by all labelled rows of ``judged``; the driver gets a count for each bin and label."""
    marked = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).dropna()
    marked = marked.groupBy("doc_id").agg(F.max("y").alias("y"))
    place = F.least(F.greatest(F.floor((F.col("llr") + 8) / 16 * BINS), F.lit(0)), F.lit(BINS - 1))
    placed = judged.where("not base_failed and doc_id is not null").groupBy("doc_id", place.alias("place")).agg(F.count("*").alias("n"))
    total = np.zeros((2, BINS))
    for r in placed.join(marked, "doc_id").groupBy("y", "place").agg(F.sum("n").alias("n")).collect():
        total[r.y, r.place] = r.n
    return best_cut(*total)


def best_cut(bad: np.ndarray, good: np.ndarray) -> float:
    """The middle of the cuts for which the shares of good texts that pass and of others that fail are largest together."""
    if not bad.sum() or not good.sum():
        return THRESHOLD
    gain = np.concatenate([[0], np.cumsum(bad)]) / bad.sum() - np.concatenate([[0], np.cumsum(good)]) / good.sum()
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    first = best[0]
    last = first + int(np.argmax(np.append(np.diff(best), 2) > 1))  # of the first run of equal ones
    return float((first + last) / 2 / BINS * 16 - 8)


def weights(docs: DataFrame, ids: np.ndarray | DataFrame, text: str = "text") -> np.ndarray:
    """log(target / raw) of every bucket, over all of ``docs``."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blank(text).alias("text"))
    held = None if isinstance(ids, DataFrame) else ids
    if held is None:
        chosen = chosen.join(ids.withColumn("good", F.lit(True)), "doc_id", "left").select("doc_id", "text", F.col("good").isNotNull().alias("good"))

    def trust(batch: pa.RecordBatch) -> np.ndarray:
        if held is None:
            return batch.column("good").to_numpy(zero_copy_only=False)
        own = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
        at = np.searchsorted(held, own)
        found = np.zeros(len(own), bool)
        found[at < len(held)] = held[at[at < len(held)]] == own[at < len(held)]
        return found & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS))
        for batch in text_batches(batches, "text"):
            for raw, one in zip(batch.column("text").cast(pa.binary()).to_pylist(), trust(batch), strict=True):
                found = np.bincount(buckets(raw), minlength=BUCKETS)
                total[0] += found
                if one:
                    total[1] += found
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    raw, target = summed(chosen.mapInArrow(count, "v binary"), 2 * BUCKETS).reshape(2, BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double, kept boolean"
_NAMES = [field.strip().split(" ")[0] for field in SCHEMA.split(",")]


def judge(docs: DataFrame, learned: np.ndarray, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The base counts, the length-normalised ratio and the verdict of every document."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blank(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            counts, ratios = [], []
            for value in batch.column("text").to_pylist():
                counts.append(base_counts(value))
                ratios.append(_ratio(value.encode(), learned))
            n_words, chars, symbols, lines, repeated = (np.array(x, np.int64) for x in zip(*counts, strict=True))
            failed = _failed(n_words, repeated)
            kept = ~failed & (np.array(ratios) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (n_words, chars, symbols, lines, repeated, failed, np.array(ratios), kept))], names=_NAMES)

    return chosen.mapInArrow(run, SCHEMA)


def verdicts(docs: DataFrame, learned: np.ndarray, labels: DataFrame, text: str = "text") -> DataFrame:
    """``judge`` by the threshold of all labelled documents; texts are scored once, and the scores written."""
    judged = materialize(judge(docs, learned, text), "scores")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= cut_of(judged, labels)))
