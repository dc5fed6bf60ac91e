"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features of a text are the distinct hashes of its lower-cased words, of pairs
of neighbouring words and of pairs with one word between them, without the
marks around words.  FTRL-proximal keeps a gradient sum and a squared-gradient
sum per coordinate, so each has its own rate, and its L1 term keeps weights of
rare or useless features at exactly 0.

Training learns from at most ``MAX_TRAINING`` labelled documents (those with the
smallest hashes), one text each, and at most ``MAX_TRAINING_BYTES`` of features
(4 bytes each; the first texts in order) as one online stream; the features are
made in parallel.  The weights are at most ``2^BITS`` numbers whatever the input, and are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import arrow_map, schema_after, small_side, written
from tessera.llm.words import constants, mix64, slices, span_hashes, spans

#: Hashed feature space.
BITS = 20
#: Most labelled documents that training reads, and most bytes of their features that it learns from.
MAX_TRAINING = 20_000
MAX_TRAINING_BYTES = 512 << 20
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.01

_PAIR = constants(31, 2)
_SKIP = constants(37, 2)
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?'\"()[]{}<>#*$%&|-_=+/\\~`^@"]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased words without ASCII marks at their ends, and words per text."""
    starts, ends, n_words = spans(data, offsets)
    inside = np.append(~_MARK[data], True)
    # next byte that is no mark, from each start; last one before each end
    solid = np.flatnonzero(inside)
    first = solid[np.searchsorted(solid, starts)] if len(starts) else starts
    last = solid[np.maximum(np.searchsorted(solid, ends) - 1, 0)] + 1 if len(ends) else ends
    plain = (first < ends) & (last > starts)
    return span_hashes(data, np.where(plain, first, starts), np.where(plain, last, ends), lower=True), n_words


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (with repeats) and the text of each."""
    h, n_words = word_hashes(data, offsets)
    text = np.repeat(np.arange(len(n_words)), n_words)
    shift = np.uint64(64 - BITS)
    parts, of = [mix64(h)], [text]
    with np.errstate(over="ignore"):
        for step, c in ((1, _PAIR), (2, _SKIP)):
            if len(h) > step:
                same = text[:-step] == text[step:]
                parts.append(mix64(h[:-step] * c[0] + h[step:] * c[1])[same])
                of.append(text[:-step][same])
    return (np.concatenate(parts) >> shift).astype(np.int32), np.concatenate(of)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(2)):
            number, text = features(data, offsets)
            order = np.argsort(text, kind="stable")
            number, bounds = number[order], np.searchsorted(text[order], np.arange(hi - lo + 1))
            rows = [np.unique(number[bounds[i] : bounds[i + 1]]).tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(rows, pa.binary())], ["order", "label", "features"]
            )


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss on sets of features; coordinate ``2^BITS`` is the intercept."""

    def __init__(self, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, i: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, i: np.ndarray, label: float) -> None:
        w = self.weights(i)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[i] = n + g * g


def _train_batches(batches: Iterator[pa.RecordBatch], epochs: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The whole bounded stream, sorted by order, in one task; later rounds read the features kept from the first."""
    model, kept = Ftrl(), []
    intercept = np.int32(1 << BITS)
    last, held = None, 0

    def learn(part: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> None:
        rows, labels, at, found = part
        for k in rows:
            model.learn(np.append(found[at[k] : at[k + 1]], intercept), labels[k])

    for batch in batches:  # views of the batches: no object per text
        if not batch.num_rows:
            continue
        column = batch.column(2).cast(pa.large_binary())
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] // 4
        order = np.asarray(batch.column(0))
        new = np.append(last is None or order[0] != last, order[1:] != order[:-1])  # further texts of a document
        last = order[-1]
        total = held + 4 * np.cumsum(np.where(new, np.diff(at), 0))
        held = int(total[-1])
        part = (np.flatnonzero(new & (total <= most_bytes)), np.asarray(batch.column(1)), at, np.frombuffer(data or b"", np.int32))
        if len(part[0]):
            learn(part)
            if epochs > 1:
                kept.append(part)
    for _ in range(epochs - 1):
        for part in kept:
            learn(part)
    w = model.weights(slice(None))
    used = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(w[used])], ["feature", "weight"])


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MAX_TRAINING, epochs: int = EPOCHS, most_bytes: int = MAX_TRAINING_BYTES
) -> np.ndarray:
    """Weights (the last is the intercept) from the labelled rows given; null labels, ids and texts are left out.

    Of several texts of one id the one with the smallest features is learned from.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("known_id")).agg(F.max(label_col).cast("double").alias("label"))
    known = known.withColumn("order", F.xxhash64("known_id"))
    sample = written(known.orderBy("order", "known_id").limit(most), "training")
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(small_side(sample), F.col("doc_id") == F.col("known_id")).select("order", "label", "text")
    found = arrow_map(rows, _feature_batches, "order long, label double, features binary")
    stream = found.repartition(1).sortWithinPartitions("order", "features").select("order", "label", "features")
    weights = np.zeros((1 << BITS) + 1, np.float32)
    for r in arrow_map(stream, partial(_train_batches, epochs=epochs, most_bytes=most_bytes), "feature int, weight double").collect():
        weights[r["feature"]] = r["weight"]
    return weights


def _score_batches(batches: Iterator[pa.RecordBatch], held: Broadcast) -> Iterator[pa.RecordBatch]:
    number, weight = held.value
    dense = np.zeros((1 << BITS) + 1, np.float32)
    dense[number] = weight
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            found, text = features(data, offsets)
            has = dense[found] != 0
            pair = np.unique(text[has].astype(np.int64) << 32 | found[has])
            total = np.bincount(pair >> 32, dense[pair & 0xFFFFFFFF].astype(float), hi - lo) + float(dense[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], ["doc_id", "score"]
            )


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Rows that no training may read: ``crc32`` of the id as text, modulo ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def toxicity(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` per row of ``docs``.

    Null and empty texts get the intercept's score; repeated rows give repeated
    results; other columns are not read.  No shuffle.
    """
    used = np.flatnonzero(weights)
    held = docs.sparkSession.sparkContext.broadcast((used, weights[used]))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = arrow_map(rows, partial(_score_batches, held=held), schema_after(rows, "doc_id", "score double"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
