"""Quality by regularised quadratic discriminant analysis of document statistics.

Statistics of a text (lengths, shares of character classes, repetition) are
transformed (logarithms, log-odds) to be nearly normal.  Spark sums the
moments of each class over all labelled training rows; the driver shrinks the
class covariances towards a common diagonal and keeps their Cholesky factors
(a few hundred numbers), and a score is the difference of the two
Mahalanobis log-densities with the class shares, as a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.divergence import _dup_lines, _histograms, _per_text, _repeat_words
from tessera.llm.tables import arrow_map, schema_after, small_side, written
from tessera.llm.words import mix64, slices, span_hashes, spans

#: Weight of the diagonal target in a class covariance, and the least variance.
SHRINKAGE = 0.1
LEAST_VARIANCE = 0.01

NAMES = (
    "log_words log_word_length log_line_words upper digit space mark symbol beyond_ascii distinct top_word top_word_2 dup_lines repeat_words "
    "ends_letter wordless class_entropy capital_start"
).split()
N_STATS = len(NAMES)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log-odds of ``part / whole`` with half a count on both sides."""
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Transformed statistics, one row per text (a text without words has fixed values)."""
    n = len(offsets) - 1
    starts, ends, n_words = spans(data, offsets)
    h = span_hashes(data, starts, ends, lower=True)
    text = np.repeat(np.arange(n), n_words)
    classes = _histograms(data, offsets)
    chars = classes.sum(1)
    solid = chars - classes[:, 3]
    # distinct words and how often the two most frequent ones stand
    with np.errstate(over="ignore"):
        key = mix64(h + mix64(text.astype(np.uint64)))
    _, at, runs = np.unique(key, return_index=True, return_counts=True)
    of = text[at]
    distinct = np.bincount(of, minlength=n)
    rank = np.lexsort((-runs, of))
    first = np.searchsorted(of[rank], np.arange(n))
    top, second = np.zeros(n), np.zeros(n)
    has = distinct > 0
    top[has] = runs[rank][first[has]]
    has = distinct > 1
    second[has] = runs[rank][first[has] + 1]
    lines = _per_text(data == 0x0A, offsets) + 1
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    letter = (last | 0x20 >= 0x61) & (last | 0x20 <= 0x7A) & (last < 0x80) | (last >= 0x80)
    begin = data[starts] if len(starts) else np.zeros(0, np.uint8)
    wordy = _per_word_letters(data, starts, ends)
    p = classes / np.maximum(1, chars)[:, None]
    entropy = -np.where(p > 0, p * np.log2(np.maximum(p, 1e-12)), 0).sum(1)
    count = lambda flags: np.bincount(text[flags], minlength=n)
    return np.column_stack(
        [
            np.log1p(n_words),
            np.log((solid + 1) / (n_words + 1)),
            np.log((n_words + 1) / lines),
            _share(classes[:, 1], solid),
            _share(classes[:, 2], solid),
            _share(classes[:, 3], chars),
            _share(classes[:, 4], solid),
            _share(classes[:, 5], solid),
            _share(classes[:, 7], solid),
            _share(distinct, n_words),
            _share(top, n_words),
            _share(second, n_words),
            _share(_dup_lines(data, offsets, starts), lines),
            _share(_repeat_words(h, n_words), n_words),
            _share(count(letter), n_words),
            _share(count(~wordy), n_words),
            entropy,
            _share(count((begin >= 0x41) & (begin <= 0x5A)), n_words),
        ]
    )


def _per_word_letters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each word holds a letter (ASCII or beyond)."""
    letters = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A) & (data < 0x80) | (data >= 0x80)
    sums = np.concatenate([[0], np.cumsum(letters)])
    return sums[ends] > sums[starts]


def _statistic_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            x = statistics(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "stats"]
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), N_STATS)


def _moment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class: count, sums and sums of products of the task's rows, as (label, position, value)."""
    sums = {0: np.zeros((N_STATS + 1, N_STATS + 1)), 1: np.zeros((N_STATS + 1, N_STATS + 1))}
    for batch in batches:
        label = np.array(batch.column(0).to_pylist())
        x = np.column_stack([np.ones(len(label)), _matrix(batch.column(1))])
        for k in sums:
            sums[k] += x[label == k].T @ x[label == k]
    for k, m in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, k, np.int32)), pa.array(np.arange(m.size, dtype=np.int32)), pa.array(m.ravel())], ["label", "at", "value"])


class Qda:
    """Means, Cholesky factors of the shrunk covariances, log-determinants and log-shares of both classes."""

    def __init__(self, moments: dict[int, np.ndarray], shrinkage: float = SHRINKAGE):
        total = sum(m[0, 0] for m in moments.values())
        pooled = np.zeros(N_STATS)
        parts = {}
        for k, m in moments.items():
            n = m[0, 0]
            mean = m[0, 1:] / max(n, 1)
            cov = m[1:, 1:] / max(n, 1) - np.outer(mean, mean)
            parts[k] = (n, mean, cov)
            pooled += n / max(total, 1) * np.diag(cov)
        pooled = np.maximum(pooled, LEAST_VARIANCE)
        self.classes = {}
        for k, (n, mean, cov) in parts.items():
            w = shrinkage if n > 10 * N_STATS else max(shrinkage, 1 - n / (20.0 * N_STATS))  # few rows: nearer the diagonal
            cov = (1 - w) * cov + w * np.diag(np.maximum(np.diag(cov), 0.1 * pooled)) + LEAST_VARIANCE * np.eye(N_STATS)
            factor = np.linalg.cholesky(cov)
            self.classes[k] = (mean, np.linalg.inv(factor), np.log(np.diag(factor)).sum(), np.log((n + 1) / (total + 2)))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        density = {}
        for k, (mean, inverse, log_det, log_share) in self.classes.items():
            y = (x - mean) @ inverse.T
            density[k] = log_share - log_det - (y * y).sum(1) / 2
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def _score_batches(batches: Iterator[pa.RecordBatch], held: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held.value.score(_matrix(batch.column(1))))], ["doc_id", "score"])


def train(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Qda:
    """A :class:`Qda` of all labelled rows of ``stats``; null labels and ids are left out."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("known_id")).agg(F.max(label_col).cast("int").alias("label"))
    rows = stats.join(small_side(written(known, "known")), F.col("doc_id") == F.col("known_id")).select("label", "stats")
    found = arrow_map(rows, _moment_batches, "label int, at int, value double").groupBy("label", "at").agg(F.sum("value").alias("value"))
    moments = {k: np.zeros((N_STATS + 1) ** 2) for k in (0, 1)}
    for r in found.collect():
        moments[r["label"]][r["at"]] = r["value"]
    return Qda({k: m.reshape(N_STATS + 1, N_STATS + 1) for k, m in moments.items()})


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, stats`` (the statistics as packed doubles), one pass over the texts."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, _statistic_batches, schema_after(rows, "doc_id", "stats binary"))


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """``doc_id, score, predicted`` per row of ``docs``, learned from the rows of ``labels``.

    Null and empty texts have the statistics of an empty text and a score like
    any other; repeated rows give repeated results (a repeated label row counts
    once); without labels of both classes scores follow the class shares.
    Other columns are not read.
    """
    stats = written(document_statistics(docs, id_col, text_col), "statistics")
    held = docs.sparkSession.sparkContext.broadcast(train(stats, labels.withColumnRenamed(id_col, "doc_id"), "doc_id", label_col))
    scored = arrow_map(stats, partial(_score_batches, held=held), schema_after(stats, "doc_id", "score double"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
