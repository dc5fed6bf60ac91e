"""Periodic runs of words: stretches that repeat a phrase over and over.

A run is a stretch of consecutive words with smallest period ``q``, of
``max(6, 4 q)`` words or more, that no neighbouring word extends keeping the
period.  On diagonal ``q`` it is a row of matches ``word[j] = word[j - q]`` of
``max(6 - q, 3 q)`` words or more, so runs are found by match lengths per lag:

1. *Earlier occurrences.*  The distance to a word's last earlier occurrence
   bounds its lags.  Lags are taken in classes ``[B, 2 B)``; a lag of a class
   can be active only in a stretch of ``3 B`` words that all occurred less than
   ``2 B`` words before.  Ordinary text has none for all but the least lags.
2. *Active lags.*  In such a stretch the earlier occurrences of the ``B`` words
   at a place give its lags.  Places whose ``B`` words already occurred ``B / 2``
   words before or nearer lie inside a run of smaller period and start no lag:
   every period of a run of lag ``q`` holds a place that is not of this kind, and
   the place ``q`` before it is not either.  So a place has three earlier ones at
   most, also in a text of one word a million times.
3. *Match lengths.*  Along an active diagonal each match adds one to the length
   and each mismatch ends it; an ended diagonal that is long enough is a run.  A
   multiple of a run's period ends at the same words; the smallest lag stays.

Each document is handled alone and whole; memory is linear in its words, time
``n log n`` steps of numpy (and one pass for each active lag of a stretch).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.tables import arrow_map, schema_after

#: Least words and least repetitions of a run.
MIN_WORDS = 6
MIN_PERIODS = 4

Run = tuple[int, int, int]

_RESULT = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def _distances(ids: np.ndarray) -> np.ndarray:
    """Words back to the last earlier occurrence of each word (longer than the text without one)."""
    order = np.argsort(ids, kind="stable")
    out = np.full(len(ids), len(ids) + 1, np.int64)
    again = np.flatnonzero(ids[order[1:]] == ids[order[:-1]])
    out[order[again + 1]] = order[again + 1] - order[again]
    return out


def _stretches(inside: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Bounds of the stretches of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    first, end = edges[::2], edges[1::2]
    long = end - first >= least
    return list(zip(first[long].tolist(), end[long].tolist()))


def _grams(words: np.ndarray, length: int) -> np.ndarray:
    """Equal numbers for equal stretches of ``length`` words (a power of two), by doubling."""
    g, have = words, 1
    while have < length:
        pairs = g[:-have] * (int(g.max()) + 1) + g[have:]
        g, have = np.unique(pairs, return_inverse=True)[1].astype(np.int64), 2 * have
    return g


def _active_lags(words: np.ndarray, b: int) -> np.ndarray:
    """Lags of ``[b, 2 b)`` at which two places that start a diagonal hold the same ``b`` words, in order."""
    if len(words) < 2 * b:
        return np.zeros(0, np.int64)
    g = _grams(np.unique(words, return_inverse=True)[1].astype(np.int64), b)
    at = np.argsort(g, kind="stable")
    gram = g[at]
    starts = np.ones(len(at), bool)
    starts[1:] = (gram[1:] != gram[:-1]) | (2 * (at[1:] - at[:-1]) > b)
    at, gram = at[starts], gram[starts]
    lags = []
    for k in range(1, len(at)):
        lag = at[k:] - at[:-k]
        near = (gram[k:] == gram[:-k]) & (lag < 2 * b)
        if not near.any():
            break
        lags.append(lag[near & (lag >= b)])
    return np.unique(np.concatenate(lags)) if lags else np.zeros(0, np.int64)


def runs_of(ids: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[Run]:
    """``(start, length, period)`` of every run of a text given as word numbers, by start and period.

    ``min_periods`` must be 4 or more (what step 2 of the method rests on).
    """
    if min_periods < 4:
        raise ValueError("a run has 4 periods or more")
    n = len(ids)
    found: dict[tuple[int, int], int] = {}
    if n < max(min_words, min_periods):
        return []
    distance = _distances(ids)
    b = 1
    while min_periods * b <= n:
        for lo, hi in _stretches(distance < 2 * b, (min_periods - 1) * b):
            for q in _active_lags(ids[max(0, lo - 2 * b + 1) : hi], b).tolist():
                first = max(lo, q)
                match = ids[first:hi] == ids[first - q : hi - q]
                for s, e in _stretches(match, max(min_words - q, (min_periods - 1) * q)):
                    key = (first + s - q, e - s + q)
                    found[key] = min(q, found.get(key, q))
        b *= 2
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for s, length, q in runs:
        change[s + q] += 1
        change[s + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def repeat_tail(words: list[bytes], key: int) -> list[bytes]:
    """The words with a periodic tail where the CRC-32 of the key says so (known cases in every tenth text)."""
    h, n = zlib.crc32(str(key).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _numbered(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _row(text: bytes, key: int | None, tails: bool) -> tuple:
    words = text.split()  # of bytes: at 0x20 and 0x09-0x0D, no others
    if tails and key is not None:
        words = repeat_tail(words, key)
    runs = runs_of(_numbered(words)) if len(words) >= MIN_WORDS else []
    s, length, q = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    listing = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (
        len(runs),
        s,
        length,
        q,
        1000 * length // q if runs else None,
        hashlib.sha256(listing.encode()).hexdigest(),
        hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
    )


def _spans_row(text: bytes) -> tuple:
    words = text.split()
    runs = runs_of(_numbered(words))
    spans = [{"start": s, "length": length, "period": q} for s, length, q in runs]
    return spans, b" ".join(collapsed(words, runs)).decode("utf-8", "replace")


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in batch.column(1).cast(pa.large_binary()):
        yield text.as_py() or b""


def periodic_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tails: bool = False) -> DataFrame:
    """One row per document: its number of runs, the longest one and digests of all runs and of the collapsed text.

    ``exponent_milli`` is ``floor(1000 length / period)``; ties of length go to
    the smallest start, then period.  A null or empty text has no words, no run
    and four nulls; rows with a null or repeated id are rows like others.
    ``tails`` makes the texts periodic by their id first (:func:`repeat_tail`;
    a null id never).
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema_names
        for batch in batches:
            ids = batch.column(0)
            found = [_row(text, key, tails) for text, key in zip(_texts(batch), ids.to_pylist())]
            columns = list(zip(*found)) if found else [()] * 7
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.string()) for c in columns[5:]]
            yield pa.RecordBatch.from_arrays([ids, *arrays], names)

    picked = docs.select(id_col, text_col)
    schema = schema_after(picked, id_col, _RESULT)
    schema_names = schema.names
    return arrow_map(picked, rows, schema)


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``runs`` (array of start, length, period) and the ``text`` collapsed, its words joined by one space.

    Null texts are empty.  What a corpus job uses; :func:`periodic_digests` has the short form.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            found = [_spans_row(text) for text in _texts(batch)]
            arrays = [pa.array([f[0] for f in found], kind), pa.array([f[1] for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [id_col, "runs", "text"])

    picked = docs.select(id_col, text_col)
    schema = schema_after(picked, id_col, "runs array<struct<start: long, length: long, period: long>>, text string")
    return arrow_map(picked, rows, schema)
