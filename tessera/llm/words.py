"""Words of a batch of texts as numpy arrays over the UTF-8 bytes.

A word is a run of ``[^\\x20\\x09-\\x0D]``.  Everything here works on the
concatenated bytes of an Arrow string column, a few megabytes at a time, so
a task holds one slice of its batch (or one long text) and no Python string
per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; a longer single text is handled alone and whole.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on uint64 arrays (wraps)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix64(np.uint64(_BASE) * (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003))) | np.uint64(1)


_BYTE = constants(1, 256)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(0, np.uint64), np.ones(0, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        tables = []
        for base in (_BASE, _BASE_INV):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            with np.errstate(over="ignore"):
                np.multiply.accumulate(t, out=t)
            tables.append(t)
        if size > 4 * SLICE_BYTES:  # a very long text: not kept
            return tables[0], tables[1]
        _powers = (tables[0], tables[1])
    return _powers


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words of each text."""
    n_texts = len(offsets) - 1
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(n_texts, np.int64)
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    first = offsets[:-1]
    before[first[first < len(data)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    cut = np.searchsorted(starts, offsets)
    return starts, ends, np.diff(cut)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of every span (equal bytes, equal hash)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, inverses = _power_tables(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[_LOWER[data] if lower else data] * powers[: len(data)], out=sums[1:])
        h = (sums[ends] - sums[starts]) * inverses[starts]
        return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
