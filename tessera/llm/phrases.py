"""Phrase collocations, counted over a prefix-free parsing of the corpus.

1. *Parsing.*  A text is lower-cased (A-Z) and cut into pieces and words.  Where
   the hash of three words in a row is divisible by ``TRIGGER``, a chunk ends with
   these three words and the next one starts with them; a stretch of ``LONGEST``
   words without such a place is cut there.  The chunks of a text overlap by three
   words, so each run of up to four words starts in the own part of one chunk
   and lies in it whole: it is counted there, and only there.  Passages that texts
   share become the same chunks wherever they stand.
2. *Dictionary.*  Distinct chunks per language with their number of
   occurrences, an aggregate that combines in the map tasks.
3. *Counts.*  The n-grams of each distinct chunk weigh as much as the chunk
   occurs.  Rare ones are left out by what they cannot reach: every n-gram adds
   its weight to one of up to ``2^MAX_BITS`` counters (a fixed bound, whatever
   the corpus), counters saturate at the least count wanted, and an n-gram is a
   row only if its own counter and those of all its parts reach it.  The counters
   never lose a frequent n-gram; the counts themselves are exact sums over the
   phrases' text.
4. *Scores*, in decimals: joins of phrases with their parts, by cut and by
   containing phrase.

No task gathers a language: counts, joins and the first ranks per language are
spread by phrase, and the last rank is over a bounded number of rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.tables import arrow_map, small_side, written
from tessera.llm.words import constants, mix64, slices, span_hashes, spans

#: Words of the longest phrase.
LONGEST_PHRASE = 4
#: Words that two chunks share, and that decide where a chunk ends.
OVERLAP = LONGEST_PHRASE - 1
#: One place in so many ends a chunk.
TRIGGER = 16
#: Words of the own part of a chunk at most.
LONGEST = 256

MIN_COUNT = 30
TOP = 2000
SCALE = 2_000_000
#: A phrase goes if a longer one around it has this share of its count (percent).
COVERED = 80

#: Counters of the filter at most (as a power of two), and in one row of it.
MAX_BITS = 26
SLICE_BITS = 16
#: Parts of a language that rank their phrases apart before the last rank.
RANK_PARTS = 64

#: Fixed values of the contract: what ends a piece, and what parts words.
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_BLANKS = b" \t"

_BLANK, _END = 0x20, 0x0A
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[ord("A") : ord("Z") + 1] += 32
_CLEAN[list(_PIECE_ENDS)] = _END
_CLEAN[list(_BLANKS)] = _BLANK
_WINDOW = constants(29, OVERLAP)
_SEED = constants(31, 1)[0]


def _cleaned(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one blank between words and one line feed between pieces, and their new bounds."""
    data = _CLEAN[data]
    sep = (data == _BLANK) | (data == _END)
    first = sep.copy()
    first[1:] &= ~sep[:-1]
    inner = offsets[1:-1]
    first[inner[inner < len(data)]] = sep[inner[inner < len(data)]]  # a text's separators are its own
    heads = np.flatnonzero(first)
    if len(heads):
        runs = np.cumsum(first)[sep] - 1  # the separator run of each separator
        has_end = np.bincount(runs, weights=data[sep] == _END, minlength=len(heads)) > 0
        data[heads] = np.where(has_end, _END, _BLANK)
    keep = ~sep | first
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def _chunk_starts(h: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the chunks of all texts, and the end (first word behind) of each one's text."""
    total = len(h)
    bounds = np.concatenate([[0], np.cumsum(n_words)])
    start = np.zeros(total + 1, bool)
    if total >= OVERLAP:
        m = total - OVERLAP + 1
        with np.errstate(over="ignore"):
            window = mix64(sum(h[j : j + m] * _WINDOW[j] for j in range(OVERLAP)))
        start[:m] = window % np.uint64(TRIGGER) == 0
    # a window must lie in one text
    for k in range(1, OVERLAP):
        at = bounds[1:] - k
        start[at[at >= 0]] = False
    start[bounds[:-1]] = True
    start[total] = False
    at = np.flatnonzero(start)
    ends = bounds[np.searchsorted(bounds, at, side="right")]
    gaps = np.diff(np.append(at, total))
    cuts = []
    for i in np.flatnonzero(gaps > LONGEST).tolist():
        more = np.arange(at[i] + LONGEST, at[i] + gaps[i], LONGEST)
        cuts.append(more[more + OVERLAP <= ends[i]])
    if cuts:
        at = np.sort(np.concatenate([at, *cuts]))
        ends = bounds[np.searchsorted(bounds, at, side="right")]
    return at, ends


def chunks_of(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The chunks of a slice of texts in order, and the text of each.

    The last chunk of a text ends with a line feed and is its own up to the end;
    any other one ends with ``OVERLAP`` words that belong to the next.
    """
    data, offsets = _cleaned(data, offsets)
    starts, ends, n_words = spans(data, offsets)
    if not len(starts):
        return [], np.zeros(0, np.int64)
    at, text_end = _chunk_starts(span_hashes(data, starts, ends), n_words)
    following = np.append(at[1:], len(starts))
    last = following >= text_end
    stop = ends[np.where(last, text_end, following + OVERLAP) - 1]
    raw = data.tobytes()
    out = [raw[a:b] + b"\n" if z else raw[a:b] for a, b, z in zip(starts[at].tolist(), stop.tolist(), last.tolist())]
    text = np.searchsorted(np.cumsum(n_words), at, side="right")
    return out, text


def _chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(0)
        for lo, _, data, offsets in slices(batch.column(1)):
            found, text = chunks_of(data, offsets)
            if found:
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(text + lo)), pa.array(found, pa.binary())], ["lang", "chunk"])


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Distinct chunks: ``lang, chunk, n`` (``lang`` null is ``und``; empty and null texts have none)."""
    picked = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    found = arrow_map(picked, _chunk_batches, "lang string, chunk binary")
    return found.groupBy("lang", "chunk").agg(F.count("*").alias("n"))


class _Grams:
    """The n-grams that start in the own part of the chunks of a batch slice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, weights: np.ndarray) -> None:
        self.data = data
        starts, ends, n_words = spans(data, offsets)
        self.starts, self.ends = starts, ends
        total = len(starts)
        chunk = np.repeat(np.arange(len(n_words)), n_words)
        final = np.zeros(len(n_words), bool)
        has = offsets[1:] > offsets[:-1]
        final[has] = data[offsets[1:][has] - 1] == _END
        own_end = np.cumsum(n_words) - np.where(final, 0, OVERLAP)
        place = np.arange(total)
        self.own = place < own_end[chunk]
        self.weights = weights[chunk]
        self.chunk = chunk
        self.seeds = seeds[chunk]
        # whether the next word belongs to the same piece of the same chunk
        self.joined = np.zeros(total, bool)
        if total > 1:
            self.joined[:-1] = (chunk[1:] == chunk[:-1]) & (data[ends[:-1]] == _BLANK)

    def spans_of(self, n: int) -> np.ndarray:
        """First words of the n-grams of ``n`` words, in overlaps too."""
        ok = np.ones(len(self.starts), bool)
        for k in range(n - 1):
            ok[: len(ok) - k] &= self.joined[k:]
            ok[len(ok) - k :] = False
        return np.flatnonzero(ok)

    def buckets(self, first: np.ndarray, n: int, bits: int) -> np.ndarray:
        h = span_hashes(self.data, self.starts[first], self.ends[first + n - 1])
        return (mix64(h ^ self.seeds[first]) >> np.uint64(64 - bits)).astype(np.int64)


def _lang_seeds(langs: pa.Array) -> np.ndarray:
    kinds = langs.dictionary_encode()
    seeds = np.array([zlib.crc32(x.encode()) + (zlib.adler32(x.encode()) << 32) for x in kinds.dictionary.to_pylist()], np.uint64)
    with np.errstate(over="ignore"):
        return mix64(seeds * _SEED)[kinds.indices.to_numpy()] if len(seeds) else np.zeros(0, np.uint64)


def _gram_slices(batch: pa.RecordBatch) -> Iterator[tuple[_Grams, int]]:
    langs, weights = batch.column(0), batch.column(2).to_numpy()
    seeds = _lang_seeds(langs)
    text = batch.column(1).cast(pa.large_binary()).view(pa.large_string())
    for lo, hi, data, offsets in slices(text):
        yield _Grams(data, offsets, seeds[lo:hi], weights[lo:hi]), lo


def _counter_batches(batches: Iterator[pa.RecordBatch], bits: int, least: int) -> Iterator[pa.RecordBatch]:
    """A task's counters, saturated at ``least``, in rows of a slice each."""
    counters = np.zeros(1 << bits, np.uint8)
    for batch in batches:
        for grams, _ in _gram_slices(batch):
            for n in range(1, LONGEST_PHRASE + 1):
                first = grams.spans_of(n)
                first = first[grams.own[first]]
                at, inverse = np.unique(grams.buckets(first, n, bits), return_inverse=True)
                add = np.bincount(inverse, weights=np.minimum(grams.weights[first], least), minlength=len(at))
                counters[at] = np.minimum(counters[at] + np.minimum(add, least), least).astype(np.uint8)
    step = 1 << min(SLICE_BITS, bits)
    for s in range(0, len(counters), step):
        part = counters[s : s + step]
        if part.any():
            packed = zlib.compress(part.tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([s // step]), pa.array([packed], pa.binary())], ["slice", "counters"])


def _merged_batches(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """One bit a counter: whether the tasks' sum reaches ``least``; a task holds the sums of its slices, no rows."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(zlib.decompress(packed.as_py()), np.uint8)
            sums[s] = np.minimum(sums[s] + part, least).astype(np.uint8) if s in sums else part
    rows = [(s, np.packbits(v >= least).tobytes()) for s, v in sums.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary())], ["slice", "bits"])


def frequent_buckets(chunks: DataFrame, bits: int, least: int) -> np.ndarray:
    """``2^bits`` bits (packed): which counters reach ``least``; at most ``2^MAX_BITS`` bits come to the driver."""
    if not 0 < least < 128:
        raise ValueError("counters of a byte: the least count is 1 to 127")
    parts = arrow_map(chunks, lambda b: _counter_batches(b, bits, least), "slice long, counters binary")
    n_slices = max(1, (1 << bits) >> SLICE_BITS)
    # each task of the chunks sends its counters, so the tasks that add them up grow with those
    wide = max(chunks.sparkSession.sparkContext.defaultParallelism, chunks.rdd.getNumPartitions() // 8)
    dealt = parts.repartition(min(n_slices, wide), "slice")
    rows = arrow_map(dealt, lambda b: _merged_batches(b, least), "slice long, bits binary").collect()
    out = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    step = (1 << min(SLICE_BITS, bits)) // 8
    for r in rows:
        out[r["slice"] * step : (r["slice"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
    return out


def _count_batches(batches: Iterator[pa.RecordBatch], held: Broadcast, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows ``lang, phrase, words, n`` of the n-grams that may be frequent, and per slice the words of each language
    (``words`` 0)."""
    packed = held.value
    for batch in batches:
        langs = batch.column(0)
        for grams, lo in _gram_slices(batch):
            total = len(grams.starts)
            before: np.ndarray | None = None
            raw = grams.data.tobytes()
            for n in range(1, LONGEST_PHRASE + 1):
                first = grams.spans_of(n)
                if before is not None:
                    first = first[before[first] & before[np.minimum(first + 1, total - 1)]]
                at = grams.buckets(first, n, bits)
                first = first[(packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
                before = np.zeros(total, bool)
                before[first] = True
                first = first[grams.own[first]]
                if len(first):
                    pairs = zip(grams.starts[first].tolist(), grams.ends[first + n - 1].tolist())
                    yield _rows(langs.take(pa.array(grams.chunk[first] + lo)), [raw[a:b] for a, b in pairs], n, grams.weights[first])
            if total:
                own = np.bincount(grams.chunk[grams.own], weights=grams.weights[grams.own], minlength=1)
                here = np.flatnonzero(own)
                yield _rows(langs.take(pa.array(here + lo)), [b""] * len(here), 0, own[here].astype(np.int64))


def _rows(langs: pa.Array, phrases: list[bytes], words: int, n: np.ndarray) -> pa.RecordBatch:
    size = np.full(len(phrases), words, np.int32)
    text = pa.array(phrases, pa.binary()).view(pa.string())
    return pa.RecordBatch.from_arrays([langs, text, pa.array(size), pa.array(n)], ["lang", "phrase", "words", "n"])


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang", max_bits: int = MAX_BITS) -> DataFrame:
    """``lang, phrase, words, n``: all phrases of 1 to 4 words that occur ``least`` times or more in a language, and
    with ``words`` 0 the number of all words of each language."""
    chunks = written(dictionary(docs, text_col, lang_col), "chunks")
    size = chunks.agg(F.sum(F.length("chunk"))).first()[0] or 0
    # about two counters an n-gram, as far as the bound allows
    bits = min(max_bits, max(SLICE_BITS, int(size).bit_length() + 1))
    held = chunks.sparkSession.sparkContext.broadcast(frequent_buckets(chunks, bits, least))
    rows = arrow_map(chunks, lambda b: _count_batches(b, held, bits), "lang string, phrase string, words int, n long")
    counts = written(rows.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(f"words = 0 OR n >= {least}"), "counts")
    held.destroy()
    return counts


def collocations(counts: DataFrame, top: int = TOP, scale: int = SCALE, covered: int = COVERED) -> DataFrame:
    """The first ``top`` phrases of each language by score from :func:`phrase_counts`:
    ``lang, rank, phrase, a, l, r, n, score``.

    A cut of a phrase in two parts of counts ``l`` and ``r`` scores ``floor(scale
    * a / (l + r))``; the lowest cut counts (ties: the first).  Phrases that stand
    inside a longer one with ``covered`` percent of their count go.  Order: score
    and ``a`` descending, then the phrase by its bytes.
    """
    wide = "decimal(38,0)"
    parts = counts.where("words BETWEEN 1 AND 3")
    n_parts = parts.count()
    cuts = counts.where("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = cuts.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "words", "a", "k",
        F.concat_ws(" ", F.expr("slice(w, 1, k)")).alias("head"),
        F.concat_ws(" ", F.expr("slice(w, k + 1, words - k)")).alias("tail"),
    )
    left = small_side(parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), n_parts)
    right = small_side(parts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), n_parts)
    met = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"])
    score = F.expr(f"CAST({scale} * CAST(a AS {wide}) DIV (CAST(l AS {wide}) + r) AS BIGINT)")
    scored = met.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("best"))

    longer = counts.where("words >= 3").select("lang", "words", "n", F.split("phrase", " ").alias("w"))
    inside = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inside = inside.withColumn("at", F.explode(F.expr("sequence(1, words - size + 1)")))
    inside = inside.select("lang", F.concat_ws(" ", F.expr("slice(w, at, size)")).alias("phrase"), F.col("n").alias("around"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    left_over = scored.join(inside, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | F.expr(f"100 * CAST(around AS {wide}) < {covered} * CAST(best.a AS {wide})")
    )

    order = [F.col("best.score").desc(), F.col("best.a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = left_over.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    ranked = first.where(F.col("place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    sums = counts.where("words = 0").select("lang", F.col("n").alias("total"))
    out = ranked.where(F.col("rank") <= top).join(small_side(sums), "lang")
    return out.select("lang", "rank", "phrase", "best.a", "best.l", "best.r", F.col("total").alias("n"), "best.score")
