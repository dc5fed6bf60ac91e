"""Quality rules by distribution divergence.

A document's histogram of character classes and of common words is compared
with the reference of its language by Jensen-Shannon distance (base 2, 0 to
1).  References are counted over all documents.  Common words are those with
at least ``COMMON_SHARE`` of a language's words, found exactly in two passes:

1. every slice of a task reports words with half that share of the slice; what
   is not reported adds up to less than half the share, so at most
   ``2 / COMMON_SHARE`` words of a language can still be common;
2. those candidates are counted.

Every language has its own reference, however small its share of the input.
The ``MOST_LANGUAGES`` languages with the most words are broadcast (a few
hundred words each); documents of any others meet their reference by a join on
the language.  Distances decide only where the reference rests on at least
``MIN_REFERENCE_WORDS`` words of the document's own language: a foreign one says
nothing about a document, so one of a smaller language or without a language
passes by the base rules alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import arrow_map, schema_after, small_side, written
from tessera.llm.words import constants, mix64, slices, span_hashes, spans

COMMON_SHARE = 0.005
#: Share of all words that a language once needed for a reference; decides nothing any more, the tests read it.
LANGUAGE_SHARE = 0.001
#: Languages whose references are broadcast (about 3 KB each).
MOST_LANGUAGES = 2000
#: Distances above these reject a document ...
MOST_CLASS_DISTANCE = 0.3
MOST_WORD_DISTANCE = 0.4
#: ... that has at least so many words.
MIN_WORDS = 50
MIN_WORDS_COMMON = 50
#: Words of a language from which its reference decides: a word with the least common share is expected 10 times.
MIN_REFERENCE_WORDS = round(10 / COMMON_SHARE)

#: Classes: lower case, upper case, digit, white space, sentence marks, other ASCII marks, control, beyond ASCII.
N_CLASSES = 8
_CLASS = np.full(256, 6, np.uint8)
_CLASS[0x21:0x7F] = 5
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 3
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_CLASS[0xC0:] = 7
_CLASS[0x80:0xC0] = N_CLASSES  # continuation bytes are no characters
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_WINDOW = constants(23, 3)
_ALL = ""


def _histograms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Characters of each class per text."""
    n = len(offsets) - 1
    of = np.repeat(np.arange(n, dtype=np.int32), np.diff(offsets))
    flat = np.bincount(of * np.int32(N_CLASSES + 1) + _CLASS[data], minlength=n * (N_CLASSES + 1))
    return flat.reshape(n, N_CLASSES + 1)[:, :N_CLASSES]


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeat_words(h: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Words inside 3-word windows that stand twice or more in their text."""
    text = np.repeat(np.arange(len(n_words)), n_words)
    marked = np.zeros(len(h), bool)
    if len(h) >= 3:
        with np.errstate(over="ignore"):
            w = mix64(h[:-2] * _WINDOW[0] + h[1:-1] * _WINDOW[1] + h[2:] * _WINDOW[2] + mix64(text[:-2].astype(np.uint64)))
        at = np.flatnonzero(text[:-2] == text[2:])
        w = w[at]
        order = np.argsort(w, kind="stable")
        same = w[order][1:] == w[order][:-1]
        again = np.zeros(len(w), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        for j in range(3):
            marked[at[again] + j] = True
    return np.bincount(text[marked], minlength=len(n_words)).astype(np.int64)


def _dup_lines(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n = len(offsets) - 1
    if not len(starts):
        return np.zeros(n, np.int64)
    breaks = np.flatnonzero(data == 0x0A)
    begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    text = np.searchsorted(offsets, begin, side="right") - 1
    ok = (begin < len(data)) & (text < n)
    begin, text = begin[ok], text[ok]
    first = np.concatenate([[True], begin[1:] != begin[:-1]])  # an empty text begins where the next one does
    begin, text = begin[first], text[first]
    end = np.append(begin[1:], len(data))
    at_break = (end > begin) & (data[np.maximum(end, 1) - 1] == 0x0A)
    end = end - at_break
    words = np.searchsorted(starts, end) - np.searchsorted(starts, begin)
    begin, end, text = begin[words > 0], end[words > 0], text[words > 0]
    with np.errstate(over="ignore"):
        h = mix64(span_hashes(data, begin, end) + mix64(text.astype(np.uint64)))
    _, where = np.unique(h, return_index=True)
    again = np.ones(len(h), bool)
    again[where] = False
    return np.bincount(text[again], minlength=n).astype(np.int64)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, of the rows of ``p`` and ``q`` (each sums to 1)."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def _slices_with_language(batches: Iterator[pa.RecordBatch], text: int, lang: int):
    for batch in batches:
        langs = batch.column(lang).to_pylist()
        for lo, hi, data, offsets in slices(batch.column(text)):
            yield batch, lo, hi, data, offsets, [x or _ALL for x in langs[lo:hi]]


def _group_words(h: np.ndarray, n_words: np.ndarray, langs: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(language, its texts, its words' hashes) of a slice, and all of them under ``""``."""
    names, of = np.unique(langs, return_inverse=True)
    word_lang = np.repeat(of, n_words)
    for k, name in enumerate(names):
        if name != _ALL:
            yield str(name), np.flatnonzero(of == k), h[word_lang == k]
    yield _ALL, np.arange(len(langs)), h


def _candidate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice and language: words (hash, count) above half the share; hash 0 holds totals and classes."""
    for _, _, _, data, offsets, langs in _slices_with_language(batches, 0, 1):
        starts, ends, n_words = spans(data, offsets)
        h = span_hashes(data, starts, ends, lower=True)
        classes = _histograms(data, offsets)
        out: list[tuple] = []
        for name, texts, words in _group_words(h, n_words, langs):
            out.append((name, 0, len(words), classes[texts].sum(0).tolist()))
            values, counts = np.unique(words, return_counts=True)
            for i in np.flatnonzero(counts >= COMMON_SHARE / 2 * len(words)):
                out.append((name, int(values[i].view(np.int64)), int(counts[i]), None))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())))], ["lang", "word", "n", "classes"]
        )


def _recount_batches(batches: Iterator[pa.RecordBatch], held: Broadcast) -> Iterator[pa.RecordBatch]:
    candidates: dict[str, np.ndarray] = held.value
    for _, _, _, data, offsets, langs in _slices_with_language(batches, 0, 1):
        starts, ends, n_words = spans(data, offsets)
        h = span_hashes(data, starts, ends, lower=True)
        out: list[tuple] = []
        for name, _, words in _group_words(h, n_words, langs):
            if name in candidates:
                counts = _counts(words, np.zeros(len(words), np.int64), 1, candidates[name])[0]
                out += [(name, int(w.view(np.int64)), int(c)) for w, c in zip(candidates[name], counts) if c]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64()))], ["lang", "word", "n"])


def _counts(h: np.ndarray, row: np.ndarray, n_rows: int, vocabulary: np.ndarray) -> np.ndarray:
    """How often each row has each word of the sorted ``vocabulary``."""
    if not len(vocabulary):
        return np.zeros((n_rows, 0), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    hit = vocabulary[at] == h
    return np.bincount(row[hit] * len(vocabulary) + at[hit], minlength=n_rows * len(vocabulary)).reshape(n_rows, -1)


class Reference:
    """Character classes and common words of a language, as shares."""

    def __init__(self, classes: list[int], n_words: int, words: dict[int, int]):
        self.n_words = n_words
        self.classes = np.array(classes, float) / max(1, sum(classes))
        common = sorted((np.uint64(w & 0xFFFFFFFFFFFFFFFF), c) for w, c in words.items() if c >= COMMON_SHARE * n_words)
        self.words = np.array([w for w, _ in common], np.uint64)
        shares = np.array([c for _, c in common], float) / max(1, n_words)
        self.shares = np.append(shares, max(0.0, 1 - shares.sum()))  # the last: all other words


def _sums(docs: DataFrame, lang_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``text, lang`` of the documents, and counts of candidate words per language (word 0: all words, with the classes)."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    found = arrow_map(rows, _candidate_batches, "lang string, word long, n long, classes array<long>")
    return rows, found.groupBy("lang", "word").agg(F.sum("n").alias("n"), *[F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(N_CLASSES)])


def _largest(sums: DataFrame, rows: DataFrame, most: int) -> tuple[dict[str, Reference], DataFrame | None]:
    """References of all documents and of the ``most`` largest languages, and the totals of the other languages if there are any.

    A language with fewer words than a judged document has needs no reference.
    """
    everything = sums.where((F.col("word") == 0) & (F.col("lang") == _ALL)).first()
    if everything is None or not everything["n"]:
        return {_ALL: Reference([0] * N_CLASSES, 0, {})}, None
    known = sums.where((F.col("word") == 0) & (F.col("lang") != _ALL) & (F.col("n") >= MIN_WORDS))
    top = known.orderBy(F.desc("n"), "lang").limit(most + 1).collect()
    totals = {r["lang"]: r for r in [everything, *top[:most]]}
    spark = rows.sparkSession
    large = spark.createDataFrame([(k, COMMON_SHARE / 2 * r["n"]) for k, r in totals.items()], "lang string, least double")
    words = sums.where("word <> 0").join(F.broadcast(large), "lang").where("n >= least").select("lang", "word").collect()
    lists: dict[str, list[np.uint64]] = {lang: [] for lang in totals}
    for w in words:
        lists[w["lang"]].append(np.uint64(w["word"] & 0xFFFFFFFFFFFFFFFF))
    held = spark.sparkContext.broadcast({lang: np.array(sorted(x), np.uint64) for lang, x in lists.items()})
    counted = arrow_map(rows, partial(_recount_batches, held=held), "lang string, word long, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()
    exact: dict[str, dict[int, int]] = {lang: {} for lang in totals}
    for r in counted:
        exact[r["lang"]][r["word"]] = r["n"]
    refs = {lang: Reference([r[f"c{i}"] for i in range(N_CLASSES)], r["n"], exact[lang]) for lang, r in totals.items()}
    return refs, known.join(F.broadcast(large), "lang", "left_anti") if len(top) > most else None


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of all words per slice and language."""
    for _, _, _, data, offsets, langs in _slices_with_language(batches, 0, 1):
        starts, ends, n_words = spans(data, offsets)
        for name, _, words in _group_words(span_hashes(data, starts, ends, lower=True), n_words, langs):
            if name != _ALL:
                values, counts = np.unique(words, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "word", "n"]
                )


def _others(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, total, classes, words, counts`` of the languages in ``totals``; words of small languages are counted completely."""
    known = totals.select("lang", F.col("n").alias("total"), F.array(*[f"c{i}" for i in range(N_CLASSES)]).alias("classes"))
    counts = arrow_map(rows.join(small_side(known.select("lang")), "lang", "left_semi").select("text", "lang"), _word_batches, "lang string, word long, n long")
    counts = counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    common = counts.join(known.select("lang", "total"), "lang").where(F.col("n") >= COMMON_SHARE * F.col("total"))
    lists = common.groupBy("lang").agg(F.collect_list(F.struct("word", "n")).alias("found"))
    return known.join(lists, "lang", "left").select("lang", "total", "classes", F.col("found.word").alias("words"), F.col("found.n").alias("counts"))


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, Reference]:
    """A :class:`Reference` for each of the largest languages, and ``""`` for all documents."""
    rows, sums = _sums(docs, lang_col, text_col)
    return _largest(sums, rows, MOST_LANGUAGES)[0]


def _joined_rule_batches(batches: Iterator[pa.RecordBatch], held: Broadcast) -> Iterator[pa.RecordBatch]:
    """As :func:`_rule_batches`; each row brings the reference of its language."""
    for batch in batches:
        langs, refs = batch.column(2).to_pylist(), {_ALL: held.value[_ALL]}
        for i, lang in enumerate(langs):
            if lang not in refs:
                total, classes, words, counts = (batch.column(j)[i].as_py() for j in range(3, 7))
                refs[lang] = Reference(classes, total, dict(zip(words or (), counts or ())))
        yield from _rules(iter([batch]), refs)


def _rule_batches(batches: Iterator[pa.RecordBatch], held: Broadcast) -> Iterator[pa.RecordBatch]:
    yield from _rules(batches, held.value)


def _rules(batches: Iterator[pa.RecordBatch], refs: dict[str, Reference]) -> Iterator[pa.RecordBatch]:
    """Statistics and distances per row, and whether its own language's reference is large enough to decide."""
    for batch, lo, hi, data, offsets, langs in _slices_with_language(batches, 1, 2):
        starts, ends, n_words = spans(data, offsets)
        exact = span_hashes(data, starts, ends)
        lower = span_hashes(data, starts, ends, lower=True)
        classes = _histograms(data, offsets)
        base = [
            n_words,
            classes.sum(1) - classes[:, 3],
            _per_text(_SYMBOL[data], offsets),
            _dup_lines(data, offsets, starts),
            _repeat_words(exact, n_words),
        ]
        by_class, by_word = np.zeros(hi - lo), np.zeros(hi - lo)
        keys = np.array([x if x in refs else _ALL for x in langs])
        enough = {str(k): k != _ALL and refs[str(k)].n_words >= MIN_REFERENCE_WORDS for k in np.unique(keys)}
        judged = np.array([enough[k] for k in keys.tolist()], bool)
        word_text = np.repeat(np.arange(hi - lo), n_words)
        for key in np.unique(keys):
            ref, mine = refs[str(key)], np.flatnonzero((keys == key) & (n_words > 0))
            if not len(mine):
                continue
            place = np.full(hi - lo, -1)
            place[mine] = np.arange(len(mine))
            row = place[word_text]
            counts = _counts(lower[row >= 0], row[row >= 0], len(mine), ref.words)
            p = np.column_stack([counts, n_words[mine] - counts.sum(1)]) / n_words[mine, None]
            by_word[mine] = _distance(p, np.broadcast_to(ref.shares, p.shape))
            p = classes[mine] / np.maximum(1, classes[mine].sum(1))[:, None]
            by_class[mine] = _distance(p, np.broadcast_to(ref.classes, p.shape))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(lo, hi - lo), *[pa.array(x.astype(np.int64)) for x in base], pa.array(by_class), pa.array(by_word), pa.array(judged)],
            ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "judged"],
        )


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    most_class: float = MOST_CLASS_DISTANCE,
    most_word: float = MOST_WORD_DISTANCE,
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, class_distance, word_distance`` per row.

    Null and empty texts have zeros and fail the base rules (fewer than 50
    words).  Repeated rows give repeated results; other columns are not read.
    Distances are 0 without words; they decide from ``MIN_WORDS`` (classes) and
    ``MIN_WORDS_COMMON`` (common words) words on, if the language has
    ``MIN_REFERENCE_WORDS`` words in all.  Without a language, or with one of
    fewer than ``MIN_WORDS`` words in all, they are the distances from all
    documents and decide nothing.
    """
    texts, sums = _sums(docs, lang_col, text_col)
    sums = sums.persist()
    try:
        refs, totals = _largest(sums, texts, MOST_LANGUAGES)
        totals = totals if totals is None else written(totals, "language-totals")
    finally:
        sums.unpersist()
    held = docs.sparkSession.sparkContext.broadcast(refs)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    schema = schema_after(
        rows,
        "doc_id",
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double, judged boolean",
    )
    if totals is None:
        stats = arrow_map(rows, partial(_rule_batches, held=held), schema)
    else:
        others = written(_others(texts, totals), "language-references")
        names = small_side(others.select("lang"))
        near = rows.join(names, "lang", "left_anti").select("doc_id", "text", "lang")
        far = rows.join(others, "lang").select("doc_id", "text", "lang", "total", "classes", "words", "counts")
        stats = arrow_map(near, partial(_rule_batches, held=held), schema).unionAll(arrow_map(far, partial(_joined_rule_batches, held=held), schema))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    unlike = ((F.col("n_words") >= MIN_WORDS) & (F.col("class_distance") > most_class)) | (
        (F.col("n_words") >= MIN_WORDS_COMMON) & (F.col("word_distance") > most_word)
    )
    return stats.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~(F.col("judged") & unlike)).alias("kept"),
        "class_distance",
        "word_distance",
    )
