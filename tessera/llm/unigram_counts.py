"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each
character; dynamic programming carries the best score and the number of pieces
on that best path.  Ties follow the tokenizer: among equal scores the path
whose last piece starts first wins; a character without a piece of its own
costs the lowest score less ``UNKNOWN_PENALTY`` and counts one byte piece per
UTF-8 byte (byte fallback).

Every space becomes the word-start mark and one mark is put in front of the
text.  Texts are cut only where no piece can cross: before a mark that follows
another character, so runs of spaces meet the pieces made of several marks.
Equal parts share one result; a worker keeps results of the parts it saw last
in a bounded cache.  A vocabulary with a mark behind another character leaves
the text whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import arrow_map, schema_after

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: A run of marks with what follows it; the text's parts if no piece holds a mark behind another character.
_PART = re.compile(f"{MARK}+[^{MARK}]*")
_CROSSES = re.compile(f"[^{MARK}]{MARK}")
#: Words whose results a worker keeps; beyond it the cache starts anew.
CACHE_WORDS = 400_000

Vocabulary = list[tuple[str, float]]


def read_vocabulary(path: str) -> Vocabulary:
    """Pieces of a SentencePiece file with unigram scores.

    A file of kind unigram gives its own scores.  A BPE file ranks its pieces
    (score ``-rank``); they get Zipf's law over the rank, ``-ln(rank + 2)``.
    Control, unknown and byte pieces never match text and are left out.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [
        (sp.id_to_piece(i), sp.get_score(i))
        for i in range(sp.get_piece_size())
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
    ]
    ranked = all(s <= 0 and s == int(s) for _, s in rows)
    return [(p, -math.log(2.0 - s) if ranked else s) for p, s in rows]


class Counter(dict):
    """Best score and piece count by word, of the words seen last.

    With ``split`` texts are cut before every mark (a tokenizer that splits
    so never uses pieces of several marks).
    """

    def __init__(self, vocabulary: Vocabulary, split: bool = True):
        super().__init__()
        self.split = split
        self.whole = any(_CROSSES.search(p) for p, _ in vocabulary)
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> tuple[float, int]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self.best(word)
        if len(word) <= 64:
            self[word] = found
        return found

    def best(self, word: str) -> tuple[float, int]:
        """Best score and the number of pieces of the path that wins the ties."""
        score, count = [0.0] * (len(word) + 1), [0] * (len(word) + 1)
        found = list(self.automaton.iter(word))
        k = 0
        for end in range(1, len(word) + 1):
            top, length, pieces, own = -math.inf, 0, 0, False
            while k < len(found) and found[k][0] == end - 1:
                size, s = found[k][1]
                k += 1
                own = own or size == 1
                s += score[end - size]
                if s > top or s == top and size > length:
                    top, length, pieces = s, size, count[end - size] + 1
            if not own and (s := self.unknown + score[end - 1]) > top:
                top, pieces = s, count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
            score[end], count[end] = top, pieces
        return score[-1], count[-1]

    def of_text(self, text: str | None) -> tuple[int, int, float]:
        """Words, pieces and best score of a text."""
        if not text:
            return 0, 0, 0.0
        words = [MARK + w for w in text.replace(MARK, " ").split(" ")]
        if words[0] == MARK:
            words = words[1:]  # the text's own first mark is enough
        parts = words
        if not self.split and (self.whole or MARK in words):
            joined = "".join(words)
            parts = [joined] if self.whole else _PART.findall(joined)
        scores, counts = zip(*map(self.__getitem__, parts)) if parts else ((), ())
        return len(words), sum(counts), math.fsum(scores)


_counters: dict[int, Counter] = {}


def _count_batches(batches: Iterator[pa.RecordBatch], held: Broadcast) -> Iterator[pa.RecordBatch]:
    key, pieces = held.value
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(pieces, split=False)
    counter = _counters[key]
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            words, counts, scores = zip(*map(counter.of_text, part.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(words, pa.int64()), pa.array(counts, pa.int64()), pa.array(scores, pa.float64())],
                ["doc_id", "n_words", "n_tokens", "log_score"],
            )


def token_counts(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens, log_score`` per row of ``docs``.

    Null and empty texts have 0 words, 0 tokens and score 0; repeated rows give
    repeated results; other columns are not read.  No shuffle.  The vocabulary
    (a fixed file, about 1 MB) is broadcast.
    """
    held = docs.sparkSession.sparkContext.broadcast((hash(tuple(vocabulary)), vocabulary))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = schema_after(rows, "doc_id", "n_words long, n_tokens long, log_score double")
    return arrow_map(rows, partial(_count_batches, held=held), schema)
