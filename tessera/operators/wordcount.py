"""Word counting over lines ``DataFrame[doc_id, line_no, line]``.

Three counts with three different answers:

* :func:`word_count` — exact spelling; ``groupBy(word)`` with a map-side
  partial count, so a hot word costs one row per task in the shuffle.
* :func:`word_count_line_folded` — inside each line, words equal up to case
  are folded into one entry spelled as their last occurrence in the line;
  then entries are summed by spelling.
* :func:`word_count_salted` — as the line-folded count, but the folded
  entries get a random key in ``[0, sqrt(N))`` (N = number of lines) and are
  folded again, ignoring case, inside each (key, word) group before the sum by
  spelling.  The random key spreads a hot word over ``sqrt(N)`` reducers.

All tokens of one line come from one input row, so the per-line fold is
done where the line is read, a batch of lines at a time: the line and its fold
are split alike, and a table of the line's folds keeps the last spelling and
the count of each.  No shuffle comes before the words are summed, and every
fold after that is an aggregate with a map-side partial step.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from decimal import Decimal
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tessera.functions.rand import TWO_POW_52
from tessera.functions.text import count_lines, fold_key, tokenize
from tessera.llm.tables import arrow_map

#: Entries of a batch that the per-line fold gives back.
BATCH_ENTRIES = 1 << 16


def line_count(documents: DataFrame, text_col: str = "text") -> Column:
    """Number of lines of all documents as a scalar column, counted without
    splitting the texts into rows."""
    return documents.select(F.sum(count_lines(text_col)).cast("bigint")).scalar()


def tokens(lines: DataFrame) -> DataFrame:
    """One row per token: ``doc_id, line_no, pos, word`` (``pos`` from 0)."""
    return lines.select("doc_id", "line_no", F.posexplode(tokenize("line")).alias("pos", "word"))


def word_count(lines: DataFrame) -> DataFrame:
    """Exact-case word count: ``word, n``."""
    return tokens(lines).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _split(line: bytes) -> list[bytes]:
    """The tokens of :func:`tokenize`."""
    kept = line.rstrip(b" ")
    return kept.split(b" ") if kept or not line else []


def _entry_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``[columns to keep], key, line, fold`` -> the columns kept, ``word, n, u``; a null ``fold`` is the line itself."""
    for batch in batches:
        *_, keys, lines, folds = batch.columns
        kept = batch.num_columns - 3
        words: list[bytes] = []
        counts: list[int] = []
        digests: list[bytes] = []
        rows: list[int] = []
        sizes: list[int] = []

        def out() -> pa.RecordBatch:
            at = pa.array(np.repeat(np.array(rows, np.int64), sizes))
            bits = np.frombuffer(b"".join(digests), ">u8")[::2] >> np.uint64(12)
            u = pa.array(bits / TWO_POW_52) if digests else pa.nulls(len(words), pa.float64())
            columns = [batch.column(k).take(at) for k in range(kept)]
            columns += [pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), u]
            return pa.RecordBatch.from_arrays(columns, batch.schema.names[:kept] + ["word", "n", "u"])

        for i, (key, line, fold) in enumerate(zip(keys.to_pylist(), lines.to_pylist(), folds.to_pylist())):
            if line is None:
                continue
            spelled = _split(line)
            folded = spelled if fold is None else _split(fold)
            last = dict(zip(folded, spelled))
            words += last.values()
            counts += [1] * len(last) if len(last) == len(folded) else Counter(folded).values()
            if key is not None:
                digests += [md5(key + w, usedforsecurity=False).digest() for w in last]
            rows.append(i)
            sizes.append(len(last))
            if len(words) >= BATCH_ENTRIES:
                yield out()
                for x in (words, counts, digests, rows, sizes):
                    x.clear()
        if words:
            yield out()


def line_entries(lines: DataFrame, *keep: str, seed: int | None = None) -> DataFrame:
    """One row per row of ``lines`` and word up to case: the columns to keep, ``word`` as the last such token of the line
    spells it, ``n`` tokens, and with a seed the number ``u`` of :func:`u01` for ``(seed, 0, doc_id, line_no, fold)``."""
    fold = fold_key("line")
    key = F.lit(None).cast("binary")
    if seed is not None:
        key = F.concat_ws(":", F.lit(str(int(seed))), F.lit("0"), F.col("doc_id").cast("string"), F.col("line_no").cast("string"), F.lit("")).cast("binary")
    rows = lines.select(
        *keep, key.alias("_key"), F.col("line").cast("binary").alias("_line"), F.when(fold != F.col("line"), fold).cast("binary").alias("_fold")
    )
    schema = StructType([lines.schema[c] for c in keep] + [StructField("word", StringType()), StructField("n", LongType()), StructField("u", DoubleType())])
    return arrow_map(rows, _entry_batches, schema)


def line_folded(lines: DataFrame) -> DataFrame:
    """One row per (line, case-folded word): ``doc_id, line_no, fold, word, n`` with the word spelled as its last
    occurrence in the line.  (The counts below need the words alone and do not group by line.)"""
    words = line_entries(lines, "doc_id", "line_no")
    return words.groupBy("doc_id", "line_no", fold_key("word").alias("fold"), "word").agg(F.sum("n").alias("n"))


def word_count_line_folded(lines: DataFrame) -> DataFrame:
    """Case folded inside each line, then summed by spelling: ``word, n``."""
    return line_entries(lines).groupBy("word").agg(F.sum("n").alias("n"))


def word_count_salted(lines: DataFrame, seed: int = 0, n_lines: Column | int | None = None) -> DataFrame:
    """Two-round salted count: ``word, n``.

    The salt of a folded (line, word) entry is ``floor(u01(seed, 0, doc_id,
    line_no, fold) * sqrt(N))`` with N the number of lines.  Round one folds
    case inside each (salt, fold) group, keeping the spelling of the latest
    line by ``(doc_id, line_no)``; round two sums by spelling.  The spellings
    of a group are first reduced by hash aggregates over fixed-width line
    numbers, so no sort touches the tokens.

    ``n_lines`` may be given (a number or a scalar column) when N is cheaper
    to get than by counting ``lines``, e.g. :func:`line_count` on the
    documents.
    """
    if n_lines is None:
        n_lines = lines.select(F.count(F.lit(1))).scalar()
    elif not isinstance(n_lines, Column):
        n_lines = F.lit(int(n_lines))
    # one key per line, one salt per entry
    line_key = F.col("doc_id").cast("decimal(38,0)") * F.lit(Decimal(1 << 63)) + F.col("line_no")
    keyed = lines.select("doc_id", "line_no", line_key.cast("decimal(38,0)").alias("line_key"), "line")
    salt = F.floor(F.col("u") * F.sqrt(n_lines.cast("double"))).cast("bigint")
    entries = line_entries(keyed, "line_key", seed=seed).select("line_key", "word", "n", salt.alias("salt"))
    # a word has one fold, so it need not be a key beside the word
    spellings = entries.groupBy("salt", "word").agg(F.sum("n").alias("n"), F.max("line_key").alias("last"))
    # dealt and sorted by a number of the group before the group itself: what is left is sorted once, hardly by strings
    spellings = spellings.withColumn("fold", fold_key("word")).withColumn("place", F.xxhash64("salt", "fold")).repartition("place")
    round1 = spellings.groupBy("place", "salt", "fold").agg(F.max_by("word", "last").alias("word"), F.sum("n").alias("n"))
    return round1.groupBy("word").agg(F.sum("n").alias("n"))


def word_frequency(counts: DataFrame) -> DataFrame:
    """The dictionary swapped to ``n, word`` and sorted by count, descending
    (ties by word).  A total order: range-partitioned sort, no single task."""
    return counts.select("n", "word").orderBy(F.col("n").desc(), F.col("word").asc())


def top_words(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent words, ties broken by word.  Plans as
    ``TakeOrderedAndProject``: each task keeps its own top k."""
    if k < 0:
        raise ValueError("k must be >= 0")
    return counts.orderBy(F.col("n").desc(), F.col("word").asc()).limit(int(k)).select("word", "n")
