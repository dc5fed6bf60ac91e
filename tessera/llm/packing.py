"""Packing documents into sequences: bounded-space online best-fit.

One pass tokenises every text and yields its pieces (only texts longer than a
sequence are cut; the first piece takes the rest).  Pieces of a whole
sequence are sequences.  The others, a few dozen bytes each, are spread by
hash over groups of about ``GROUP_PIECES``; in a group they come one by one,
the longest first (so an online order of the dealer's choice, not of arrival), into a fixed number of open bins.  Open bins are kept in a bitset
keyed by free space: the lowest set bit not under a piece's length is the bin
it fits best; without one a new bin opens, and if all are open the fullest
closes first.

Token ids are those of the ``tokenizers`` file; the ranks of the same
vocabulary run in ``tiktoken``, which gives equal ids at five times the speed.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import arrow_map, schema_after, ship, written

SEQUENCE = 1024
END_ID = 2
OPEN_BINS = 8192
GROUP_PIECES = 16_384

#: The byte-level pattern that the vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks and special tokens of a byte-level BPE file of ``tokenizers`` (json) or ``tiktoken``."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        special = {t["content"]: t["id"] for t in parts.get("added_tokens", [])}
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in token): i for token, i in parts["model"]["vocab"].items() if token not in special}
        return ranks, special
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, {}


def _byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_encodings: dict[int, tiktoken.Encoding] = {}


def _encoding(held: tuple[int, dict[bytes, int], dict[str, int]]) -> tiktoken.Encoding:
    key, ranks, special = held
    if key not in _encodings:
        _encodings.clear()
        _encodings[key] = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _encodings[key]


#: White space as the pattern's regex knows it (Unicode White_Space), in runs that its matcher must not meet: it goes
#: back over a run step by step, on a stack that about two million characters exhaust.
_LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


def token_ids(encoding: tiktoken.Encoding, text: str | None, end_id: int = END_ID) -> np.ndarray:
    """Ids of a text with the closing id.

    A run of white space is one piece of the pattern, but for its last
    character where a word follows, so a very long run is encoded as such.
    """
    ids: list[int] = []
    at = 0
    for run in _LONG_BLANK.finditer(text or ""):
        closed = run.end() == len(text) or text.startswith(tuple(encoding.special_tokens_set), run.end())
        end = run.end() if closed else run.end() - 1
        ids += encoding.encode(text[at : run.start()], allowed_special="all")
        ids += encoding._encode_single_piece(text[run.start() : end])
        at = end
    if text:
        ids += encoding.encode(text[at:], allowed_special="all")
    ids.append(end_id)
    return np.array(ids, "<u4")


def cut(n: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole sequences, the first one may be shorter."""
    first = n % size or size
    return [(0, first), *((at, size) for at in range(first, n, size))]


def _piece_batches(batches: Iterator[pa.RecordBatch], held: Broadcast, size: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encoding = _encoding(held.value)
    for batch in batches:
        for lo in range(0, batch.num_rows, 128):
            part = batch.slice(lo, 128)
            of, out = [], []
            for i, text in enumerate(part.column(1).to_pylist()):
                ids = token_ids(encoding, text, end_id)
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    of.append(i)
                    out.append((k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            piece, start, length, crc = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(of)), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )


def best_fit(lengths: list[int], size: int = SEQUENCE, open_bins: int = OPEN_BINS) -> list[tuple[int, int]]:
    """(bin, offset) of each length, in the order given, with ``open_bins`` open at most."""
    by_free: list[list[int]] = [[] for _ in range(size + 1)]
    bits = n_open = n_bins = 0
    out = []
    for length in lengths:
        fits = bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                bits ^= 1 << free
            n_open -= 1
        else:
            if n_open >= open_bins:  # the fullest closes
                fullest = (bits & -bits).bit_length() - 1
                by_free[fullest].pop()
                if not by_free[fullest]:
                    bits ^= 1 << fullest
                n_open -= 1
            free, b = size, n_bins
            n_bins += 1
        out.append((b, size - free))
        left = free - length
        if left:
            by_free[left].append(b)
            bits |= 1 << left
            n_open += 1
    return out


def _pack_group(table: pa.Table, size: int, open_bins: int) -> pa.Table:
    table = table.sort_by([("length", "descending"), ("order", "ascending")])
    at = best_fit(table["length"].to_pylist(), size, open_bins)
    group = table["group"][0].as_py() << 32
    return table.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column(
        "sequence_id", pa.array([group + b for b, _ in at], pa.int64())
    ).append_column("offset", pa.array([o for _, o in at], pa.int64()))


def pieces(
    docs: DataFrame, ranks: tuple[dict[bytes, int], dict[str, int]], id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE, end_id: int = END_ID
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every text's pieces, one pass over the texts."""
    key = zlib.crc32(repr(sorted(ranks[1].items())).encode()) ^ len(ranks[0])
    held = docs.sparkSession.sparkContext.broadcast((key, *ranks))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = schema_after(rows, "doc_id", "piece int, start long, length long, ids_crc32 long")
    return arrow_map(rows, partial(_piece_batches, held=held, size=size, end_id=end_id), schema)


def packed(
    docs: DataFrame,
    ranks: tuple[dict[bytes, int], dict[str, int]],
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE,
    end_id: int = END_ID,
    open_bins: int = OPEN_BINS,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece.

    Null and empty texts are the closing id alone.  Repeated rows are packed
    each for itself; other columns are not read.  ``ranks`` (a fixed
    vocabulary, about 1 MB) is broadcast.
    """
    cut_up = written(pieces(docs, ranks, id_col, text_col, size, end_id), "pieces")
    whole = cut_up.where(F.col("length") >= size).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    rest = cut_up.where(F.col("length") < size)
    groups = max(1, -(-rest.count() // GROUP_PIECES))
    # the row's number spreads repeated rows too
    order = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
    dealt = rest.withColumn("order", order).withColumn("group", F.pmod(F.col("order"), F.lit(groups)))
    ship(docs.sparkSession)

    def pack(table: pa.Table) -> pa.Table:
        return _pack_group(table, size, open_bins)

    schema = schema_after(cut_up, "doc_id", "piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    fitted = dealt.groupBy("group").applyInArrow(pack, schema)
    return whole.unionByName(fitted)
