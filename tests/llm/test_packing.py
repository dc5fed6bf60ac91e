import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = packing.read_ranks(PATH)


def reference():
    t = Tokenizer.from_file(PATH)
    return lambda text: (t.encode(text, add_special_tokens=False).ids if text else []) + [2]


def test_ids_equal_the_tokenizer():
    e, ref = packing._encoding((0, *RANKS)), reference()
    odd = ["a<|endoftext|>b <|endoftext|> c", "  \n\n  x \t y  ", "héllo 漢字😀‍\x00\x7f", "it's WE'LL 'S ½ ²³ ٣", "a" * 3000, " ", "　x y\xa0z", "é", ""]
    for t in pq.read_table(f"{SF_SMALL}/documents.parquet")["text"].to_pylist() + odd:
        assert packing.token_ids(e, t).tolist() == ref(t)


def test_very_long_white_space():
    e, ref = packing._encoding((0, *RANKS)), reference()
    for blank in (" ", "\n", "\t \n", "\u3000", "\x85\xa0"):
        run = blank * (12_000 // len(blank))
        for text in (run, f"a{run}", f"{run}b", f"a{run}b{run}\x1cc", f"x{run}<|endoftext|>{run}y", f"it{run}'s", f"{run}{blank}1 . {run}?"):
            assert packing.token_ids(e, text).tolist() == ref(text), (blank, text.strip())
    for blank in " \n":
        text = blank * 2_000_000 + "x"
        assert packing.token_ids(e, text).tolist() == ref(text)


@given(st.lists(st.integers(1, 63), max_size=200), st.integers(1, 10))
@settings(deadline=None)
def test_best_fit_is_valid_and_bounded(lengths, open_bins):
    at = packing.best_fit(lengths, 64, open_bins)
    bins = {}
    for (b, offset), n in zip(at, lengths):
        assert offset == bins.get(b, 0)
        bins[b] = offset + n
        assert bins[b] <= 64


def test_best_fit_takes_the_fullest_that_fits_and_closes_the_fullest():
    assert packing.best_fit([6, 5, 4], 10, 4) == [(0, 0), (1, 0), (0, 6)]
    assert packing.best_fit([6, 7, 8, 3], 10, 2) == [(0, 0), (1, 0), (2, 0), (0, 6)]


def check(df):
    rows = packing.packed(df, RANKS).collect()
    ref = reference()
    want = []
    for r in df.collect():
        ids = np.array(ref(r["text"]), "<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(str(r["doc_id"]), k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((str(r[0]), *r[1:5]) for r in rows) == sorted(want)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    return len(by), sum(r["length"] for r in rows)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert packing.packed(no_docs, RANKS).collect() == []


def test_few_sequences(spark):
    n, total = check(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert n <= 1.02 * total / 1024 + 1


def test_several_groups(odd_docs, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 5)
    check(odd_docs)
