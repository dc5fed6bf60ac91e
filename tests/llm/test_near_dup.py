import itertools
import random
import re

import pytest

from tessera.llm import near_dup
from tessera.llm.near_dup import near_duplicates
from tests.llm.conftest import prose


def shingles(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """component by full pairwise comparison; rows are (id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 85 * len(a | b):
            parent[root(j)] = root(i)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        least = (min(ids) if ids else None) if sets[i] else d
        out.append((d, len(sets[i]), least, d is not None and d == least))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(d, t, 5, "k") for d, t in rows], "doc_id long, text string, component_id long, key string")
    got = sorted([tuple(r) for r in near_duplicates(df).collect()], key=str)
    assert got == brute(rows)


def test_odd_rows(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted([tuple(r) for r in near_duplicates(odd_docs).collect()], key=str)
    assert got == brute(rows)


def test_empty(no_docs):
    assert near_duplicates(no_docs).collect() == []


def test_short_texts_and_case(spark):
    check(spark, [(1, "a b c"), (2, "A  B\nC"), (3, "a b c d"), (4, "É"), (5, "é"), (6, None), (7, ""), (8, "a b c d e"), (9, "A B C D E")])


@pytest.mark.parametrize("change, block_bytes", [(0.005, 1 << 20), (0.015, 1 << 20), (0.03, 1 << 20), (0.015, 4000), (0.008, 9000)])
def test_dense_regions(spark, monkeypatch, change, block_bytes):
    """A group of near copies around the threshold: links between copies, not to the original, must all be found."""
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", block_bytes)
    rng = random.Random(int(change * 1000))
    base = prose(77, 200).split()
    rows = []
    for i in range(120):
        words = [("x%d" % rng.randrange(10**6)) if rng.random() < change else w for w in base]
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000 + i, prose(500 + i, 90)) for i in range(30)]
    rows += [(3000 + i, rows[i % 7][1]) for i in range(25)]
    check(spark, rows)
