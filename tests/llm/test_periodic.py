import hashlib
import random
import zlib

import numpy as np
import pytest

from tessera.llm import queries
from tessera.llm.periodic import collapse_runs, collapsed, periodic_digests, repeat_tail, runs_of
from tests.conftest import SF_SMALL


def brute(w):
    """Every lag, every maximal stretch of matches, smallest period by trial."""
    n, out = len(w), set()
    for q in range(1, n):
        j = q
        while j < n:
            if w[j] == w[j - q]:
                s = j - q
                while j < n and w[j] == w[j - q]:
                    j += 1
                size = j - s
                if size >= max(6, 4 * q) and not any(all(w[s + i] == w[s + i + p] for i in range(size - p)) for p in range(1, q)):
                    out.add((s, size, q))
            j += 1
    return sorted(out)


def row(doc_id, text, tails):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if tails and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    listing = "".join("%d,%d,%d\n" % r for r in runs)
    kept = b" ".join(x for i, x in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def texts(rng):
    kind, n = rng.randrange(5), rng.randrange(0, 130)
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:
        return [rng.randrange(rng.randrange(1, 6)) for _ in range(n)]
    if kind == 2:
        w = []
        while len(w) < n:
            w += ([rng.randrange(3) for _ in range(rng.randrange(1, 14))] * rng.randrange(1, 9))[: rng.randrange(1, 90)]
        return w
    if kind == 3:  # Fibonacci words: many repetitions, none of four periods unless repeated
        a, b = [0], [0, 1]
        for _ in range(9):
            a, b = b, b + a
        return b[:n] * rng.randrange(1, 6)
    w = [0] * n
    for _ in range(rng.randrange(6) if n else 0):
        w[rng.randrange(n)] = rng.randrange(3)
    return w * rng.randrange(1, 5)


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(1500):
        w = texts(rng)
        assert runs_of(np.array(w, np.int64)) == brute(w), w


def test_hand_cases():
    word = lambda s: np.array([ord(c) for c in s], np.int64)
    assert runs_of(word("aaaaa")) == []
    assert runs_of(word("aaaaaa")) == [(0, 6, 1)]
    assert runs_of(word("xababababy")) == [(1, 8, 2)]
    assert runs_of(word("xabababay")) == []
    assert runs_of(word("abcabcabcabcab")) == [(0, 14, 3)]
    assert runs_of(word("aabb" * 4)) == [(0, 16, 4)]
    assert runs_of(word("")) == []
    assert collapsed(list("xababababy"), [(1, 8, 2)]) == list("xaby")
    with pytest.raises(ValueError):
        runs_of(word("aaaa"), min_periods=2)


def test_one_word_and_few_words_for_very_long():
    n = 300_000
    assert runs_of(np.zeros(n, np.int64)) == [(0, n, 1)]
    blocks = np.tile(np.r_[np.zeros(999, np.int64), 1], n // 1000)
    found = runs_of(blocks)
    assert (0, n, 1000) in found and len(found) == 1 + n // 1000
    few = np.random.default_rng(3).integers(0, 2, n)
    assert all((few[s : s + k - q] == few[s + q : s + k]).all() for s, k, q in runs_of(few)[:200])


def test_odd_rows(spark, odd_docs):
    rows = odd_docs.collect()
    for tails in (False, True):
        got = sorted((tuple(r) for r in periodic_digests(odd_docs, tails=tails).collect()), key=str)
        # the 30,000 words of id 104 hold no run but the planted one; brute force takes the others
        small = [r for r in rows if len(r["text"] or "") < 100_000]
        want = sorted((row(r["doc_id"], r["text"], tails) for r in small), key=str)
        assert [g for g in got if g[0] != 104] == want
        assert len(got) == len(rows)


def test_empty(no_docs):
    assert periodic_digests(no_docs).collect() == []
    assert collapse_runs(no_docs).collect() == []


def test_collapsed_texts(spark):
    rows = [(1, "go  go go\ngo go go now"), (2, "Go go Go go"), (None, None), (3, "ä b ä b ä b ä b c")]
    df = spark.createDataFrame([(d, t, [1]) for d, t in rows], "doc_id long, text string, runs array<int>")
    got = {r["doc_id"]: (r["text"], [tuple(x) for x in r["runs"]]) for r in collapse_runs(df).collect()}
    assert got[1] == ("go now", [(0, 6, 1)]) and got[2] == ("Go go Go go", []) and got[None] == ("", [])
    assert got[3] == ("ä b ä b ä b ä b c", [])  # a no-break space parts no words


def test_tails_are_planted():
    words = [b"w%d" % i for i in range(500)]
    planted = [k for k in range(200) if repeat_tail(words, k) != words]
    assert planted and all(zlib.crc32(str(k).encode()) % 10 == 0 for k in planted)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    short = {r["doc_id"]: r["text"] for r in docs if len(r["text"] or "") < 6000}
    got = {r["doc_id"]: tuple(r) for r in queries.op13_periodic_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    assert all(got[d] == row(d, t, True) for d, t in short.items())
    assert sum(g[1] > 0 for g in got.values()) > 0
