import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import phrases
from tessera.llm.words import slices
from tests.llm.conftest import prose

FOLD = {c: c + 32 for c in range(65, 91)}


def grams_of(text):
    out = collections.Counter()
    words = 0
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
        w = re.findall(r"[^\x20\x09]+", piece)
        words += len(w)
        for n in range(1, 5):
            for i in range(len(w) - n + 1):
                out[" ".join(w[i : i + n])] += 1
    return out, words


def brute_counts(rows):
    f, total = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        got, n = grams_of(text)
        f[lang or "und"].update(got)
        total[lang or "und"] += n
    return f, total


def brute(rows, least=30, top=2000):
    counts, total = brute_counts(rows)
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if " " in p and a >= least}
        kept = []
        for p, a in cand.items():
            w = p.split(" ")
            score, _, l, r = min((2000000 * a // (f[" ".join(w[:k])] + f[" ".join(w[k:])]), k, f[" ".join(w[:k])], f[" ".join(w[k:])]) for k in range(1, len(w)))
            if not any(f" {p} " in f" {q} " and q != p and 100 * b >= 80 * a for q, b in cand.items()):
                kept.append((-score, -a, p.encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(t, g, 1, "x", 3) for t, g in rows], "text string, lang string, n int, phrase string, words int")


def check(spark, rows, least=3, top=2000, **options):
    counts = phrases.phrase_counts(frame(spark, rows), least, **options)
    got = sorted(tuple(r) for r in phrases.collocations(counts, top).collect())
    assert got == brute(rows, least, top)
    return got


def made(seed, n, words=12):
    rng = random.Random(seed)
    marks = [" "] * 12 + ["  ", "\t", ". ", ",", " ; ", "\n", "\r\n", "!", "\x0b", " ,\t. "]
    return "".join(rng.choice(["Der", "the", "naïve", "漢字", "of", "b-c", "X", "y", "z1", " q", "é", "the"][:words]) + rng.choice(marks) for _ in range(n))


def test_counts_equal_brute_force(spark):
    rows = [(made(i, 40 + 30 * (i % 5)), ["en", "de", None, "und", "en"][i % 5]) for i in range(60)]
    rows += rows[:20] + [(None, "en"), ("", "en"), (" \n.", "fr"), (None, None), ("one", "xx"), ("...", None)]
    f, total = brute_counts(rows)
    for bits in (6, phrases.MAX_BITS):  # a full filter loses nothing, an empty one lets nothing else through
        got = phrases.phrase_counts(frame(spark, rows), 4, max_bits=bits).collect()
        want = {(g, p, len(p.split(" ")), n) for g, c in f.items() for p, n in c.items() if n >= 4}
        assert {tuple(r) for r in got if r["words"]} == want
        assert {(r["lang"], r["n"]) for r in got if not r["words"]} == {(g, n) for g, n in total.items() if n}


def test_scores_equal_brute_force(spark):
    rows = [(made(100 + i, 90), ["en", "de", None][i % 3]) for i in range(50)] + [("Good  morning, good morning to you", "en")] * 40
    got = check(spark, rows)
    assert len(got) > 100
    check(spark, rows, top=7)


def test_one_word_over_and_over(spark):
    check(spark, [("go " * 3000, "en"), ("go stop " * 500, "en"), ("a b c d e f g " * 400, "de")])


def test_odd_rows_and_empty(spark, odd_docs, no_docs):
    rows = [(r["text"], r["lang"]) for r in odd_docs.collect()]
    counts = phrases.phrase_counts(odd_docs, 5)
    assert sorted(tuple(r) for r in phrases.collocations(counts).collect()) == brute(rows, 5)
    assert phrases.collocations(phrases.phrase_counts(no_docs)).collect() == []


def test_chunks_overlap_once():
    """Every run of up to four words starts in the own part of one chunk; chunks start over at the same words."""
    rng = random.Random(5)
    texts = [prose(i, rng.randrange(0, 400)) for i in range(30)] + ["w " * 2000, "", "x", "x y", "x y z", ". ,", "x y z\n"]
    col = pa.array(texts)
    for _, _, data, offsets in slices(col):
        chunks, owner = phrases.chunks_of(data, offsets)
        back = collections.defaultdict(list)
        for c, t in zip(chunks, owner):
            w = c.decode().split()
            back[t] += w if c.endswith(b"\n") else w[: -phrases.OVERLAP]
            assert len(w) <= phrases.LONGEST + phrases.OVERLAP
        assert [back.get(i, []) for i in range(len(texts))] == [t.replace(".", " ").replace(",", " ").split() for t in texts]


def test_shared_passages_become_the_same_chunks(spark):
    passage = prose(77, 400)
    rows = [(f"{prose(i, 30)} {passage} {prose(1000 + i, 30)}", "en") for i in range(40)]
    df = phrases.dictionary(frame(spark, rows))
    total, distinct = df.selectExpr("sum(n)", "count(*)").first()
    assert distinct < total / 3


def test_exact_beyond_64_bits(spark):
    rows = [("en", "a", 1, 9 * 10**17), ("en", "b", 1, 9 * 10**17), ("en", "a b", 2, 8 * 10**17), ("en", "", 0, 2 * 10**18)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, words int, n long")
    (r,) = phrases.collocations(counts).collect()
    assert r["score"] == 2000000 * 8 * 10**17 // (18 * 10**17)


def test_filter_bits(spark):
    chunks = phrases.dictionary(frame(spark, [("a b c d", "en")] * 9 + [("x y", "de")])).cache()
    few = phrases.frequent_buckets(chunks, 20, 9)
    assert np.unpackbits(few).sum() == 10  # 4 + 3 + 2 + 1 phrases
    assert np.unpackbits(phrases.frequent_buckets(chunks, 20, 10)).sum() == 0
    with pytest.raises(ValueError):
        phrases.frequent_buckets(chunks, 20, 300)
