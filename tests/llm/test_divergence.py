import math
import re
from collections import Counter

import numpy as np

from tessera.llm import divergence as D
from tests.llm.conftest import prose


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def base(t):
    w = words(t)
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(inside), failed)


def js(p, q):
    keys, total = set(p) | set(q), 0.0
    for k in keys:
        a, b = p.get(k, 0.0), q.get(k, 0.0)
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(0.0, total / 2))


def lower(w):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)


def brute_word_distance(rows):
    by_lang = {"": Counter()}
    for _, t, lang in rows:
        for k in {"", lang or ""}:
            by_lang.setdefault(k, Counter()).update(map(lower, words(t)))
    total = sum(by_lang[""].values())
    refs = {}
    for k, c in by_lang.items():
        n = sum(c.values())
        if n >= D.LANGUAGE_SHARE * total:
            common = {w: x / n for w, x in c.items() if x >= D.COMMON_SHARE * n}
            refs[k] = common | {None: 1 - sum(common.values())}
    out = []
    for _, t, lang in rows:
        w = list(map(lower, words(t)))
        ref = refs.get(lang or "", refs[""])
        c = Counter(x if x in ref else None for x in w)
        out.append(js({k: v / len(w) for k, v in c.items()}, ref) if w else 0.0)
    return out


def test_odd_rows(odd_docs, no_docs):
    rows = sorted([(r["doc_id"], r["text"], r["lang"]) for r in odd_docs.collect()], key=str)
    got = sorted(D.quality_rules(odd_docs).collect(), key=lambda r: (str(r["doc_id"]), r["n_words"]))
    want = sorted(zip(rows, brute_word_distance(rows)), key=lambda x: (str(x[0][0]), len(words(x[0][1]))))
    for g, ((d, t, _), distance) in zip(got, want):
        assert g["doc_id"] == d and tuple(g[1:7]) == base(t)
        assert math.isclose(g["word_distance"], distance, abs_tol=1e-9)
    assert D.quality_rules(no_docs).collect() == []


def test_line_and_window_edges(spark):
    texts = ["a\na\n a\n\n\na", "a b c a b c", "\n\n", "x\r\nx\r\nx", "a b a b a b a b", "l1\nl2\nl1\nl2", "| # | <>", "é é é é"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: tuple(r[1:7]) for r in D.quality_rules(df).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def test_junk_goes_and_prose_stays(spark):
    clean = [(i, prose(i, 150), "en") for i in range(80)]
    shout = [(100 + i, " ".join(w.upper() + "!!" for w in prose(300 + i, 120).split()), "en") for i in range(5)]
    table = [(200 + i, " | ".join("q%dz%d" % (i, j) for j in range(90)), "en") for i in range(5)]
    df = spark.createDataFrame(clean + shout + table, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in D.quality_rules(df).where("kept").collect()}
    assert kept == set(range(80))


def test_slices_do_not_change_references(spark, odd_docs, monkeypatch):
    whole = D.references(odd_docs)
    parts = D.references(odd_docs.repartition(5))
    assert set(whole) == set(parts)
    for k in whole:
        assert np.array_equal(whole[k].words, parts[k].words) and np.allclose(whole[k].shares, parts[k].shares)


def foreign(seed, n):
    """Words of a language beyond ASCII, some of them common."""
    return " ".join("".join(chr(0x430 + ord(c) % 32) for c in w) for w in prose(seed, n).split())


def rare_language(spark):
    """45 clean documents of a language with under 0.1 % of all words, junk in it, one without a language and one of a tiny language."""
    rows = [(1000 + i, prose(i, 30_000), "en") for i in range(120)]
    rows += [(100 + i, foreign(i, 60), "uk") for i in range(45)]
    rows += [(200, " ".join(f"q{j}z|{j}" for j in range(60)), "uk"), (300, foreign(7, 90), None), (301, foreign(8, 90), "zz")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_rare_languages_have_their_own_reference(spark, monkeypatch):
    df = rare_language(spark).persist()
    want = set(range(100, 145)) | {300, 301}
    rows = {r["doc_id"]: r for r in D.quality_rules(df).where("doc_id >= 100 and doc_id < 1000").collect()}
    assert {k for k, r in rows.items() if r["kept"]} == want
    monkeypatch.setattr(D, "MOST_LANGUAGES", 1)  # the others meet their references by a join
    joined = {r["doc_id"]: r for r in D.quality_rules(df).where("doc_id >= 100 and doc_id < 1000").collect()}
    assert joined == rows
