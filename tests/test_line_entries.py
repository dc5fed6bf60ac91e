import random

from pyspark.sql import functions as F

from tessera.functions.rand import u01
from tessera.functions.text import fold_key
from tessera.operators import wordcount as W


def _lines(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, line_no int, line string")


def _entries(line):
    kept = line.rstrip(" ")
    out = {}
    for w in kept.split(" ") if kept or not line else []:
        out[w.lower()] = (w, out.get(w.lower(), ("", 0))[1] + 1)
    return sorted(out.values())


def test_entries_of_lines(spark, monkeypatch):
    monkeypatch.setattr(W, "BATCH_ENTRIES", 50)
    rng = random.Random(8)
    texts = ["", " ", "   ", " a", "a  A ", "a\tA a", "É é e", "日本 x X"] + [" ".join(rng.choice(["b", "B", "bB", "c", "", "É"]) for _ in range(40)) for _ in range(30)]
    rows = [(i, i % 3, x) for i, x in enumerate(texts)] + [(99, 0, None)]
    got = W.line_entries(_lines(spark, rows), "doc_id").select("doc_id", "word", "n").collect()
    want = [(d, w, n) for d, _, x in rows if x is not None for w, n in _entries(x)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_number_of_an_entry(spark):
    lines = _lines(spark, [(5, 0, "a A É b"), (5, 1, ""), (None, 2, "a B"), (7, None, "c")])
    got = W.line_entries(lines, "doc_id", "line_no", seed=3).withColumn("fold", fold_key("word"))
    rows = got.select("u", u01(3, 0, "doc_id", "line_no", "fold").alias("v")).collect()
    assert len(rows) == 7 and all(r["u"] == r["v"] for r in rows)


def test_salted_count_sorts_once(spark):
    """Every exchange behind the first aggregate is sorted for once, by a number first."""
    plan = W.word_count_salted(_lines(spark, [(1, 0, "a A b")]), n_lines=1)._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert len(sorts) == 1 and "Sort [place" in sorts[0], plan


def test_salted_count_without_document_ids(spark):
    lines = _lines(spark, [(None, 0, "a"), (1, 0, "b B"), (1, 1, "B")])
    got = W.word_count_salted(lines, n_lines=1).select("word", F.col("n")).collect()
    assert sorted(map(tuple, got), key=str) == [("B", 3), (None, 1)]
