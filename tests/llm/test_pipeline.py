import random
import re

import corpus_pipeline as P
from tessera.llm import queries
from tests.llm.conftest import prose
from tests.llm.test_near_dup import brute

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in P.STAGES[:-1]:
        out = P.written(stage(spark, docs, SF), "test")
        assert out.dtypes == docs.dtypes, name
        if name != "mix":
            assert out.count() <= before
            assert out.join(docs, "doc_id", "left_anti").count() == 0
        docs, before = out, out.count()
    assert P.STAGES[-1][1](spark, docs, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_odd_rows_through_every_stage(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in P.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns, name
            assert stage(spark, docs, SF).count() <= 3 * docs.count() + 1


def test_dedup_keeps_one_of_each_group(spark):
    rng = random.Random(3)
    base = prose(8, 150).split()
    rows = [(i, " ".join("y%d" % rng.randrange(10**6) if rng.random() < 0.004 else w for w in base)) for i in range(30)]
    rows += [(100 + i, prose(100 + i, 60)) for i in range(10)] + [(100, prose(100, 60)), (None, "no id"), (200, None)]
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r["doc_id"] for r in P.drop_near_duplicates(spark, df, SF).collect()), key=str)
    want = {d for d, _, _, kept in brute(rows) if kept}
    assert got == sorted([*want, None], key=str)


def test_mix_reaches_targets_in_whole_copies(spark):
    rows = [(i, prose(i, 100), "en", "abc"[i % 3], 1) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    words = {}
    for r in P.mix_sources(spark, df, SF).collect():
        words[r["source"]] = words.get(r["source"], 0) + len(re.findall(r"\S+", r["text"]))
    assert all(abs(words[s] - 9000 * w / 6) <= 100 for s, w in zip("abc", (1, 2, 3)))


def test_registered(spark):
    import __spark_entry__ as E

    names = list(E.queries())
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert E.queries()["pipeline"](spark, SF).count() > 0


def test_clashing_names_through_every_stage(spark, odd_docs):
    names = "known_id known_key copies rows kept mix_key mix_copy row key score predicted component_id taken s chunk".split()
    docs = odd_docs.selectExpr("*", *[f"'x' AS {n}" for n in names])
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.count() > 0, name
    assert P.STAGES[-1][1](spark, docs, SF).count() >= docs.count()
