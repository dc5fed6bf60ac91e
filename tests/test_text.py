import pytest
from pyspark.sql import functions as F

from tessera.functions.text import tokenize
from tessera.operators import wordcount as W


def java_split_space(s: str) -> list[str]:
    """Reference semantics of a plain split on " ": trailing empties dropped."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


EDGES = ["", " ", "   ", "  a b  ", "a  b", "a\tb", "a \t", "x", " lead", "trail  "]


def test_tokenize_edges(spark):
    df = spark.createDataFrame([(s,) for s in EDGES], "line string")
    got = {r["line"]: list(r["t"]) for r in df.select("line", tokenize("line").alias("t")).collect()}
    for s in EDGES:
        assert got[s] == java_split_space(s), repr(s)


def _lines(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, line_no int, line string")


def test_line_folded_spelling_and_count(spark):
    lines = _lines(spark, [(1, 0, "The the THE"), (1, 1, "the"), (2, 0, "ß SS ss")])
    got = {r["word"]: r["n"] for r in W.word_count_line_folded(lines).collect()}
    assert got == {"THE": 3, "the": 1, "ß": 1, "ss": 2}


def test_word_count_exact(spark):
    lines = _lines(spark, [(1, 0, "a b a"), (1, 1, "A  a")])
    got = {r["word"]: r["n"] for r in W.word_count(lines).collect()}
    assert got == {"a": 3, "b": 1, "A": 1, "": 1}


def test_three_counts_share_total(spark):
    from tests.conftest import SF_SMALL
    from tessera.sources.tables import lines_from, load_table

    lines = lines_from(load_table(spark, SF_SMALL, "documents"))
    n_tokens = W.tokens(lines).count()
    for fn in (W.word_count, W.word_count_line_folded, W.word_count_salted):
        assert fn(lines).agg(F.sum("n")).collect()[0][0] == n_tokens


def test_salted_keeps_fold_groups(spark):
    lines = _lines(spark, [(1, i, "Word word") for i in range(50)])
    got = W.word_count_salted(lines, seed=3).collect()
    assert sum(r["n"] for r in got) == 100
    assert {r["word"] for r in got} <= {"Word", "word"}


def test_top_words(spark):
    lines = _lines(spark, [(1, 0, "b a c b a b")])
    counts = W.word_count(lines)
    assert [(r["word"], r["n"]) for r in W.top_words(counts, 2).collect()] == [("b", 3), ("a", 2)]
    assert W.top_words(counts, 0).count() == 0
    with pytest.raises(ValueError):
        W.top_words(counts, -1)
    freq = W.word_frequency(counts).collect()
    assert [r["word"] for r in freq] == ["b", "a", "c"]


def test_line_count_matches_lines(spark):
    from tests.conftest import SF_SMALL
    from tessera.sources.tables import lines_from, load_table

    docs = load_table(spark, SF_SMALL, "documents")
    n = spark.range(1).select(W.line_count(docs)).collect()[0][0]
    assert n == lines_from(docs).count()


def test_counts_do_not_depend_on_partitioning(spark):
    from tests.conftest import SF_SMALL
    from tessera.sources.tables import lines_from, load_table

    docs = load_table(spark, SF_SMALL, "documents")
    a = lines_from(docs)
    b = lines_from(docs.repartition(7))
    for fn in (W.word_count, W.word_count_line_folded, W.word_count_salted):
        assert sorted(map(tuple, fn(a).collect())) == sorted(map(tuple, fn(b).collect()))

LINE_TEXTS = ["", "\n", "a", "a\n", "a\nb", "a\r\nb\r\n", "a\rb", "a\n\nb\n\n", "\r\n\r\n", "x\n\r", " \n"]


def test_lines_like_the_text_reader(spark, scratch):
    import os

    from tessera.sources.tables import lines_from

    for i, text in enumerate(LINE_TEXTS):
        path = os.path.join(scratch, f"f{i}.txt")
        with open(path, "w", newline="") as f:
            f.write(text)
        want = [r["value"] for r in spark.read.text(path).collect()]
        docs = spark.createDataFrame([(i, text)], "doc_id long, text string")
        got = lines_from(docs)
        assert [r["line"] for r in got.orderBy("line_no").collect()] == want, repr(text)
        assert docs.select(W.line_count(docs)).first()[0] == len(want), repr(text)


def test_fold_is_character_equality(spark):
    from tessera.functions.text import fold_key

    same = [("ſ", "s"), ("ı", "i"), ("İ", "i"), ("I", "i"), ("ΟΔΟΣ", "οδος"), ("ΟΔΟΣ", "οδοσ"), ("µ", "μ"), ("K", "k"), ("ẞ", "ß"), ("ϐ", "Β"), ("É", "é")]
    apart = [("ß", "ss"), ("ß", "SS"), ("e", "é"), ("ŉ", "n")]
    df = spark.createDataFrame(same + apart, "a string, b string")
    got = [r[0] for r in df.select(fold_key("a") == fold_key("b")).collect()]
    assert got == [True] * len(same) + [False] * len(apart)


def test_folded_counts_on_odd_letters(spark):
    lines = _lines(spark, [(1, 0, "ΟΔΟΣ οδος οδοσ"), (1, 1, "ſo So"), (2, 0, "µ μ İ ı i I")])
    for count in (W.word_count_line_folded, W.word_count_salted):
        assert {r["word"]: r["n"] for r in count(lines).collect()} == {"οδοσ": 3, "So": 2, "μ": 2, "I": 4}


def test_salted_count_sorts_no_tokens(spark):
    plan = W.word_count_salted(_lines(spark, [(1, 0, "a A b")]), n_lines=1)._jdf.queryExecution().executedPlan().toString()
    steps = [line for line in plan.splitlines() if "Aggregate" in line or "Sort" in line or "Exchange" in line]
    assert [x.split("(")[0].strip(" +-:*") for x in steps[-3:]] == ["HashAggregate", "Exchange hashpartitioning", "HashAggregate"], steps


def test_text_scans_are_not_shuffled(spark):
    from tests.conftest import SF_SMALL

    from tessera.plans import catalog

    for name in ("txt_lines", "txt_tokens"):
        assert "Exchange" not in catalog.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
