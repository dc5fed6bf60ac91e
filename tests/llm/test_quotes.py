import duckdb
import pandas as pd

from tessera.llm.queries import oracle_sql
from tessera.llm.quotes import quote_links, reply_ordered

ROWS = [
    (1, 0, "user", "Hello world\nsecond line"),
    (1, 1, "assistant", "Sure. here\n\nanswer b"),
    (1, 2, "user", "On Mon, X wrote:\n> hello  world\nI mean this"),
    (1, 3, "a", "> > hello world\n> I mean this\nok reply to 2"),
    (1, 4, "u", "> sure. HERE\nto one"),
    (1, 4, "u", "> sure. HERE\nto one"),
    (1, 5, "u", "> > > hello world\n> > I mean this\n> ok reply to 2\n\nlast\n"),
    (1, 6, "u", "> nobody said this\nx"),
    (2, 0, "u", None),
    (2, 1, "u", ""),
    (2, 2, "u", "> later line"),
    (2, 3, "u", "later line"),
    (None, 1, "u", "> a"),
]


def test_links_and_order(spark):
    m = spark.createDataFrame([(*r, "c") for r in ROWS], "conv_id long, turn int, role string, text string, path string")
    links = {(r["turn"], r["passage"]): (r["level"], r["quoted_turn"]) for r in quote_links(m).where("conv_id = 1").collect()}
    assert links == {(2, 1): (1, 0), (3, 1): (2, 0), (3, 2): (1, 2), (4, 1): (1, 1), (5, 1): (3, 0), (5, 2): (2, 2), (5, 3): (1, 3)}
    got = [r for r in reply_ordered(m).orderBy("path").collect() if r["conv_id"] == 1]
    assert [r["turn"] for r in got] == [0, 2, 3, 5, 1, 4, 4, 6]
    assert [r["depth"] for r in got] == [0, 1, 2, 3, 0, 1, 1, 0]
    assert [r["text"] for r in got][1:4] == ["I mean this", "ok reply to 2", "last"]
    rest = {(r["conv_id"], r["turn"]): r for r in reply_ordered(m).collect()}
    assert rest[(2, 0)]["text"] is None and rest[(2, 2)]["parent_turn"] is None and rest[(None, 1)]["text"] == ""
    assert len(reply_ordered(m).collect()) == len(ROWS)
    assert reply_ordered(m.limit(0)).collect() == []


def test_same_as_sql(spark):
    rows = [r for r in ROWS if r[0] is not None]
    m = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    cols = ["conv_id", "turn", "role", "depth", "path", "n_quoted", "text"]
    want = sorted(map(str, con.sql(oracle_sql()["op4_reply_ordered"]).df()[cols].itertuples(index=False, name=None)))
    got = sorted(map(str, reply_ordered(m).toPandas()[cols].itertuples(index=False, name=None)))
    assert got == want


def test_long_quotation_takes_linear_work(spark):
    quoted = "\n".join("> " * (1 + i % 2) + f"line {i}" for i in range(20_000))
    own = "\n".join(f"line {i}" for i in range(0, 20_000, 2))
    m = spark.createDataFrame([(1, 0, "u", own), (1, 1, "u", quoted + "\nanswer")], "conv_id long, turn int, role string, text string")
    got = {r["turn"]: r for r in reply_ordered(m).collect()}
    assert (got[1]["parent_turn"], got[1]["n_quoted"], got[1]["text"]) == (0, 10_000, "answer")
    assert quote_links(m).agg({"passage": "max"}).first()[0] == 19_999


def test_two_texts_of_one_turn(spark):
    rows = [(1, 0, "u", "a\nb"), (1, 1, "u", "> a\n> b\nx"), (1, 1, "u", "> a\ny"), (1, 2, "u", "> x\n> y")]
    m = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    cols = ["conv_id", "turn", "role", "depth", "path", "n_quoted", "text"]
    want = sorted(map(str, con.sql(oracle_sql()["op4_reply_ordered"]).df()[cols].itertuples(index=False, name=None)))
    assert sorted(map(str, reply_ordered(m).toPandas()[cols].itertuples(index=False, name=None))) == want


def test_wide_turns_sort_like_numbers(spark):
    turns = [-(2**63), -5, -1, 0, 7, 10**13, 10**13 + 1, 1_700_000_000_000_000, 2**63 - 1]
    rows = [(1, t, "u", f"> text {turns[i - 1]}\ntext {t}" if i % 2 else f"text {t}") for i, t in enumerate(turns)]
    m = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [r for r in reply_ordered(m).orderBy("path").collect()]
    assert [r["turn"] for r in got] == turns
    assert [r["parent_turn"] for r in got] == [turns[i - 1] if i % 2 else None for i in range(len(turns))]
