import re
from collections import defaultdict

import pytest

from tessera.llm import mixing
from tests.llm.conftest import prose


def targets(sizes):
    """Water filling by the rule, source by source."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    out, total = {}, sum(sizes.values())
    live = set(names)
    while live:
        share = (total - sum(out.values())) / sum(weight[s] for s in live)
        full = {s for s in live if share * weight[s] >= 3 * sizes[s]}
        if not full:
            return out | {s: share * weight[s] for s in live}
        out |= {s: 3.0 * sizes[s] for s in full}
        live -= full
    return out


def check(df):
    rows = mixing.mixed(df).collect()
    source = df.select("doc_id", "source", "text").collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in source:
        sizes[r["source"]] += size(r["text"])
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted((str(r["doc_id"]), size(r["text"])) for r in source)
    want = targets(dict(sizes))
    taken, of = defaultdict(int), {}
    by_key = defaultdict(list)
    for r in source:
        by_key[(r["doc_id"], size(r["text"]))].append(r["source"])
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        s = by_key[(r["doc_id"], r["size"])][0]
        taken[s] += r["taken"]
        of[s] = (r["source_size"], r["target"])
    for s, (total, target) in of.items():
        assert total == sizes[s] and target == pytest.approx(want[s])
        assert abs(taken[s] - target) <= 0.51
    return rows


def test_odd_rows(odd_docs, no_docs):
    first = check(odd_docs)
    again = mixing.mixed(odd_docs.repartition(7)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    assert mixing.mixed(no_docs).collect() == []


def test_small_sources_stop_at_three_times(spark):
    rows = [(i, prose(i, 300), "big") for i in range(60)] + [(100, prose(1, 40), "c"), (101, prose(2, 9), "d"), (102, "x", None), (103, None, "e")]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string"))


def test_all_sources_empty(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mixed(df).collect()] == [(0.0, 0), (0.0, 0)]


def test_schedule_is_spread_and_exact(spark):
    t = spark.createDataFrame([(0, 10_000.0), (1, 30_000.0), (2, 60_000.0), (3, 0.0)], "s long, target double")
    slots = [(r["slot"], r["s"], r["r"], r["words"]) for r in mixing.schedule(t, 100).orderBy("slot").collect()]
    for s, goal in ((0, 10_000), (1, 30_000), (2, 60_000)):
        mine = [x for x in slots if x[1] == s]
        assert sum(x[3] for x in mine) == goal
        assert [x[2] for x in mine] == list(range(len(mine)))
    for n in (50, 200, 500, 900):  # every beginning of the mix has the shares, up to a few slots
        head = [x[1] for x in slots[:n]]
        assert abs(head.count(0) - 0.1 * n) < 4 and abs(head.count(2) - 0.6 * n) < 4


def test_hot_source_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 7)
    monkeypatch.setattr(mixing, "CHUNK_SLOTS", 16)
    rows = [(i, prose(i, 200 + i), "hot" if i % 4 else f"s{i % 5}") for i in range(120)]
    check(spark.createDataFrame(rows, "doc_id long, text string, source string"))


def test_many_sources_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 4)
    check(spark.createDataFrame([(i, prose(i, 20 + i % 90), f"s{i % 30:02}") for i in range(120)], "doc_id long, text string, source string"))


def brute_slots(spark, df, block, point):
    """first slot and number of slots of every document, from the schedule's points one by one."""
    at, goals = mixing.placed(df)
    goals = {r["s"]: r["target"] for r in goals.collect()}
    total, upto, spans = sum(goals.values()), 0.0, []
    for s in sorted(goals):
        spans.append((s, upto / total, (upto + goals[s]) / total))
        upto += goals[s]
    blocks = {s: -(-int(t + 0.5) // block) for s, t in goals.items()}
    slot_of, n = {}, -int(-total // block)
    for slot in range(n):
        u = point(slot)
        s = next((s for s, lo, hi in spans if lo <= u < hi), spans[-1][0])
        r = sum(k[0] == s for k in slot_of)
        if r < blocks[s]:
            slot_of[s, r] = slot
    used = {s: sum(k[0] == s for k in slot_of) for s in goals}
    for s in goals:
        for r in range(used[s], blocks[s]):
            slot_of[s, r] = n + r
    out = []
    for x in at.collect():
        goal, mine = int(goals[x["s"]] + 0.5), set()
        for p in range(mixing.REPEATS):
            begin = p * x["source_size"] + x["start"]
            end = min(begin + x["size"], goal)
            if begin < end:
                mine |= {slot_of[x["s"], r] for r in range(begin // block, (end - 1) // block + 1)}
        out.append((x["doc_id"], min(mine, default=None), len(mine)))
    return sorted(out)


def test_slots_follow_the_points(spark, monkeypatch):
    rows = [(i, prose(i, 150 + i), "abc"[i % 3] if i % 5 else "a") for i in range(60)] + [(90, "", "a"), (91, prose(91, 5), "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    slots = lambda: sorted((r["doc_id"], r["first_slot"], r["n_slots"]) for r in mixing.mixed(df, block=64).collect())
    golden = lambda i: ((i + 0.5) * mixing._PHI) % 1.0
    got = slots()
    assert got == brute_slots(spark, df, 64, golden)
    monkeypatch.setattr(mixing, "golden_point", lambda i: mixing.F.lit(0.25))
    assert slots() == brute_slots(spark, df, 64, lambda i: 0.25) != got
