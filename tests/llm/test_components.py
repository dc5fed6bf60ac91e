import random

import numpy as np

from tessera.llm import components as C


def least(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    return {x: root(x) for x in list(parent)}


def test_links_of_a_task_become_stars():
    rng = random.Random(4)
    links = [(rng.randrange(300) - 150, rng.randrange(300) - 150) for _ in range(140)] + [(i, i + 1) for i in range(1000, 1400)]
    links = [(a, b) for a, b in links if a != b]
    a, b = C._stars(np.array([x for x, _ in links]), np.array([y for _, y in links]))
    want = least(links)
    assert dict(zip(a.tolist(), b.tolist())) == {x: y for x, y in want.items() if x != y}


def test_chains_in_few_rounds(spark, monkeypatch):
    """A chain in each of three tasks, and one chain over all of them: a round costs as many shuffles on any input."""
    rounds = []
    monkeypatch.setattr(C, "written", lambda df, name, write=C.written: rounds.append(name) or write(df, name))
    links = [(i, i + 1) for i in range(600)] + [(2000 + i, 2001 + i) for i in range(50)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long").coalesce(1).repartition(3)
    got = {r["node"]: r["component"] for r in C.components(df.coalesce(1)).collect()}
    assert got == {i: 0 for i in range(601)} | {i: 2000 for i in range(2000, 2051)}
    assert rounds.count("labels") <= 2, rounds
    rounds.clear()
    assert {r["node"]: r["component"] for r in C.components(df).collect()} == got
