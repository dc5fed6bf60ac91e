import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.rand import u01_value
from tessera.operators import greedy
from tessera.operators import sampling as M
from tessera.operators import selection as S
from tests import brute


def _pts(spark, X, ids=None):
    ids = ids if ids is not None else list(range(len(X)))
    return spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in zip(ids, X)], "id long, v array<double>")


def test_kcenter_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(60, 4))
    ids = list(rng.permutation(1000)[:60])
    got = S.kcenter(_pts(spark, X, ids), 7).orderBy("pos").collect()
    first = int(np.argmin(ids))
    want, _ = brute.kcenter(ids, X, 7, first)
    assert [r["id"] for r in got] == want
    assert [r["pos"] for r in got] == list(range(7))


def test_kcenter_order_nonincreasing_and_2approx(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(9, 2))
    got = S.kcenter(_pts(spark, X), 3).orderBy("pos").collect()
    centers = [X[r["id"]] for r in got]
    assert brute.radius(X, centers) <= 2 * brute.optimal_radius(X, 3) + 1e-12


def test_kcenter_edges(spark):
    P = _pts(spark, [[0.0], [1.0], [1.0]])
    assert S.kcenter(P, 0).count() == 0
    with pytest.raises(ValueError):
        S.kcenter(P, 4)
    with pytest.raises(ValueError):
        S.kcenter(P, -1)
    # equal points stay distinct points: all three chosen
    assert sorted(r["id"] for r in S.kcenter(P, 3).collect()) == [0, 1, 2]


def test_buffer_and_rebase_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(60, 3))
    P = _pts(spark, X)
    want, _ = brute.kcenter(list(range(60)), X, 12)
    for buffer in (1, 3, 59, None):
        assert [r["id"] for r in S.kcenter(P, 12, buffer=buffer).orderBy("pos").collect()] == want
    monkeypatch.setattr(greedy, "REBASE", 3)
    assert [r["id"] for r in S.kcenter(P, 12, buffer=1).orderBy("pos").collect()] == want


def test_one_pass_certifies_many_centers(spark):
    rng = np.random.default_rng(31)
    X = rng.normal(size=(2000, 16))
    P = _pts(spark, X)
    want, _ = brute.kcenter(list(range(2000)), X, 40)
    passes = []
    got = S.kcenter(P, 40, buffer=200, on_pass=passes.append)
    assert [r["id"] for r in got.orderBy("pos").collect()] == want
    print("passes for 40 centers of 2,000 points:", passes)
    assert len(passes) <= 8 and passes[-1] == 40
    passes = []
    got = S.kcenter_blocks(M.with_block(P, 4, method="mod"), 20, buffer=100, on_pass=passes.append)
    assert len(passes) <= 6 and passes[-1] == 80
    for b in range(4):
        ids = list(range(b, 2000, 4))
        want, _ = brute.kcenter(ids, X[ids], 20)
        assert [r["id"] for r in got.where(F.col("block") == b).orderBy("pos").collect()] == want


def test_one_pass_decides_many_draws(spark):
    rng = np.random.default_rng(32)
    P = _pts(spark, np.concatenate([rng.normal(c * 20, 1, size=(300, 8)) for c in range(4)]))
    W = P.withColumn("w", (F.col("id") % 7).cast("double"))
    for exponent, weight in ((2.0, None), (4.0, None), (2.0, "w")):
        one = [r["id"] for r in S.kmeanspp(W, 25, seed=3, exponent=exponent, weight_col=weight, rounds=1).orderBy("pos").collect()]
        for rounds in (4, None):
            passes = []
            got = S.kmeanspp(W, 25, seed=3, exponent=exponent, weight_col=weight, rounds=rounds, on_pass=passes.append)
            assert [r["id"] for r in got.orderBy("pos").collect()] == one
        assert len(passes) <= 6, passes


def _race_by_hand(ids, X, k, seed, first, w=None, exponent=2):
    chosen = [first]
    m = np.array([brute.sqd(x, X[ids.index(first)]) for x in X])
    for h in range(1, k):
        best = None
        for i, x in enumerate(ids):
            mass = (1.0 if w is None else w[i]) * m[i] ** (exponent / 2)
            if x not in chosen and mass > 0:
                best = min(best or (np.inf, 0), (-np.log(1 - u01_value(seed, h, x)) / mass, x))
        chosen.append(best[1] if best else min(x for x in ids if x not in chosen))
        m = np.minimum(m, [brute.sqd(x, X[ids.index(chosen[-1])]) for x in X])
    return chosen


def test_race_by_hand(spark):
    rng = np.random.default_rng(33)
    X = np.repeat(rng.normal(size=(12, 2)), 2, axis=0)
    ids = [int(i) for i in rng.permutation(500)[:24]]
    w = [float(i % 3) for i in range(24)]
    P = _pts(spark, X, ids).join(spark.createDataFrame(list(zip(ids, w)), "id long, w double"), "id")
    for exponent in (2, 3, 4):
        got = [r["id"] for r in S.kmeanspp(P, 20, seed=5, exponent=exponent, first_id=ids[0]).orderBy("pos").collect()]
        assert got == _race_by_hand(ids, X, 20, 5, ids[0], exponent=exponent)
    got = [r["id"] for r in S.kmeanspp(P, 20, seed=5, weight_col="w", first_id=ids[0]).orderBy("pos").collect()]
    assert got == _race_by_hand(ids, X, 20, 5, ids[0], w)


def test_masses_near_zero(spark):
    P = _pts(spark, [[0.0], [1e-160], [2e-160], [3e-160], [1.0]], ids=[4, 3, 2, 1, 0])
    got = [r["id"] for r in S.kmeanspp(P, 5, seed=1, first_id=4).orderBy("pos").collect()]
    assert sorted(got) == [0, 1, 2, 3, 4] and got[:2] == [4, 0]


def test_a_pass_moves_no_vector(spark):
    P = M.with_block(_pts(spark, np.random.default_rng(34).normal(size=(90, 5))), 3, seed=1)
    passes = greedy.Passes(P, ["block"], [])
    choices = greedy.Choices(["block"])
    try:
        for r in passes.base.where("id < 9").collect():
            choices.add(r["block"], r["id"], r["v"])
        passes.next_state(choices).count()
        before = passes.state
        for r in passes.base.where("id BETWEEN 20 AND 25").collect():
            choices.add(r["block"], r["id"], r["v"])
        state = passes.next_state(choices)
        assert state.columns == ["block", "id", "m"] and state.count() == 75
        plan = greedy.folded(
            passes.base.join(before.select("id", "m").hint("merge"), "id"), choices.since({}), passes.narrow
        )
        plan.collect()
        text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        text = "\n".join(x for x in text.split("\n") if "InMemoryRelation" not in x)
        step = text.split("InMemoryTableScan")[0]
        assert "SortMergeJoin" in step and "hashpartitioning" not in step and "Sort [" not in step
    finally:
        passes.close()


def _files(spark):
    import os

    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return sum(len(names) for _, _, names in os.walk(top))


def test_nothing_stays_on_disk(spark):
    P = _pts(spark, np.random.default_rng(21).normal(size=(80, 4)))
    before = _files(spark)
    S.kcenter(P, 40).count()
    assert _files(spark) == before
    S.kmeanspp(P, 40).count()
    S.max_matching(P, 40).count()
    assert _files(spark) == before


def test_checks_before_the_rounds(spark):
    P = _pts(spark, np.random.default_rng(22).normal(size=(30, 2)))
    sc = spark.sparkContext
    sc.setJobGroup("too-many", "k over n")
    try:
        with pytest.raises(ValueError, match="30 points"):
            S.kcenter(P, 100)
        assert len(sc.statusTracker().getJobIdsForGroup("too-many")) <= 2
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    ragged = _pts(spark, [[1.0, 2.0], [1.0], [0.0, 0.0]])
    for run in (lambda: S.kcenter(ragged, 2), lambda: S.max_matching(ragged, 2), lambda: S.kmeanspp(ragged, 2)):
        with pytest.raises(ValueError, match="lengths"):
            run()
    twice = _pts(spark, [[1.0], [2.0], [3.0]], ids=[1, 1, 2])
    for run in (lambda: S.kcenter(twice, 3), lambda: S.max_matching(twice, 2)):
        with pytest.raises(ValueError, match="belongs to 2 points"):
            run()
    for w in ("CAST(NULL AS DOUBLE)", "-1D", "CAST('NaN' AS DOUBLE)"):
        with pytest.raises(ValueError, match="weights"):
            S.kmeanspp(P.selectExpr("id", "v", f"IF(id = 3, {w}, 1D) AS w"), 2, weight_col="w")
    with pytest.raises(ValueError, match="not a point id"):
        S.kcenter(P, 2, first_id=99)


def test_kcenter_blocks_equals_per_block_kcenter(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(80, 3))
    P = M.with_block(_pts(spark, X), 3, seed=1)
    got = S.kcenter_blocks(P, 4).collect()
    for b in range(3):
        rows = P.where(F.col("block") == b).collect()
        ids = [r["id"] for r in rows]
        Xb = np.array([r["v"] for r in rows])
        want, _ = brute.kcenter(ids, Xb, 4, int(np.argmin(ids)))
        assert [r["id"] for r in sorted((r for r in got if r["block"] == b), key=lambda r: r["pos"])] == want


def test_kcenter_blocks_many_rounds(spark):
    rng = np.random.default_rng(8)
    P = M.with_block(_pts(spark, rng.normal(size=(60, 3))), 2, seed=2)
    a = sorted(map(tuple, S.kcenter_blocks(P, 9).select("block", "pos", "id").collect()))
    b = sorted(map(tuple, S.kcenter_blocks(P, 9, buffer=1).select("block", "pos", "id").collect()))
    assert a == b
    seeded = S.kcenter_blocks(P, 2, seed=4)
    assert seeded.count() == 4


def test_small_block(spark):
    P = M.with_block(_pts(spark, [[float(i)] for i in range(5)]), 2, method="mod")
    with pytest.raises(ValueError):
        S.kcenter_blocks(P, 3)
    assert S.kcenter_blocks(P, 3, on_small_block="all").count() == 5


def test_kmeanspp_deterministic_distinct(spark):
    rng = np.random.default_rng(9)
    P = _pts(spark, rng.normal(size=(50, 3)))
    a = [r["id"] for r in S.kmeanspp(P, 6, seed=11).orderBy("pos").collect()]
    b = [r["id"] for r in S.kmeanspp(P, 6, seed=11).orderBy("pos").collect()]
    assert a == b and len(set(a)) == 6


def test_kmeanspp_zero_mass_fallback(spark):
    # all points equal: every mass is 0, so the smallest remaining ids follow the first
    P = _pts(spark, [[1.0, 1.0]] * 5)
    got = [r["id"] for r in S.kmeanspp(P, 3, seed=1, first_id=2).orderBy("pos").collect()]
    assert got == [2, 0, 1]


def test_kmeanspp_zero_weights_never_drawn(spark):
    rng = np.random.default_rng(10)
    P = _pts(spark, rng.normal(size=(30, 2))).withColumn("w", F.when(F.col("id") < 15, 0.0).otherwise(1.0))
    got = [r["id"] for r in S.kmeanspp(P, 8, seed=3, weight_col="w", first_id=0).orderBy("pos").collect()]
    assert all(i >= 15 for i in got[1:])


def test_exponential_race_distribution(spark):
    # three points, masses 1:2:5 relative to the first center -> draw frequencies
    X = [[0.0], [1.0], [np.sqrt(2.0)], [np.sqrt(5.0)]]
    P = _pts(spark, X)
    counts = {1: 0, 2: 0, 3: 0}
    for seed in range(60):
        ids = [r["id"] for r in S.kmeanspp(P, 2, seed=seed, first_id=0).orderBy("pos").collect()]
        counts[ids[1]] += 1
    assert counts[3] > counts[1]


def test_max_matching_brute_force(spark):
    rng = np.random.default_rng(12)
    X = rng.normal(size=(12, 3))
    ids = list(range(12))
    P = _pts(spark, X, ids)
    for k in (4, 5):
        got = [r["id"] for r in S.max_matching(P, k).orderBy("pos").collect()]
        assert got == brute.greedy_matching(ids, X, k)
    assert S.max_matching(P, 20).count() == 12


def test_max_matching_many_rounds_and_ties(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE", 3)
    rng = np.random.default_rng(15)
    X = rng.normal(size=(14, 2))
    P = _pts(spark, X)
    for k in (8, 11):
        got = [r["id"] for r in S.max_matching(P, k).orderBy("pos").collect()]
        assert got == brute.greedy_matching(list(range(14)), X, k)
    # a grid: many equal distances, ties go to the smallest (i, j)
    G = np.array([[x, y] for x in range(3) for y in range(3)], dtype=float)
    got = [r["id"] for r in S.max_matching(_pts(spark, G), 6).orderBy("pos").collect()]
    assert got == brute.greedy_matching(list(range(9)), G, 6)


def test_matching_meets_few_tiles(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE", 20)
    rng = np.random.default_rng(16)
    # clusters on a line: only the outer ones can hold the farthest pairs
    X = np.concatenate([rng.normal([c * 30.0, 0, 0], 1, size=(25, 3)) for c in range(16)])
    ids = [int(i) for i in rng.permutation(5000)[:400]]
    met = []
    got = [r["id"] for r in S.max_matching(_pts(spark, X, ids), 9, on_open=lambda *a: met.append(a)).orderBy("pos").collect()]
    assert got == brute.greedy_matching(ids, X, 9)
    print("tile pairs met, of:", met)
    assert met[0][0] < met[0][1] / 2
    # no structure: bounds prune little, the answer is the same
    Y = rng.normal(size=(150, 12))
    got = [r["id"] for r in S.max_matching(_pts(spark, Y), 10).orderBy("pos").collect()]
    assert got == brute.greedy_matching(list(range(150)), Y, 10)


def test_diversify_and_score(spark):
    rng = np.random.default_rng(13)
    P = _pts(spark, rng.normal(size=(100, 4)))
    res, score = S.diversify_and_score(P, 5, 3)
    assert res.count() == 5
    assert score.collect()[0]["avg_dist"] > 0


def test_invariant_to_shuffle_partitions(spark):
    rng = np.random.default_rng(14)
    P = _pts(spark, rng.normal(size=(40, 3)))
    a = [r["id"] for r in S.kmeanspp(P, 4, seed=2).orderBy("pos").collect()]
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = [r["id"] for r in S.kmeanspp(P.repartition(5), 4, seed=2).orderBy("pos").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_kcenter_blocks_ties_go_to_smallest_id(spark):
    P = _pts(spark, [[1.0, 1.0]] * 10, ids=[9, 3, 7, 1, 5, 8, 2, 6, 4, 0])
    P = M.with_block(P, 2, method="mod")
    got = sorted((r["block"], r["pos"], r["id"]) for r in S.kcenter_blocks(P, 3).collect())
    assert got == [(0, 0, 0), (0, 1, 2), (0, 2, 4), (1, 0, 1), (1, 1, 3), (1, 2, 5)]


def test_matching_half_of_optimum_dispersion(spark):
    import itertools

    rng = np.random.default_rng(18)
    for trial in range(2):
        X = rng.normal(size=(9, 2))
        P = _pts(spark, X)
        k = 4

        def spread(idx):
            return sum(np.sqrt(brute.sqd(X[a], X[b])) for a, b in itertools.combinations(idx, 2))

        got = [r["id"] for r in S.max_matching(P, k).collect()]
        best = max(spread(c) for c in itertools.combinations(range(9), k))
        assert spread(got) >= 0.5 * best - 1e-12


def test_small_sets_are_not_cut_like_large_shuffles(spark):
    P = _pts(spark, np.random.default_rng(35).normal(size=(50, 3)))
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        for values, parts in ((150, spark.sparkContext.defaultParallelism), (100 * greedy.PART_VALUES, 100), (10**12, 500), (None, 500)):
            passes = greedy.Passes(P, [], [], values)
            assert passes.base.rdd.getNumPartitions() == parts
            passes.close()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
