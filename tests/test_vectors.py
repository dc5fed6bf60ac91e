import math

import numpy as np
from pyspark.sql import functions as F

from tessera.functions.vectors import l2dist, sqdist
from tessera.operators import vectors as V
from tests import brute


def _pts(spark, X, ids=None):
    ids = ids if ids is not None else list(range(len(X)))
    return spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in zip(ids, X)], "id long, v array<double>")


def test_sqdist_matches_numpy(spark):
    rng = np.random.default_rng(1)
    A, B = rng.normal(size=(20, 8)), rng.normal(size=(20, 8))
    df = spark.createDataFrame([([float(x) for x in a], [float(x) for x in b]) for a, b in zip(A, B)], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(sqdist("a", "b")).collect()]
    assert np.allclose(got, ((A - B) ** 2).sum(1))
    got2 = [r[0] for r in df.select(l2dist("a", "b")).collect()]
    assert np.allclose(got2, np.sqrt(((A - B) ** 2).sum(1)))


def test_nearest_center_and_objective(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(40, 5))
    P = _pts(spark, X)
    C = P.where(F.col("id").isin([3, 7, 11]))
    got = {r["id"]: (r["center_id"], r["sqdist"]) for r in V.nearest_center(P, C).collect()}
    for i, x in enumerate(X):
        ds = [(brute.sqd(x, X[c]), c) for c in (3, 7, 11)]
        d, c = min(ds)
        assert got[i][0] == c and abs(got[i][1] - d) < 1e-9
    total = sum(min(brute.sqd(x, X[c]) for c in (3, 7, 11)) for x in X)
    o = V.kmeans_objectives(P, C).collect()[0]
    assert abs(o["obj_non_center"] - total / 37) < 1e-9 and abs(o["obj_all"] - total / 40) < 1e-9


def test_tiled_sets(spark, monkeypatch):
    """Many small tiles give the same answers as one inlined set."""
    rng = np.random.default_rng(3)
    X = rng.normal(size=(15, 3))
    P = _pts(spark, X)
    C = P.where("id < 6")
    one = sorted(map(tuple, V.nearest_center(P, C).collect()))
    fp1 = V.farthest_pair(P).collect()
    pw1 = sorted(map(tuple, V.pairwise_distances(P).collect()))
    m1 = V.mean_pairwise_distance(P).collect()[0][0]
    monkeypatch.setattr(V, "MAX_INLINE_VALUES", 7)
    assert V._n_tiles(15, 3) == 7
    many = sorted(map(tuple, V.nearest_center(P, C).collect()))
    assert one == many
    assert V.farthest_pair(P).collect() == fp1
    assert sorted(map(tuple, V.pairwise_distances(P).collect())) == pw1
    assert abs(V.mean_pairwise_distance(P).collect()[0][0] - m1) < 1e-12


def test_pairwise_brute_force(spark):
    rng = np.random.default_rng(16)
    X = rng.normal(size=(9, 4))
    got = {(r["i"], r["j"]): r["dist"] for r in V.pairwise_distances(_pts(spark, X)).collect()}
    assert len(got) == 36
    for (i, j), d in got.items():
        assert i < j and abs(d - np.sqrt(brute.sqd(X[i], X[j]))) < 1e-12


def test_mean_pairwise_edges(spark):
    empty = spark.createDataFrame([], "id long, v array<double>")
    assert V.mean_pairwise_distance(empty).collect()[0][0] == 0.0
    one = _pts(spark, [[1.0, 2.0]])
    assert math.isnan(V.mean_pairwise_distance(one).collect()[0][0])
    X = np.array([[0.0, 0.0], [3.0, 4.0], [6.0, 8.0]])
    assert abs(V.mean_pairwise_distance(_pts(spark, X)).collect()[0][0] - (5 + 10 + 5) / 3) < 1e-12


def test_farthest_pair_ties_smallest(spark):
    X = [[0.0], [1.0], [2.0], [0.0], [2.0]]
    r = V.farthest_pair(_pts(spark, X)).collect()[0]
    assert (r["i"], r["j"], r["dist"]) == (0, 2, 2.0)


def test_points_in_by_value(spark):
    P = _pts(spark, [[1.0], [2.0], [1.0], [3.0]])
    C = spark.createDataFrame([(99, [1.0])], "id long, v array<double>")
    assert sorted(r["id"] for r in V.points_in(P, C).collect()) == [0, 2]
    assert sorted(r["id"] for r in V.points_not_in(P, C).collect()) == [1, 3]


def test_points_meet_only_tiles_that_may_hold_the_nearest(spark, monkeypatch):
    rng = np.random.default_rng(51)
    spots = np.array([[0, 0, 0], [100, 0, 0], [0, 100, 0], [0, 0, 100], [100, 100, 100]], float)
    C = np.concatenate([s + rng.normal(size=(8, 3)) for s in spots])
    X = np.concatenate([s + rng.normal(size=(40, 3)) for s in spots] + [rng.normal(size=(10, 3)) * 80])
    P = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id long, v array<double>")
    centers = spark.createDataFrame([(1000 + i, [float(v) for v in x]) for i, x in enumerate(C)], "id long, v array<double>")
    want = sorted(map(tuple, V.nearest_center(P, centers).collect()))
    cut, balls = V.local_tiles(centers, 40, 3, 8)
    assert len(balls) >= 3 and sorted(q["id"] for r in cut.collect() for q in r["set_"]) == list(range(1000, 1040))
    # every member lies in its ball
    for r in cut.collect():
        _, c, radius = balls[r["tile_"]]
        assert all(np.linalg.norm(np.array(q["v"]) - c) <= radius * (1 + 1e-12) for q in r["set_"])
    copies = V.near_tiles(P, balls).groupBy("id").count().collect()
    assert len(copies) == len(X)
    assert sum(r["count"] for r in copies) < 2 * len(X) < len(balls) * len(X) / 2
    monkeypatch.setattr(V, "MAX_INLINE_VALUES", 24)  # eight centers of three numbers a tile
    got = V.nearest_center(P, centers)
    assert sorted(map(tuple, got.collect())) == want
    assert "balls_" in got._jdf.queryExecution().analyzed().toString()
    # equal centers at equal distances: the smallest id, whatever tile it is in
    same = spark.createDataFrame([(i, [float(i % 3), 0.0, 0.0]) for i in range(60)], "id long, v array<double>")
    got = V.nearest_center(P, same).select("id", "center_id").collect()
    assert {r["center_id"] for r in got} <= {0, 1, 2}
