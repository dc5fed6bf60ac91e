import numpy as np
from pyspark.sql import functions as F

from tessera.functions.rand import u01, u01_value
from tessera.operators import sampling as M


def _pts(spark, X, ids=None):
    ids = ids if ids is not None else list(range(len(X)))
    return spark.createDataFrame([(int(i), [float(v) for v in x]) for i, x in zip(ids, X)], "id long, v array<double>")


def test_cumulative_mass_matches_numpy(spark):
    rng = np.random.default_rng(20)
    ids = sorted(rng.choice(10_000, size=300, replace=False).tolist())
    mass = rng.random(300)
    df = spark.createDataFrame([(int(i), float(m)) for i, m in zip(ids, mass)], "id long, mass double")
    want = np.cumsum(mass) / mass.sum()
    for nb in (1, 2, 7, 50):
        got = {r["id"]: r["cdf"] for r in M.cumulative_mass(df, buckets=nb).collect()}
        assert np.allclose([got[i] for i in ids], want, atol=1e-12), nb


def test_cumulative_mass_many_buckets(spark):
    rng = np.random.default_rng(24)
    mass = rng.random(20_000)
    df = spark.createDataFrame([(int(i), float(m)) for i, m in enumerate(mass)], "id long, mass double")
    got = np.array([r["cdf"] for r in M.cumulative_mass(df, buckets=8_000).orderBy("id").collect()])
    assert np.allclose(got, np.cumsum(mass) / mass.sum(), atol=1e-12)


def test_draw_by_cdf(spark):
    df = spark.createDataFrame([(1, 0.2), (5, 0.5), (9, 1.0)], "id long, cdf double")
    assert M.draw_by_cdf(df, 0.1).collect()[0]["id"] == 1
    assert M.draw_by_cdf(df, 0.2).collect()[0]["id"] == 5
    assert M.draw_by_cdf(df, 0.99).collect()[0]["id"] == 9
    assert M.draw_by_cdf(df, 1.0).collect()[0]["id"] == 1  # none exceeds r: smallest id


def test_sampling_mass_excludes_centers(spark):
    P = _pts(spark, [[0.0], [1.0], [3.0]]).withColumn("w", F.lit(2.0))
    C = P.where("id = 0").select("id", "v")
    got = {r["id"]: r["mass"] for r in M.sampling_mass(P, C, 2.0, weight_col="w").collect()}
    assert got == {1: 2.0, 2: 18.0}
    got4 = {r["id"]: r["mass"] for r in M.sampling_mass(P, C, 4.0).collect()}
    assert got4 == {1: 1.0, 2: 81.0}


def test_random_point_and_u01(spark):
    P = _pts(spark, [[float(i)] for i in range(100)])
    got = M.random_point(P, 7).collect()[0]["id"]
    want = min(range(100), key=lambda i: (u01_value(7, 0, i), i))
    assert got == want
    vals = [r[0] for r in P.select(u01(3, 1, "id")).collect()]
    assert vals == [u01_value(3, 1, i) for i in range(100)]
    assert all(0.0 <= v < 1.0 for v in vals)


def test_with_block_balanced_and_weights(spark):
    P = _pts(spark, [[0.0]] * 4000, ids=list(range(0, 8000, 2)))  # only even ids
    counts = [r["count"] for r in M.with_block(P, 4).groupBy("block").count().collect()]
    assert len(counts) == 4 and min(counts) > 800
    mod = {r["block"] for r in M.with_block(P, 4, method="mod").select("block").distinct().collect()}
    assert mod == {0, 2}
    w = [r["w"] for r in M.with_weights(P, "random", seed=1).collect()]
    assert all(0 <= x < 1000 and x == int(x) for x in w)
    assert {r["w"] for r in M.with_weights(P, "unit").collect()} == {1.0}


def test_many_draws_go_to_their_ranges(spark, scratch):
    rng = np.random.default_rng(41)
    mass = [float(x) for x in rng.integers(0, 4, 300)]
    df = spark.createDataFrame([(i * 3, m) for i, m in enumerate(mass)], "id long, mass double")
    path = f"{scratch}/cdf"
    M.cumulative_mass(df, buckets=9, bucket_col="bucket").write.partitionBy("bucket").parquet(path)
    cdf = spark.read.parquet(path)
    plain = {r["id"]: r["cdf"] for r in M.cumulative_mass(df, buckets=9).collect()}
    assert {r["id"]: r["cdf"] for r in cdf.collect()} == plain
    rs = [0.0, 0.5, 0.5, 0.999999, 1.0, 2.0, *rng.random(20)]
    got = M.draws_by_cdf(cdf, rs)
    rows = {r["draw"]: r["id"] for r in got.collect()}
    for i, r in enumerate(rs):
        want = [k for k, c in plain.items() if c > r] or list(plain)
        assert rows[i] == min(want) == M.draw_by_cdf(cdf, r).first()[0], r
    one = M.draws_by_cdf(cdf, [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in one or "PartitionFilters: [(bucket" in one
    assert M.draws_by_cdf(cdf.limit(0), [0.5]).count() == 0 and M.draws_by_cdf(cdf, []).count() == 0
