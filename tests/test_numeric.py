import math

from tessera.operators import numeric as N


def test_residues_sign_and_fraction(spark):
    vals = [0.0, -0.0, 4.0, -4.0, 3.0, -3.0, 1.5]
    df = spark.createDataFrame([(v,) for v in vals], "value double")
    got = {r["residue"]: (r["label"], r["total"], r["n"]) for r in N.residue_sums(df).collect()}
    assert got[0.0] == ("even", 0.0, 4)
    assert got[1.0] == ("odd", 3.0, 1)
    assert got[-1.0] == ("odd", -3.0, 1)
    assert got[1.5] == ("odd", 1.5, 1)
    assert all(math.copysign(1.0, k) > 0 for k in got if k == 0)


def test_summary_and_variance(spark):
    vals = [1.0, 2.0, 3.0, 4.0]
    df = spark.createDataFrame([(v,) for v in vals], "value double")
    r = N.summary(df).collect()[0]
    assert r["n"] == 4 and r["total"] == 10.0 and r["mean"] == 2.5
    assert abs(r["var_pop"] - 1.25) < 1e-12 and abs(r["var_moments"] - 1.25) < 1e-12


def test_summary_empty(spark):
    df = spark.createDataFrame([], "value double")
    r = N.summary(df).collect()[0]
    assert r["n"] == 0 and r["total"] is None and r["mean"] is None


def test_min_deviation_two_routes_agree(spark):
    from tests.conftest import SF_SMALL
    from tessera.sources.tables import load_table, numbers_from

    nums = numbers_from(load_table(spark, SF_SMALL, "events"), "value")
    a = N.min_abs_deviation(nums).collect()[0][0]
    b = N.min_abs_deviation_sorted(nums).collect()[0][0]
    assert a == b


def test_abs_deviation(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0)], "k long, value double")
    got = {r["k"]: r["abs_dev"] for r in N.abs_deviation(df, "value", "k").collect()}
    assert got == {1: 1.0, 2: 1.0}


def test_numbers_from_values(spark):
    from tessera.sources.tables import numbers_from_values

    df = numbers_from_values(spark, [1, 2.5, -3], num_partitions=2)
    assert sorted(r["value"] for r in df.collect()) == [-3.0, 1.0, 2.5]
