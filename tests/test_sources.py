import os

import pytest
from pyspark.sql import functions as F

from tessera.sources.sinks import write_numbers, write_points
from tessera.sources.text import read_lines, read_numbers, read_points


def test_read_numbers(spark, scratch):
    p = os.path.join(scratch, "nums.txt")
    with open(p, "w") as f:
        f.write("1 2.5\n  -3e2\t4\n\n5\n")
    got = [r["value"] for r in read_numbers(spark, p).collect()]
    assert sorted(got) == [-300.0, 1.0, 2.5, 4.0, 5.0]


def test_read_numbers_modes(spark, scratch):
    p = os.path.join(scratch, "bad.txt")
    with open(p, "w") as f:
        f.write("1 x 2\n")
    assert sorted(r["value"] for r in read_numbers(spark, p, mode="permissive").collect()) == [1.0, 2.0]
    with pytest.raises(Exception):
        read_numbers(spark, p).collect()


def test_points_text_roundtrip(spark, scratch):
    pts = spark.createDataFrame([(1, [0.1, 1e-7, -3.0]), (2, [2.0, 0.0, 5.5])], "id long, v array<double>")
    path = os.path.join(scratch, "pts")
    write_points(pts, path, fmt="text")
    back = read_points(spark, path, with_id=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, pts.collect()))


def test_read_points_any_separator(spark, scratch):
    p = os.path.join(scratch, "p.txt")
    with open(p, "w") as f:
        f.write("1.0, 2.0 ,3.0\n4 5 6\n")
    got = sorted(tuple(r["v"]) for r in read_points(spark, p).collect())
    assert got == [(1.0, 2.0, 3.0), (4.0, 5.0, 6.0)]


def test_numbers_roundtrip_and_lines(spark, scratch):
    df = spark.createDataFrame([(0.1,), (2.0,), (-7.25,)], "value double")
    path = os.path.join(scratch, "n")
    write_numbers(df, path)
    assert sorted(r["value"] for r in read_numbers(spark, path).collect()) == [-7.25, 0.1, 2.0]
    lines = read_lines(spark, path)
    assert lines.count() == 3 and lines.select(F.countDistinct("line_no")).collect()[0][0] == 3


def test_points_parquet_json(spark, scratch):
    pts = spark.createDataFrame([(1, [0.5, 1.5])], "id long, v array<double>")
    for fmt in ("parquet", "json"):
        path = os.path.join(scratch, fmt)
        write_points(pts, path, fmt=fmt)
        back = getattr(spark.read, fmt)(path)
        assert back.count() == 1


def test_write_scored_points(spark, scratch):
    import numpy as np

    from tessera.operators import selection as S
    from tessera.sources.sinks import write_scored_points

    rng = np.random.default_rng(30)
    pts = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=3)]) for i in range(30)], "id long, v array<double>")
    result, score = S.diversify_and_score(pts, 4, 2)
    path = os.path.join(scratch, "div")
    write_scored_points(result.select("id", "v"), score, path)
    line = spark.read.text(f"{path}/score").collect()[0]["value"]
    k, avg = line.split(",")
    assert int(k) == 4 and abs(float(avg) - score.collect()[0]["avg_dist"]) < 1e-12
    back = read_points(spark, f"{path}/points", with_id=True)
    assert sorted(r["id"] for r in back.collect()) == sorted(r["id"] for r in result.collect())


def test_non_finite_points_refused(spark, scratch):
    from tessera.sources.tables import points_from

    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [float("nan"), 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="non-finite"):
        points_from(df).collect()
    assert points_from(df, check_finite=False).count() == 2
    p = os.path.join(scratch, "inf.txt")
    with open(p, "w") as f:
        f.write("1 2\nInfinity 3\n")
    with pytest.raises(Exception, match="non-finite"):
        read_points(spark, p).collect()


def test_numbers_do_not_depend_on_splits(spark, scratch):
    """Line and point numbers are those of a plain read in path order, however small the splits are."""
    want_lines, want_points = [], []
    for name, n in (("a.txt", 300), ("b.txt", 1), ("c.txt", 0), ("d.txt", 170)):
        lines = [f"{i} {i * 0.5} {len(name)}" if i % 7 else "" for i in range(n)]
        with open(os.path.join(scratch, name), "w") as f:
            f.write("".join(x + "\n" for x in lines))
        want_lines += lines
        want_points += [[float(v) for v in x.split()] for x in lines if x]
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in ("128m", "700", "64"):
            spark.conf.set(key, size)
            lines = read_lines(spark, scratch)
            assert [tuple(r) for r in lines.select("line_no", "line").orderBy("line_no").collect()] == list(enumerate(want_lines))
            assert lines.select(F.countDistinct("doc_id")).first()[0] == 3
            points = read_points(spark, scratch)
            assert [(r["id"], list(r["v"])) for r in points.orderBy("id").collect()] == list(enumerate(want_points))
    finally:
        spark.conf.set(key, before)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]
