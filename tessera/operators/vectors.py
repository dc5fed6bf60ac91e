"""Point-set operators over ``DataFrame[id bigint, v array<double>]``.

A *bounded* point set — centers (k of them), a coreset (``blocks * k``), a
result (k) — is measured first.  Up to ``MAX_INLINE_VALUES`` numbers reach
every task as one array value, and every point folds over it in place: no
join, no shuffle, no (point, point) rows.  A larger set is cut into tiles of
that size that stay distributed; points meet them by an equi-join on the tile
number and a salt, and a point's results are combined by id.  Both ways give
the same rows.  Tiles for nearest centers are balls (:func:`local_tiles`), and a
point is copied only to the balls that its nearest center can lie in.

Comparing every point with every member of the set is the definition of
these operators (the k-means assignment, the farthest pair, the mean pairwise
distance); the library applies them only to sets whose size is bounded by
parameters.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.vectors import sqdist_sql_expr
from tessera.operators import checks

# Numbers (members x dimensions) of an inlined set or of a tile.
MAX_INLINE_VALUES = 1_000_000
# A join side is broadcast only when measured at or under this many numbers.
MAX_BROADCAST_VALUES = 8_000_000
# Members looked at for each tile of a set that is cut into balls.
SPREAD = 16


def broadcast_if_small(df: DataFrame, n_rows: int, width: int = 1) -> DataFrame:
    """``broadcast(df)`` when ``n_rows * width`` (measured by the caller) is under
    the bound; otherwise ``df`` as is, and Spark shuffles both sides."""
    return F.broadcast(df) if n_rows * max(1, width) <= MAX_BROADCAST_VALUES else df


def set_size(df: DataFrame) -> tuple[int, int]:
    """Number of points and their dimension, one small job; vectors must be equally long."""
    size = F.size("v")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("lo"), F.max(size).alias("hi")).collect()[0]
    return int(row["n"]), checks.check_lengths(row["lo"], row["hi"])


def _n_tiles(n: int, dim: int) -> int:
    return max(1, math.ceil(n * max(1, dim) / MAX_INLINE_VALUES))


def _against(points: DataFrame, members: DataFrame, n: int, dim: int) -> tuple[DataFrame, bool]:
    """``points`` with members as ``set_`` (``array<struct<id, v>>``), and whether a point has several rows (one per tile).

    A point of another length than the members fails the job.
    """
    tiles = _n_tiles(n, dim)
    if n:
        fits = F.size("v") == dim
        points = points.where(fits | F.raise_error(F.lit(f"a vector is not of length {dim}")))
    member = F.struct(F.col("id").alias("id"), F.col("v").alias("v"))
    if tiles == 1:
        return points.select("*", members.select(F.collect_list(member)).scalar().alias("set_")), False
    salts = max(1, -(-points.sparkSession.sparkContext.defaultParallelism // tiles))
    cut = members.groupBy(F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int").alias("tile_")).agg(F.collect_list(member).alias("set_"))
    cut = cut.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = points.withColumn("salt_", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(salts)).cast("int"))
    spread = spread.withColumn("tile_", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    return spread.join(cut, ["tile_", "salt_"]).drop("tile_", "salt_"), True


def local_tiles(members: DataFrame, n: int, dim: int, size: int) -> tuple[DataFrame, list[tuple[int, list[float], float]]]:
    """A bounded set cut into balls of about ``size`` members at most: ``tile_, set_`` (``array<struct<id, v>>``), and
    number, center and radius of every tile, the only part that reaches the driver.

    Members go to the nearest of ``n / size`` of them, chosen far apart from
    keyed random ones; a fuller ball is split by hash.
    """
    count = -(-n // max(1, size))
    most = max(count, min(SPREAD * count, MAX_INLINE_VALUES // max(1, dim)))
    some = members.select("id", "v").orderBy(F.xxhash64("id", F.lit(3)), "id").limit(most).collect()
    known = {some[i]["id"]: list(some[i]["v"]) for i in _far_apart(np.array([r["v"] for r in some], float), count)}
    pivots = members.sparkSession.createDataFrame(list(known.items()), "id long, v array<double>")
    near = nearest_center(members, pivots, len(known), dim, keep=("v",))
    meta, parts = [], []
    for r in near.groupBy("center_id").agg(F.count(F.lit(1)).alias("n"), F.max("sqdist").alias("far")).orderBy("center_id").collect():
        split = -(-r["n"] // size)
        parts.append((r["center_id"], len(meta), split))
        meta += [(len(meta) + i, known[r["center_id"]], math.sqrt(r["far"])) for i in range(split)]
    numbers = members.sparkSession.createDataFrame(parts, "center_id long, first_ int, parts_ int")
    tile = F.col("first_") + F.pmod(F.xxhash64("id", F.lit(4)), F.col("parts_")).cast("int")
    met = near.join(broadcast_if_small(numbers, len(parts), 3), "center_id")
    return met.groupBy(tile.alias("tile_")).agg(F.collect_list(F.struct("id", "v")).alias("set_")), meta


def _far_apart(x: np.ndarray, count: int) -> list[int]:
    """Farthest-first rows of a bounded sample, as seeds of the tiles (any choice gives right results)."""
    chosen, m = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(x)):
        chosen.append(int(m.argmax()))
        m = np.minimum(m, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
        m[chosen] = -1
    return chosen


def near_tiles(points: DataFrame, meta: list[tuple[int, list[float], float]]) -> DataFrame:
    """``points`` once for every tile that may hold the nearest member, as ``tile_``.

    The centers of the tiles are members, so the nearest of them bounds the
    distance ``u``; by the triangle inequality nothing in a ball is nearer than
    its center's distance less its radius, and balls with more than ``u`` are left out.
    """
    spark = points.sparkSession
    all_ = spark.createDataFrame([(meta,)], "balls_ array<struct<t: int, c: array<double>, r: double>>").select("balls_").scalar()
    reach = f"transform(balls_, b_ -> named_struct('t', b_.t, 'd', sqrt({sqdist_sql_expr('v', 'b_.c')}), 'r', b_.r))"
    held = points.withColumn("balls_", all_).withColumn("reach_", F.expr(reach)).drop("balls_")
    held = held.withColumn("u_", F.expr("array_min(transform(reach_, b_ -> b_.d))"))
    # a little more than the bound: the distances are rounded sums
    open_ = F.expr("transform(filter(reach_, b_ -> b_.d - b_.r <= u_ + 1e-9D * (u_ + b_.d + b_.r)), b_ -> b_.t)")
    return held.withColumn("tile_", F.explode(open_)).drop("reach_", "u_")


# The folds below are built as SQL text (one call into the JVM each); the
# lambda variable ``q_`` is one member of the set.
_D2 = sqdist_sql_expr("v", "q_.v")


def nearest_center(
    points: DataFrame,
    centers: DataFrame,
    n_centers: int | None = None,
    dim: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """For every point: the nearest center (smallest id on ties) and the squared distance.

    Output: ``id, center_id, sqdist`` plus the ``keep`` columns of ``points``.
    """
    if n_centers is None or dim is None:
        n_centers, dim = set_size(centers)
    own = points.select("id", "v", *[c for c in keep if c != "v"])
    tiles = _n_tiles(n_centers, dim)
    if tiles == 1:
        met, several = _against(own, centers.select("id", "v"), n_centers, dim)
    else:
        fits = (F.size("v") == dim) | F.raise_error(F.lit(f"a vector is not of length {dim}"))
        cut, balls = local_tiles(centers.select("id", "v"), n_centers, dim, -(-n_centers // tiles))
        salts = max(1, -(-points.sparkSession.sparkContext.defaultParallelism // len(balls)))
        cut = cut.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        spread = near_tiles(own.where(fits), balls).withColumn("salt_", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(salts)).cast("int"))
        met, several = spread.join(cut, ["tile_", "salt_"]).drop("tile_", "salt_"), True
    # structs compare by d, then id: the nearest center, smallest id on ties
    best = met.selectExpr("id", *keep, f"array_min(transform(set_, q_ -> named_struct('d', {_D2}, 'cid', q_.id))) AS _b")
    if several:
        best = best.groupBy("id", *keep).agg(F.min("_b").alias("_b"))
    return best.select("id", F.col("_b.cid").alias("center_id"), F.col("_b.d").alias("sqdist"), *keep)


def kmeans_objectives(points: DataFrame, centers: DataFrame) -> DataFrame:
    """Sum over points of the squared distance to the nearest center, divided by
    ``n - |C|`` (``obj_non_center``) and by ``n`` (``obj_all``), one row.

    A point equal to a center is at distance 0 from it, so it adds nothing to
    the sum either way.  ``n = |C|`` gives NULL for ``obj_non_center``.
    """
    n_centers, dim = set_size(centers)
    nc = nearest_center(points, centers, n_centers=n_centers, dim=dim)
    total, n = F.sum("sqdist"), F.count(F.lit(1)).cast("double")
    return nc.agg(
        F.try_divide(total, n - F.lit(float(n_centers))).alias("obj_non_center"),
        F.try_divide(total, n).alias("obj_all"),
    )


def kmeans_objective(points: DataFrame, centers: DataFrame, denominator: str = "non_centers") -> DataFrame:
    """The k-means objective with one denominator: ``n - |C|`` (``"non_centers"``,
    the default) or ``n`` (``"all"``).  Output: one row ``objective``."""
    if denominator not in ("non_centers", "all"):
        raise ValueError("denominator must be 'non_centers' or 'all'")
    both = kmeans_objectives(points, centers)
    col = "obj_non_center" if denominator == "non_centers" else "obj_all"
    return both.select(F.col(col).alias("objective"))


def _center_vectors(centers: DataFrame) -> DataFrame:
    n, dim = set_size(centers)
    return broadcast_if_small(centers.select("v").distinct(), n, dim)


def points_in(points: DataFrame, centers: DataFrame) -> DataFrame:
    """Points whose vector equals (by value) the vector of some center.
    A join on the vector value; the centers are broadcast when measured small."""
    return points.join(_center_vectors(centers), on="v", how="left_semi")


def points_not_in(points: DataFrame, centers: DataFrame) -> DataFrame:
    """Points whose vector equals no center's vector."""
    return points.join(_center_vectors(centers), on="v", how="left_anti")


def farthest_partner(left: DataFrame, cands: DataFrame, n: int | None = None, dim: int | None = None) -> DataFrame:
    """For every point ``i`` of ``left``: the farthest point ``j`` of ``cands``
    with ``j > i`` (ties to the smaller ``j``).  Output ``i, j, d``; a point
    with no larger candidate has no row."""
    if n is None or dim is None:
        n, dim = set_size(cands)
    met, several = _against(left.select("id", "v"), cands.select("id", "v"), n, dim)
    farthest = f"array_max(transform(filter(set_, q_ -> q_.id > id), q_ -> named_struct('d', sqrt({_D2}), 'nj', -q_.id)))"
    best = met.selectExpr("id AS i", f"{farthest} AS _b").where("_b IS NOT NULL")
    if several:
        best = best.groupBy("i").agg(F.max("_b").alias("_b"))
    return best.selectExpr("i", "-_b.nj AS j", "_b.d AS d")


def pairwise_distances(points: DataFrame) -> DataFrame:
    """Every unordered pair ``i < j`` with its Euclidean distance: ``i, j, dist``.

    The output is quadratic in the size of the set by definition: use on
    bounded sets (coresets, results).
    """
    n, dim = set_size(points)
    met, _ = _against(points.select("id", "v"), points.select("id", "v"), n, dim)
    out = met.selectExpr(
        "id AS i", f"explode(transform(filter(set_, q_ -> q_.id > id), q_ -> named_struct('j', q_.id, 'dist', sqrt({_D2})))) AS _p"
    )
    return out.selectExpr("i", "_p.j AS j", "_p.dist AS dist")


def farthest_pair(points: DataFrame) -> DataFrame:
    """The pair at the largest distance; ties go to the smallest ``(i, j)``.

    One row ``i, j, dist`` (none if fewer than two points).
    """
    fp = farthest_partner(points, points)
    top = fp.orderBy(F.col("d").desc(), F.col("i").asc(), F.col("j").asc()).limit(1)
    return top.select("i", "j", F.col("d").alias("dist"))


def mean_pairwise_distance(points: DataFrame) -> DataFrame:
    """Mean Euclidean distance over all pairs of distinct points.

    0 for an empty set, NaN for a single point (0/0).  Output: ``avg_dist``.
    Every point sums its distances to the points with a larger id; the mean
    over unordered pairs equals the mean over ordered pairs.
    """
    n, dim = set_size(points)
    met, _ = _against(points.select("id", "v"), points.select("id", "v"), n, dim)
    total = met.selectExpr(f"aggregate(filter(set_, q_ -> q_.id > id), 0D, (s_, q_) -> s_ + sqrt({_D2})) AS s").agg(F.sum("s").alias("s"))
    pairs = n * (n - 1) / 2.0
    value = F.lit(0.0) if n == 0 else (F.lit(math.nan) if n == 1 else F.col("s") / F.lit(pairs))
    return total.select(value.alias("avg_dist"))
