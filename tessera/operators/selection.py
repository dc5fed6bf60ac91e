"""Selection of representative points (the composite operators).

* :func:`kcenter` — farthest-first traversal (Gonzalez): start from one point,
  then k−1 times add the unchosen point farthest from its nearest center.
* :func:`kcenter_blocks` — the same traversal run independently inside every
  block, all blocks advancing together in one job per round.
* :func:`kmeanspp` — weighted k-means++ seeding: each next center is drawn with
  probability proportional to ``w * d^exponent`` over the non-centers.
* :func:`max_matching` — greedy matching for max-sum diversity: ⌊k/2⌋ times take
  the farthest remaining pair, plus one remaining point if k is odd.
* :func:`diversify` — blocks → per-block k-center coreset → matching.
* :func:`coreset_kmeans`, :func:`seed_and_score`, :func:`diversify_and_score`
  — the end-to-end programs with their objective.

Both selections go in passes over the points, each of which certifies many
choices (:mod:`tessera.operators.greedy`); a pass brings a bounded buffer to the
driver, and the result looks the chosen ids up in the points.  Random draws
use keyed hashes, so reruns and retried tasks choose the same points.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tessera.functions.rand import u01
from tessera.functions.vectors import sqdist_sql_expr
from tessera.operators import checks, vectors
from tessera.operators.greedy import Choices, Passes, by_place, farthest_first, race
from tessera.operators.iterate import drop, hold
from tessera.operators.sampling import mass_of, mass_sql, with_block

#: Points in a tile of the matching, and pairs of tiles met at a time.
TILE = 128
OPEN = 64


def _empty(points: DataFrame, keys: list[str]) -> DataFrame:
    cols = [F.col(k) for k in keys] + [F.lit(None).cast("int").alias("pos"), F.col("id"), F.col("v")]
    return points.select(*cols).limit(0)


def _ids_sql(ids: list[int]) -> str:
    return ", ".join(f"{int(i)}L" for i in ids)


def _vectors_of(base: DataFrame, chosen: list[tuple[int, int]]) -> list[Row]:
    """The chosen ``(block, id)`` with their vectors."""
    if not chosen:
        return []
    small = base.sparkSession.createDataFrame(chosen, "block int, id bigint")
    return base.join(F.broadcast(small), ["block", "id"]).select("block", "id", "v").collect()


def _first_picks(base: DataFrame, stats: list[Row], keys: list[str], first_id: int | None, seed: int | None) -> list[Row]:
    """The first center of every group: ``first_id``, else the smallest
    ``u01(seed, 0, id)`` (ties by id) when seeded, else the smallest id."""
    if not keys:
        if seed is not None and first_id is None:
            return base.orderBy(u01(seed, 0, "id"), "id").limit(1).select("id", "v").collect()
        wanted = int(first_id) if first_id is not None else stats[0]["first_id"]
        found = base.where(F.col("id") == F.lit(wanted)).select("id", "v").collect()
        if not found:
            raise ValueError(f"first_id {first_id} is not a point id")
        return found
    if seed is None:
        return _vectors_of(base, [(r["block"], r["first_id"]) for r in stats])
    tagged = base.select("block", "id", u01(seed, 0, "id").alias("m"))
    return _vectors_of(base, _best_ids(tagged, F.min("m")))


def _best_ids(tagged: DataFrame, best: F.Column) -> list[tuple[int, int]]:
    """Per block the smallest id among the rows at the best ``m``: two hash aggregates over fixed-width rows."""
    top = tagged.groupBy("block").agg(best.alias("top_"))
    at_top = tagged.join(F.broadcast(top), "block").where("m = top_")  # one row per block
    return [(r["block"], r["id"]) for r in at_top.groupBy("block").agg(F.min("id").alias("id")).collect()]


def _traverse(
    points: DataFrame,
    k: int,
    keys: list[str],
    first_id: int | None,
    seed: int | None,
    choose: Callable[[Passes, list[Row], dict[int, int], int], Choices],
    weight_col: str | None = None,
    on_small_block: str = "error",
) -> DataFrame:
    """Shared frame of farthest-first and k-means++: checks, first choices, passes; returns ``keys, pos, id, v``."""
    extra = [weight_col] if weight_col else []
    stats = checks.point_stats(points.select(*keys, "id", "v", *extra), keys, weight_col)
    if not keys and (not stats or stats[0]["n"] < k):
        raise ValueError(f"k = {k} is more than the {stats[0]['n'] if stats else 0} points")
    if on_small_block == "error" and stats and min(r["n"] for r in stats) < k:
        raise ValueError(f"a block has {min(r['n'] for r in stats)} points, fewer than k = {k}")
    dim = (stats[0]["longest"] or 0) if stats else 0
    passes = Passes(points, keys, extra, sum(r["n"] for r in stats) * max(1, dim))
    try:
        checks.check_unique_ids(passes.base)
        first = _first_picks(passes.base, stats, keys, first_id, seed)
        sizes = {r["block"] if keys else 0: r["n"] for r in stats}
        choices = choose(passes, first, sizes, dim)
    finally:
        passes.close()
    order = by_place(choices)
    chosen = points.sparkSession.createDataFrame(order, "".join(f"{c} int, " for c in keys) + "pos int, id bigint")
    chosen = vectors.broadcast_if_small(chosen, len(order), 3)
    return points.select(*keys, "id", "v").join(chosen, [*keys, "id"]).select(*keys, "pos", "id", "v")


def kcenter(
    points: DataFrame,
    k: int,
    first_id: int | None = None,
    seed: int | None = None,
    buffer: int | None = None,
    on_pass: Callable[[int], None] | None = None,
) -> DataFrame:
    """Farthest-first traversal over ``points(id, v)``: ``pos, id, v`` for k centers.

    The first center is ``first_id`` if given, else a keyed random point if
    ``seed`` is given, else the smallest id.  Ties on distance go to the
    smallest id.  Points equal by value stay distinct points; ids must be unique.
    ``buffer`` sets the points a pass brings (any number gives the same
    centers); ``on_pass`` is told after each pass how many are chosen.
    """
    checks.check_k(k)
    if k == 0:
        return _empty(points, [])

    def choose(passes: Passes, first: list[Row], sizes: dict[int, int], dim: int) -> Choices:
        return farthest_first(passes, {0: first[0]}, k, sizes, dim, buffer, on_pass)

    return _traverse(points.select("id", "v"), k, [], first_id, seed, choose)


def kcenter_blocks(
    points: DataFrame,
    k: int,
    block_col: str = "block",
    seed: int | None = None,
    on_small_block: str = "error",
    buffer: int | None = None,
    on_pass: Callable[[int], None] | None = None,
) -> DataFrame:
    """Farthest-first traversal inside every block: ``block, pos, id, v``.

    All blocks share the passes: a pass brings the farthest points of every
    block, and each block goes on as far as its own certify.  No block is ever
    gathered into one task.
    ``on_small_block="error"`` refuses blocks with fewer than k points;
    ``"all"`` keeps all points of such a block.
    """
    checks.check_k(k)
    if on_small_block not in ("error", "all"):
        raise ValueError("on_small_block must be 'error' or 'all'")
    pts = points.withColumnRenamed(block_col, "block") if block_col != "block" else points
    if k == 0:
        return _empty(pts, ["block"])
    pts = pts.withColumn("block", F.col("block").cast("int"))

    def choose(passes: Passes, first: list[Row], sizes: dict[int, int], dim: int) -> Choices:
        return farthest_first(passes, {r["block"]: r for r in first}, k, sizes, dim, buffer, on_pass)

    out = _traverse(pts, k, ["block"], None, seed, choose, on_small_block=on_small_block)
    return out.withColumnRenamed("block", block_col) if block_col != "block" else out


def kmeanspp(
    points: DataFrame,
    k: int,
    seed: int = 0,
    exponent: float = 2.0,
    weight_col: str | None = None,
    first_id: int | None = None,
    rounds: int | None = None,
    on_pass: Callable[[int], None] | None = None,
) -> DataFrame:
    """Weighted k-means++ seeding: ``pos, id, v`` for k centers.

    Round h draws one non-center with probability ``w * d^exponent / total``
    (d = distance to the nearest chosen center) by an exponential race: the
    point with the smallest ``-ln(1 - u01(seed, h, id)) / mass`` wins
    (Efraimidis–Spirakis), one aggregate instead of a global CDF.  If every
    remaining mass is 0 the smallest remaining id is taken.  ``exponent=4``
    reproduces squaring an already squared distance.  Weights must not be
    null or negative.  ``rounds`` sets how many rounds a pass looks ahead (any
    number gives the same centers; exponents other than 2 and 4 take one).
    """
    checks.check_k(k)
    checks.check_exponent(exponent)
    if k == 0:
        return _empty(points, [])
    pts = points.select("id", "v", (F.col(weight_col).cast("double") if weight_col else F.lit(1.0)).alias("w"))

    def choose(passes: Passes, first: list[Row], sizes: dict[int, int], dim: int) -> Choices:
        return race(passes, first[0], k, seed, mass_sql("m", "w", exponent), mass_of(exponent), rounds, on_pass)

    return _traverse(pts, k, [], first_id, None if first_id is not None else seed, choose, "w")


def _tiles(pts: DataFrame, n: int, dim: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The points in tiles, once: ``a, x`` (``array<struct<id, v>>``); the tiles' centres and radii.

    Tiles are balls of about ``max(TILE, sqrt(n))`` points, so there are at most
    about ``2 sqrt(n)`` of them and ``2 n`` pairs of tiles.
    """
    size = max(TILE, math.isqrt(n))
    if n <= size:
        only = pts.groupBy(F.lit(0).alias("a")).agg(F.collect_list(F.struct("id", "v")).alias("x"))
        return hold(only), np.zeros((1, dim)), np.array([math.inf])
    tiles, balls = vectors.local_tiles(pts, n, dim, size)
    at = np.array([c for _, c, _ in balls], float).reshape(len(balls), dim)
    return hold(tiles.toDF("a", "x")), at, np.array([r for _, _, r in balls])


class _TilePairs:
    """Every two tiles with the most that a pair between them can be apart, or the farthest pair once it was looked up."""

    def __init__(self, at: np.ndarray, radius: np.ndarray) -> None:
        self.a, self.b = np.triu_indices(len(at))
        apart = np.zeros(len(self.a))
        for x in at.T:
            apart += (x[self.a] - x[self.b]) ** 2
        # a bound over rounded sums: a little more than they say
        self.most = (np.sqrt(apart) + radius[self.a] + radius[self.b]) * (1 + 1e-9)
        self.known = np.zeros(len(self.a), bool)
        self.i, self.j = np.zeros(len(self.a), np.int64), np.zeros(len(self.a), np.int64)
        self.opened = 0

    def best(self) -> int | None:
        """The entry with the farthest known pair, ties to the smallest ``(i, j)``."""
        top = self.most[self.known].max(initial=-math.inf)
        if top == -math.inf:
            return None
        tied = np.flatnonzero(self.known & (self.most == top))
        return int(tied[np.lexsort((self.j[tied], self.i[tied]))[0]])

    def pending(self, at_once: int) -> np.ndarray:
        """Entries not looked up that may hold a pair as far as the best known one, the most promising first."""
        best = self.best()
        least = self.most[best] if best is not None else -math.inf
        open_ = np.flatnonzero(~self.known & (self.most >= least) & (self.most > -math.inf))
        return open_[np.argsort(-self.most[open_], kind="stable")][:at_once]

    def look_up(self, entries: np.ndarray, found: dict[tuple[int, int], Row]) -> None:
        self.opened += len(entries)
        for e in entries.tolist():
            row = found.get((int(self.a[e]), int(self.b[e])))
            self.known[e] = True
            self.most[e] = row["d"] if row else -math.inf
            if row:
                self.i[e], self.j[e] = -row["i"], -row["j"]

    def take(self, e: int) -> list[int]:
        """The pair of an entry; entries that hold one of its points have their distance as a bound from now on."""
        i, j = int(self.i[e]), int(self.j[e])
        gone = self.known & (self.most > -math.inf) & (np.isin(self.i, [i, j]) | np.isin(self.j, [i, j]))
        self.known[gone] = False
        return [i, j]


def _farthest_between(tiles: DataFrame, pairs: list[tuple[int, int]], chosen: list[int]) -> dict[tuple[int, int], Row]:
    """The farthest pair ``(d, -i, -j)`` of the points not chosen, of each of the given pairs of tiles."""
    free = f" AND NOT array_contains(array({_ids_sql(chosen)}), {{}}.id)" if chosen else ""
    pair = f"named_struct('d', sqrt({sqdist_sql_expr('p_.v', 'q_.v')}), 'i', -least(p_.id, q_.id), 'j', -greatest(p_.id, q_.id))"
    inner = f"array_max(transform(filter(y, q_ -> q_.id <> p_.id{free.format('q_')}), q_ -> {pair}))"
    best = f"array_max(transform(filter(x, p_ -> true{free.format('p_')}), p_ -> {inner}))"
    wanted = F.broadcast(tiles.sparkSession.createDataFrame(pairs, "a int, b int"))
    met = tiles.join(wanted, "a").join(tiles.toDF("b", "y"), "b")
    rows = met.selectExpr("a", "b", f"{best} AS best").where("best IS NOT NULL").collect()
    return {(r["a"], r["b"]): r["best"] for r in rows}


def max_matching(points: DataFrame, k: int, on_open: Callable[[int, int], None] | None = None) -> DataFrame:
    """Greedy max-sum diversity on a bounded point set: ``pos, id, v``.

    ⌊k/2⌋ rounds each take the farthest pair among the remaining points (ties
    to the smallest ``(i, j)``); if k is odd the smallest remaining id is
    added.  With ``k >= n`` all points are returned.

    The set is a coreset whose size is bounded by the parameters
    (``blocks * k``), not by the data.  It is cut into tiles, kept once, and
    searched by branch and bound: two tiles are met only while the distance of
    their centres plus their radii may beat the farthest pair known, at most
    ``OPEN`` of them at a time.  A taken pair leaves the distances of what it was
    part of as bounds.  Points never reach the driver, only the tiles' centres
    and a pair for each two tiles that were met.  ``on_open`` is told at the end
    how many pairs of tiles were met and how many there are.
    """
    checks.check_k(k)
    spark = points.sparkSession
    pts = hold(points.select("id", "v"))
    tiles = None
    try:
        stats = checks.point_stats(pts, [])
        n = stats[0]["n"] if stats else 0
        if n:
            checks.check_unique_ids(pts)
        if k >= n:
            return _all_in_order(points.select("id", "v"))
        chosen: list[int] = []
        if k > 1:
            tiles, at, radius = _tiles(pts, n, stats[0]["longest"] or 0)
            between = _TilePairs(at, radius)
            while len(chosen) < k - 1:
                while len(entries := between.pending(OPEN)):
                    pairs = [(int(between.a[e]), int(between.b[e])) for e in entries]
                    between.look_up(entries, _farthest_between(tiles, pairs, chosen))
                chosen += between.take(between.best())
            if on_open:
                on_open(between.opened, len(between.a))
        if k % 2:
            rest = pts.where(~F.col("id").isin(chosen)) if chosen else pts
            chosen.append(int(rest.agg(F.min("id")).first()[0]))
    finally:
        drop(tiles, pts)
    order = spark.createDataFrame([(p, i) for p, i in enumerate(chosen)], "pos int, id bigint")
    return points.select("id", "v").join(vectors.broadcast_if_small(order, k, 2), on="id").select("pos", "id", "v")


def _all_in_order(pts: DataFrame) -> DataFrame:
    """All points by id: at most k rows, a parameter."""
    rn = F.row_number().over(Window.orderBy("id")) - 1
    return pts.select(rn.cast("int").alias("pos"), "id", "v")


def diversify(points: DataFrame, k: int, blocks: int, seed: int = 0, block_method: str = "hash", on_small_block: str = "error") -> DataFrame:
    """Diversity maximisation: blocks → per-block k-center coreset → matching.  ``pos, id, v``."""
    checks.check_k(k)
    checks.check_blocks(blocks)
    if k == 0:
        return _empty(points, [])
    coreset = kcenter_blocks(with_block(points.select("id", "v"), blocks, seed, block_method), k, on_small_block=on_small_block)
    return max_matching(coreset.select("id", "v"), k)


def diversify_and_score(points: DataFrame, k: int, blocks: int, seed: int = 0, block_method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """The diversified set and its mean pairwise distance (``k, avg_dist``)."""
    result = diversify(points, k, blocks, seed, block_method)
    score = vectors.mean_pairwise_distance(result.select("id", "v")).select(F.lit(k).alias("k"), "avg_dist")
    return result, score


def seed_and_score(points: DataFrame, k: int, seed: int = 0, exponent: float = 2.0, first_id: int | None = None, denominator: str = "non_centers") -> DataFrame:
    """k-means++ seeding with unit weights, scored by the k-means objective."""
    centers = kmeanspp(points, k, seed=seed, exponent=exponent, first_id=first_id)
    return vectors.kmeans_objective(points.select("id", "v"), centers.select("id", "v"), denominator)


def coreset_kmeans(
    points: DataFrame,
    k1: int,
    k: int,
    seed: int = 0,
    exponent: float = 2.0,
    first_id: int | None = None,
    denominator: str = "non_centers",
) -> DataFrame:
    """k1 centers by farthest-first, then k of them by k-means++ (unit weights),
    scored on the whole point set."""
    checks.check_k1(k1, k)
    x = kcenter(points.select("id", "v"), k1, first_id=first_id)
    centers = kmeanspp(x.select("id", "v"), k, seed=seed, exponent=exponent, first_id=first_id)
    return vectors.kmeans_objective(points.select("id", "v"), centers.select("id", "v"), denominator)
