"""Greedy selections in few passes over the points.

Farthest-first traversal and k-means++ seeding choose one point after the
other.  Both look at a quantity that only falls while points are chosen: the
squared distance ``m`` to the nearest choice.  So a pass that brings the best
points of the moment certifies many choices, not one:

* :class:`FarthestBuffer` — the M points with the largest ``m``.  Choices go on
  inside the buffer, with ``m`` updated there, as long as the best one is not
  behind the M-th of the pass; every other point was behind it then and can
  only have fallen.
* :class:`RaceBuffer` — the points whose race key in one of the next rounds is
  at most a bound.  Masses fall, so keys rise: the smallest updated key of a
  round decides it as long as it is at most the bound.

The points are persisted once, dealt and sorted by id.  The state between
passes is a row of numbers per point (``id``, group, weight, ``m``) with the same
partitioning, so a pass joins the two without an exchange and writes no vector
again.  Every ``REBASE`` passes the state is made from the points and all
choices anew, which keeps plans and lineage short without a table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tessera.functions.rand import u01_spark_sql
from tessera.functions.vectors import sqdist_sql_expr
from tessera.operators.iterate import drop, hold_partitioned

#: Passes between two states that are made from the points and all choices.
REBASE = 16
#: Rows of a pass's buffer at most (over all groups their vectors stay under ``BUFFER_VALUES`` numbers), and rows of
#: all tasks that are merged for it.
BUFFER_ROWS = 900
BUFFER_VALUES = 1 << 20
MERGED_ROWS = 1 << 24
#: Numbers of the vectors in a partition of the persisted points (64 MB), if the session's shuffles are no narrower.
PART_VALUES = 1 << 23
#: Rounds of a race that a pass looks ahead, and points per round that it expects under its bound.
RACE_ROUNDS = 16
RACE_ROWS = 64


def sqdists(columns: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Squared distances to ``p`` of the points in the columns, summed dimension by dimension like the Spark expression
    (so the same bits)."""
    out = np.zeros(columns.shape[1])
    for row, x in zip(columns, p):
        d = row - x
        out += d * d
    return out


class Choices:
    """Chosen points by group: ids and vectors in order."""

    def __init__(self, keys: list[str]) -> None:
        self.keys = keys
        self.by: dict[int, list[tuple[int, list[float]]]] = {}

    def add(self, group: int, point: int, vector: list[float]) -> None:
        self.by.setdefault(group, []).append((int(point), [float(x) for x in vector]))

    def count(self, group: int) -> int:
        return len(self.by.get(group, ()))

    def since(self, counts: dict[int, int]) -> Choices:
        """What was chosen after ``counts`` choices of each group."""
        later = Choices(self.keys)
        later.by = {g: c[counts.get(g, 0) :] for g, c in self.by.items() if len(c) > counts.get(g, 0)}
        return later

    def counts(self) -> dict[int, int]:
        return {g: len(c) for g, c in self.by.items()}


def folded(rows: DataFrame, new: Choices, keep: list[str]) -> DataFrame:
    """``keep`` and ``m`` of the rows (``id, v, m`` and others) with the new choices folded into ``m`` and left out themselves.

    One group: the choices are one array value.  Blocks: a local relation of one
    row per block, broadcast.  Either holds the buffers of a pass at most
    (``BUFFER_VALUES`` numbers), or all choices at a rebase (``k * blocks * dim``).
    """
    spark = rows.sparkSession
    fold = f"aggregate(vs_, m, (a_, p_) -> least(a_, {sqdist_sql_expr('v', 'p_')}))"
    if not new.keys:
        chosen = new.by.get(0, [])
        if not chosen:
            return rows.select(*keep, "m")
        one = spark.createDataFrame([([i for i, _ in chosen], [v for _, v in chosen])], "ids_ array<bigint>, vs_ array<array<double>>")
        met = rows.where(~F.col("id").isin([i for i, _ in chosen])).withColumn("vs_", one.select("vs_").scalar())
        return met.selectExpr(*keep, f"{fold} AS m")
    small = spark.createDataFrame(
        [(g, [i for i, _ in c], [v for _, v in c]) for g, c in new.by.items()], "block int, ids_ array<bigint>, vs_ array<array<double>>"
    )
    met = rows.join(F.broadcast(small), "block", "left").where("ids_ IS NULL OR NOT array_contains(ids_, id)")
    return met.selectExpr(*keep, f"CASE WHEN vs_ IS NULL THEN m ELSE {fold} END AS m")


class Passes:
    """The persisted points and the state of the pass at hand."""

    def __init__(self, points: DataFrame, keys: list[str], extra: list[str], values: int | None = None) -> None:
        """``values``: numbers of all vectors, where the caller counted them; a small set is not cut as finely as shuffles are."""
        self.keys, self.extra = keys, extra
        self.narrow = [*keys, "id", *extra]
        spark = points.sparkSession
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if values is not None:
            parts = min(parts, max(spark.sparkContext.defaultParallelism, -(-values // PART_VALUES)))
        # dealt and sorted by id: joins with the state need no exchange and no sort
        self.base = hold_partitioned(points.select(*keys, "id", "v", *extra).repartition(parts, "id").sortWithinPartitions("id"))
        self.parts = parts
        self.state: DataFrame | None = None
        self.before: DataFrame | None = None
        self.seen: dict[int, int] = {}
        self.n = 0

    def next_state(self, choices: Choices) -> DataFrame:
        """The state with all choices so far, persisted; the one before it is dropped by :meth:`done`."""
        if self.state is None or self.n % REBASE == 0:
            rows, new = self.base.withColumn("m", F.lit(math.inf)), choices
        else:
            known = self.state.select("id", "m").hint("merge")
            rows, new = self.base.join(known, "id"), choices.since(self.seen)
        self.before, self.state = self.state, hold_partitioned(folded(rows, new, self.narrow))
        self.seen = choices.counts()
        self.n += 1
        return self.state

    def done(self) -> None:
        """The new state is computed; the one before it goes."""
        drop(self.before)
        self.before = None

    def close(self) -> None:
        drop(self.before, self.state, self.base)

    def vectors_of(self, few: DataFrame) -> list[Row]:
        """The rows of a bounded ``few`` (``id`` and numbers) with the vectors of their points."""
        return self.base.select(*self.keys, "id", "v").join(F.broadcast(few.drop(*self.keys)), "id").collect()

    def buffer_rows(self, dim: int, groups: int) -> int:
        """Rows of a group's buffer: bounded in numbers on the driver and in rows merged from all tasks."""
        return max(1, min(BUFFER_ROWS, BUFFER_VALUES // max(1, dim * groups), MERGED_ROWS // max(1, self.parts * groups)))


class FarthestBuffer:
    """The farthest points of a group as a pass left them, and the choices that they certify."""

    def __init__(self, rows: list[Row], whole: bool) -> None:
        rows = sorted(rows, key=lambda r: (-r["m"], r["id"]))
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.m = np.array([r["m"] for r in rows], float)
        self.vectors = np.array([r["v"] for r in rows], float).T.copy() if rows else np.zeros((0, 0))
        #: the last row of the pass: no point outside comes before it (none: all points are inside)
        self.last = None if whole or not rows else (rows[-1]["m"], rows[-1]["id"])
        self.free = np.ones(len(rows), bool)

    def take(self) -> tuple[int, np.ndarray] | None:
        """The next choice, if it is certain: the largest ``m``, smallest id on ties."""
        if not self.free.any():
            return None
        top = self.m[self.free].max()
        tied = np.flatnonzero(self.free & (self.m == top))
        i = tied[np.argmin(self.ids[tied])]
        if self.last is not None and (top < self.last[0] or (top == self.last[0] and self.ids[i] > self.last[1])):
            return None
        self.free[i] = False
        v = self.vectors[:, i]
        self.m = np.minimum(self.m, sqdists(self.vectors, v))
        return int(self.ids[i]), v


def farthest_first(
    passes: Passes, first: dict[int, Row], k: int, sizes: dict[int, int], dim: int, buffer: int | None, on_pass: Callable[[int], None] | None
) -> Choices:
    """Farthest-first traversal of all groups together: ``k`` choices each, or all points of a smaller group."""
    keys = passes.keys
    choices = Choices(keys)
    for g, r in first.items():
        choices.add(g, r["id"], r["v"])
    wanted = {g: min(k, n) for g, n in sizes.items()}
    most = buffer or passes.buffer_rows(dim, len(sizes))
    order = [F.col("m").desc(), F.col("id").asc()]
    while any(choices.count(g) < n for g, n in wanted.items()):
        state = passes.next_state(choices)
        if keys:
            # each task keeps its own M of every group before the exchange
            place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
            top = state.withColumn("place_", place).where(F.col("place_") <= most).drop("place_")
        else:
            top = state.orderBy(*order).limit(most)
        by: dict[int, list[Row]] = {}
        for r in passes.vectors_of(top):
            by.setdefault(r["block"] if keys else 0, []).append(r)
        passes.done()
        for g, n in wanted.items():
            rows = by.get(g, [])
            held = FarthestBuffer(rows, whole=len(rows) == sizes[g] - choices.count(g))
            while choices.count(g) < n and (found := held.take()) is not None:
                choices.add(g, *found)
        if on_pass:
            on_pass(sum(choices.counts().values()))
    return choices


class RaceBuffer:
    """The points that may win one of the next rounds of a race, and the rounds that they decide."""

    def __init__(self, rows: list[Row], bound: float, mass: Callable[[np.ndarray, np.ndarray], np.ndarray] | None) -> None:
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.w, self.m = (np.array([r[c] for r in rows], float) for c in ("w", "m"))
        self.stale = np.array([r["mass"] for r in rows], float)
        self.vectors = np.array([r["v"] for r in rows], float).T.copy() if rows else np.zeros((0, 0))
        self.draws = [{x["h"]: x["e"] for x in r["hits"]} for r in rows]
        self.bound, self.mass = bound, mass
        self.free = np.ones(len(rows), bool)
        self.fresh = True

    def take(self, h: int) -> tuple[int, np.ndarray] | None:
        """The winner of round ``h``, if it is certain: the smallest key, smallest id on ties."""
        if not self.fresh and self.mass is None:
            return None
        mass = self.stale if self.fresh else self.mass(self.w, self.m)
        racing = np.flatnonzero(self.free & (mass > 0))
        with np.errstate(over="ignore"):  # a mass near zero: an infinite key, as in Spark
            keys = [(self.draws[i][h] / mass[i], self.ids[i], i) for i in racing if h in self.draws[i]]
        if not keys or min(keys)[0] > self.bound:
            return None
        i = min(keys)[2]
        self.free[i] = False
        self.fresh = False
        v = self.vectors[:, i]
        self.m = np.minimum(self.m, sqdists(self.vectors, v))
        return int(self.ids[i]), v


def race(
    passes: Passes,
    first: Row,
    k: int,
    seed: int,
    mass_sql: str,
    mass: Callable[[np.ndarray, np.ndarray], np.ndarray] | None,
    rounds: int | None,
    on_pass: Callable[[int], None] | None,
) -> Choices:
    """Draws by mass (``mass_sql`` over ``w`` and ``m``; ``mass`` the same in numpy, None if its bits are not the same)."""
    choices = Choices([])
    choices.add(0, first["id"], first["v"])
    ahead = 1 if mass is None else rounds or RACE_ROUNDS
    while (h := choices.count(0)) < k:
        state = passes.next_state(choices)
        total = state.select(F.sum(F.expr(f"CASE WHEN {mass_sql} > 0 THEN {mass_sql} END"))).first()[0] or 0.0
        passes.done()
        if total == 0:  # nothing left to draw by: the smallest ids, and masses only fall
            for r in sorted(passes.vectors_of(state.orderBy("id").limit(k - h).select("id")), key=lambda r: r["id"]):
                choices.add(0, r["id"], r["v"])
            break
        bound = RACE_ROWS / total
        while choices.count(0) == h:  # the first round is decided once anything is under the bound
            held = _race_buffer(passes, state, h, min(k, h + ahead), seed, mass_sql, mass, bound)
            while (now := choices.count(0)) < min(k, h + ahead) and (found := held.take(now)) is not None:
                choices.add(0, *found)
            bound *= 16
        if on_pass:
            on_pass(choices.count(0))
    return choices


def _race_buffer(passes: Passes, state: DataFrame, h: int, end: int, seed: int, mass_sql: str, mass, bound: float) -> RaceBuffer:
    draw = lambda r: f"-ln(1D - {u01_spark_sql(seed, r, 'id')})"
    racing = state.withColumn("mass", F.expr(mass_sql)).where("mass > 0")
    if math.isinf(bound):  # masses too small for a bound: one round, decided by the order itself
        rows = racing.withColumn("e", F.expr(draw(h))).orderBy(F.col("e") / F.col("mass"), "id").limit(1)
        rows = rows.withColumn("hits", F.array(F.struct(F.lit(h).alias("h"), F.col("e"))))
    else:
        draws = ", ".join(f"named_struct('h', {r}, 'e', {draw(r)})" for r in range(h, end))
        rows = racing.withColumn("hits", F.expr(f"filter(array({draws}), x_ -> x_.e / mass <= {bound!r}D)")).where("size(hits) > 0")
    near = rows.select("id", "w", "m", "mass", "hits").hint("merge")
    return RaceBuffer(passes.base.select("id", "v").join(near, "id").collect(), bound, mass)


def by_place(choices: Choices) -> list[tuple]:
    """``keys, pos, id`` of all choices."""
    return [(*([g] if choices.keys else []), pos, i) for g, c in sorted(choices.by.items()) for pos, (i, _) in enumerate(c)]
