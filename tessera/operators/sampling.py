"""Random choices and the sampling distribution used by k-means++ seeding.

* :func:`with_weights` — unit weights or keyed random integer weights in [0, 1000).
* :func:`with_block` — a block number per point (keyed hash or ``pmod``).
* :func:`random_point` — one point chosen uniformly by a keyed hash.
* :func:`sampling_mass` — ``w * d^exponent`` of every non-center point, where d
  is the distance to the nearest center.
* :func:`cumulative_mass` — the running share of the mass in id order (a CDF),
  computed in two levels so that no single task sees all rows.
* :func:`draw_by_cdf`, :func:`draws_by_cdf` — inverse-CDF lookup: the first id whose CDF exceeds r; many draws go
  to their ranges first and read only these.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.rand import u01
from tessera.operators import vectors
from tessera.operators.iterate import hold

# Fixed values (must equal the reference's for the same results):
# random weights are integers in [0, WEIGHT_RANGE).
WEIGHT_RANGE = 1000


def with_weights(points: DataFrame, mode: str = "unit", seed: int = 0, col: str = "w") -> DataFrame:
    """Add a weight column: all 1, or ``floor(u * 1000)`` with u keyed on (seed, id)."""
    if mode == "unit":
        return points.withColumn(col, F.lit(1.0))
    if mode == "random":
        return points.withColumn(col, F.floor(u01(seed, "w", "id") * F.lit(WEIGHT_RANGE)).cast("double"))
    raise ValueError("mode must be 'unit' or 'random'")


def with_block(points: DataFrame, blocks: int, seed: int = 0, method: str = "hash", col: str = "block") -> DataFrame:
    """Assign every point to one of ``blocks`` blocks.

    ``method="hash"`` spreads points evenly whatever their ids look like
    (``floor(u01(seed, 'b', id) * blocks)``); ``method="mod"`` uses ``pmod(id, blocks)``.
    """
    if blocks < 1:
        raise ValueError("blocks must be >= 1")
    if method == "hash":
        b = F.floor(u01(seed, "b", "id") * F.lit(blocks)).cast("int")
    elif method == "mod":
        b = F.pmod(F.col("id"), F.lit(blocks)).cast("int")
    else:
        raise ValueError("method must be 'hash' or 'mod'")
    return points.withColumn(col, b)


def random_point(points: DataFrame, seed: int) -> DataFrame:
    """One point, uniformly at random: the smallest ``u01(seed, 0, id)`` (ties by id).

    Plans as ``TakeOrderedAndProject``: each task keeps its own best row.
    """
    return points.orderBy(u01(seed, 0, "id"), F.col("id")).limit(1)


def mass_sql(m: str, w: str, exponent: float) -> str:
    """``w * d^exponent`` from the squared distance ``m = d^2``, as Spark SQL text over column names."""
    if exponent == 2:
        dpow = f"`{m}`"
    elif exponent == 4:
        dpow = f"(`{m}` * `{m}`)"
    else:
        dpow = f"pow(`{m}`, {exponent / 2.0!r}D)"
    return f"(`{w}` * {dpow})"


def mass_of(exponent: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray] | None:
    """:func:`mass_sql` over numpy arrays ``w`` and ``m`` with the same bits; None for a power that is no product."""
    return {2: lambda w, m: w * m, 4: lambda w, m: w * (m * m)}.get(exponent)


def sampling_mass(
    points: DataFrame,
    centers: DataFrame,
    exponent: float = 2.0,
    weight_col: str | None = None,
) -> DataFrame:
    """``id, mass`` for every point that is not a center (by id).

    The centers are excluded by an anti join on id, broadcast when measured small.
    """
    keep = (weight_col,) if weight_col else ()
    centers = hold(centers.select("id", "v"))  # read three times; a few rows
    n_centers, dim = vectors.set_size(centers)
    nc = vectors.nearest_center(points, centers.select("id", "v"), n_centers, dim, keep=keep)
    ids = vectors.broadcast_if_small(centers.select("id"), n_centers)
    non_centers = nc.join(ids, on="id", how="left_anti")
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    return non_centers.withColumn("w_", weight).selectExpr("id", f"{mass_sql('sqdist', 'w_', exponent)} AS mass")


def cumulative_mass(
    df: DataFrame, order_col: str = "id", mass_col: str = "mass", buckets: int | None = None, bucket_col: str | None = None
) -> DataFrame:
    """Add ``cdf``: the running sum of the (non-negative) ``mass`` in ``order_col``
    order over the total.

    Two levels: rows are cut into ``buckets`` contiguous ranges of the order
    column (approximate quantiles of that column alone), each range gets its
    running sum in its own task, and a range's offset is the sum of the
    ranges before it, from a frame of ``buckets`` rows that also carries the
    total and is broadcast back.  Bucket sums are read off the windowed rows,
    so the input is computed once (one shuffle by bucket, reused).
    """
    spark = df.sparkSession
    nb = int(buckets or max(2, spark.sparkContext.defaultParallelism))
    probs = [i / nb for i in range(1, nb)]
    bounds = sorted(set(df.approxQuantile(order_col, probs, 1 / (4 * nb)))) if probs else []
    tagged = df.withColumn("_bucket", F.expr(_bucket_sql(f"CAST(`{order_col}` AS DOUBLE)", bounds)))
    within = F.sum(F.col(mass_col)).over(
        Window.partitionBy("_bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = tagged.withColumn("_within", within)
    # Masses are non-negative, so a bucket's sum is its largest running sum;
    # reading it off the windowed rows lets both branches share one shuffle.
    sums = running.groupBy("_bucket").agg(F.max("_within").alias("_bsum"))
    every = Window.orderBy("_bucket")
    offsets = sums.select(
        "_bucket",
        F.coalesce(F.sum("_bsum").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_offset"),
        F.sum("_bsum").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )
    out = running.join(F.broadcast(offsets), on="_bucket")
    kept = [F.col("_bucket").alias(bucket_col)] if bucket_col else []
    return out.select(*df.columns, *kept, ((F.col("_offset") + F.col("_within")) / F.col("_total")).alias("cdf"))


def _bucket_sql(x: str, bounds: list[float]) -> str:
    """Number of bounds under ``x``, searched in two levels: every r-th bound, then the r bounds after it."""
    if not bounds:
        return "0"
    r = max(1, math.isqrt(len(bounds)))
    rows = [bounds[i : i + r] for i in range(0, len(bounds), r)]
    literal = lambda values: "array(" + ", ".join(f"{float(b)!r}D" for b in values) + ")"
    coarse, fine = literal([row[0] for row in rows]), f"array({', '.join(map(literal, rows))})"
    # the last row that begins under x, and the bounds under x in it
    last = f"size(filter({coarse}, b_ -> b_ < {x}))"
    inside = f"size(filter(element_at({fine}, greatest({last}, 1)), b_ -> b_ < {x}))"
    return f"CASE WHEN {last} = 0 THEN 0 ELSE ({last} - 1) * {r} + {inside} END"


def draw_by_cdf(cdf: DataFrame, r: float, order_col: str = "id") -> DataFrame:
    """The first ``order_col`` whose ``cdf`` exceeds ``r``; the smallest one if none does."""
    return cdf.agg(
        F.coalesce(F.min(F.when(F.col("cdf") > F.lit(r), F.col(order_col))), F.min(F.col(order_col))).alias(order_col)
    )


def draws_by_cdf(cdf: DataFrame, rs: Sequence[float], order_col: str = "id", bucket_col: str = "bucket") -> DataFrame:
    """:func:`draw_by_cdf` for every ``r`` of ``rs``: ``draw`` (its position), ``r`` and the drawn ``order_col``.

    ``cdf`` comes from :func:`cumulative_mass` with ``bucket_col``.  The ranges'
    ends (one row per range, a number that the caller chose) tell every draw its
    range; only rows of these ranges are met, by one broadcast join.  Of a CDF
    stored partitioned by its range, only they are read.
    """
    spark = cdf.sparkSession
    ends = cdf.groupBy(bucket_col).agg(F.max("cdf").alias("top"), F.min(order_col).alias("least")).collect()
    ends = sorted(ends, key=lambda e: e[bucket_col])
    tops = [e["top"] for e in ends]
    # no top exceeds r: the smallest of all, which is the first range's
    found = [bisect.bisect_right(tops, r) for r in rs]
    where = [(i, float(r), ends[b][bucket_col] if b < len(ends) else ends[0][bucket_col], b == len(ends)) for i, (r, b) in enumerate(zip(rs, found))] if ends else []
    draws = spark.createDataFrame(where, f"draw int, r double, `{bucket_col}` {cdf.schema[bucket_col].dataType.simpleString()}, none boolean")
    near = cdf.where(F.col(bucket_col).isin(sorted({w[2] for w in where}))).select(bucket_col, order_col, "cdf")
    met = near.join(vectors.broadcast_if_small(draws, len(where), 4), bucket_col).where("none OR cdf > r")
    return met.groupBy("draw", "r").agg(F.min(order_col).alias(order_col))
