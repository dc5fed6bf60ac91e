"""Checks of arguments and point sets, made before any round starts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def check_k(k: int, name: str = "k") -> int:
    if not isinstance(k, int) or isinstance(k, bool):
        raise TypeError(f"{name} must be an int")
    if k < 0:
        raise ValueError(f"{name} must be >= 0")
    return k


def check_blocks(blocks: int) -> int:
    if not isinstance(blocks, int) or blocks < 1:
        raise ValueError("the number of blocks must be >= 1")
    return blocks


def check_k1(k1: int, k: int) -> None:
    if k1 < k:
        raise ValueError(f"the coreset needs at least k = {k} centers, k1 is {k1}")


def check_exponent(exponent: float) -> float:
    if exponent <= 0:
        raise ValueError("exponent must be > 0")
    return float(exponent)


def check_lengths(shortest: int | None, longest: int | None) -> int:
    """The common length of the vectors (0 without any)."""
    if shortest != longest:
        raise ValueError(f"vectors of different lengths: {shortest} to {longest}")
    return int(longest or 0)


def point_stats(points: DataFrame, keys: list[str], weight_col: str | None = None) -> list[Row]:
    """``keys, n, first_id`` of every group, one aggregate over the points.

    Refuses vectors of different lengths, null ids, and weights that are null,
    NaN or negative.
    """
    size = F.size("v")
    bad = F.lit(False)
    if weight_col:
        w = F.col(weight_col)
        bad = w.isNull() | F.isnan(w) | (w < 0)
    rows = (
        points.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("id").alias("first_id"),
            F.min(size).alias("shortest"),
            F.max(size).alias("longest"),
            F.count_if(F.col("id").isNull()).alias("no_id"),
            F.count_if(bad).alias("bad_weights"),
        )
        .collect()
    )
    held = [r for r in rows if r["n"]]
    if held:
        check_lengths(min(r["shortest"] for r in held), max(r["longest"] for r in held))
    if any(r["no_id"] for r in held):
        raise ValueError("a point without an id")
    if any(r["bad_weights"] for r in held):
        raise ValueError("weights must be numbers of 0 or more, one for each point")
    return held


def check_unique_ids(points: DataFrame) -> None:
    """Refuses an id that two points share (only ids are shuffled)."""
    twice = points.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"id {twice[0]['id']} belongs to {twice[0]['n']} points")
