"""Sinks: write point sets and number sets as parquet, json or text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _vector_text(v: str = "v") -> F.Column:
    return F.concat_ws(",", F.transform(F.col(v), lambda x: x.cast("string")))


def write_points(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write ``id, v`` (and any other columns) to ``path``.

    ``fmt="text"`` writes one line per point, ``id,x1,x2,...``, which
    ``read_points(..., with_id=True)`` reads back.
    """
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
    elif fmt == "json":
        df.write.mode(mode).json(path)
    elif fmt == "text":
        line = F.concat_ws(",", F.col("id").cast("string"), _vector_text("v")).alias("value")
        df.select(line).write.mode(mode).text(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_numbers(df: DataFrame, path: str, col: str = "value", mode: str = "errorifexists") -> None:
    """Write a number column as text, one number per line (``read_numbers`` reads it back)."""
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)


def write_scored_points(points: DataFrame, score: DataFrame, path: str, fmt: str = "text", mode: str = "errorifexists") -> None:
    """Write a selection and its score together: ``path/score`` (one row, e.g.
    ``k, avg_dist``) and ``path/points`` (as :func:`write_points`)."""
    base = path.rstrip("/")
    if fmt == "text":
        line = F.concat_ws(",", *[F.col(c).cast("string") for c in score.columns]).alias("value")
        score.select(line).coalesce(1).write.mode(mode).text(f"{base}/score")
    else:
        getattr(score.coalesce(1).write.mode(mode), fmt)(f"{base}/score")
    write_points(points, f"{base}/points", fmt=fmt, mode=mode)
