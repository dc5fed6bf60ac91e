"""Vector expressions over ``array<double>`` columns.

Distances are built-in higher-order functions (``zip_with`` + ``aggregate``), so
they run inside the JVM without a Python round trip.  The sum runs left to
right over the dimensions; the DuckDB oracle sums in the same order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_vector(c: Column | str) -> Column:
    """Cast any numeric array (e.g. ``array<float>``) element by element to ``array<double>``."""
    return _c(c).cast("array<double>")


def sqdist_sql_expr(a: str, b: str) -> str:
    """Squared distance as Spark SQL text over two SQL expressions (e.g. a lambda field) of equal length."""
    return f"aggregate(zip_with({a}, {b}, (x_, y_) -> (x_ - y_) * (x_ - y_)), 0D, (acc_, d_) -> acc_ + d_)"


def sqdist(a: str, b: str) -> Column:
    """Squared Euclidean distance of two vector columns; different lengths fail the job."""
    same = F.expr(f"size(`{a}`) = size(`{b}`)")
    return F.when(same, F.expr(sqdist_sql_expr(f"`{a}`", f"`{b}`"))).otherwise(F.raise_error(F.lit("vectors of different lengths")))


def l2dist(a: str, b: str) -> Column:
    """Euclidean distance."""
    return F.sqrt(sqdist(a, b))


def norm2(a: Column | str) -> Column:
    """Squared norm."""
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x * x)


def require_finite(df: DataFrame, col: str = "v") -> DataFrame:
    """Fail the job on a vector with a NaN or infinite coordinate (or a NULL or empty vector).

    A NaN distance would win every farthest-point comparison in Spark's
    ordering, so such points are refused at the source.  The check is a
    filter that keeps every row and raises on a bad one; it runs inside the
    scan's task, no extra pass.
    """
    # Spark orders NaN above +inf, so the largest coordinate tells NaN and
    # +inf apart from finite values, and the smallest tells -inf; both are
    # plain array expressions (no lambda).
    hi, lo = F.array_max(F.col(col)), F.array_min(F.col(col))
    ok = ~F.isnan(hi) & (hi < F.lit(float("inf"))) & (lo > F.lit(float("-inf")))
    return df.where(ok | F.raise_error(F.lit(f"non-finite or missing vector in column {col}")))
