"""Statistics over a number set ``DataFrame[value double, ...]``.

All of them are single-pass aggregates with a map-side partial step, so the
shuffle carries one partial row per task (or per residue) whatever the size of
the input.  Deviation from the mean uses a scalar subquery: the mean is
computed once and enters the projection as a literal, with no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary(df: DataFrame, col: str = "value") -> DataFrame:
    """Count, sum, arithmetic mean and population variance, one row.

    ``var_pop`` is Spark's stable (Welford-style) estimator; ``var_moments`` is
    E[X²] − E[X]², the textbook form, which loses precision on large means.
    An empty input gives one row with ``n = 0`` and NULL elsewhere.
    """
    x = F.col(col)
    return df.agg(
        F.count(x).alias("n"),
        F.sum(x).alias("total"),
        F.avg(x).alias("mean"),
        F.var_pop(x).alias("var_pop"),
        (F.avg(x * x) - F.pow(F.avg(x), 2)).alias("var_moments"),
    )


def population_variance(df: DataFrame, col: str = "value") -> DataFrame:
    """Population variance by both routes, one row."""
    x = F.col(col)
    return df.agg(F.var_pop(x).alias("var_pop"), (F.avg(x * x) - F.pow(F.avg(x), 2)).alias("var_moments"))


def mean_of(df: DataFrame, col: str = "value"):
    """The mean as a scalar-subquery column (evaluated once per query)."""
    return df.select(F.avg(F.col(col))).scalar()


def abs_deviation(df: DataFrame, col: str = "value", *keep: str) -> DataFrame:
    """``|x − mean(x)|`` for every row, with the ``keep`` columns alongside."""
    return df.select(*keep, F.abs(F.col(col) - mean_of(df, col)).alias("abs_dev"))


def min_abs_deviation(df: DataFrame, col: str = "value") -> DataFrame:
    """Smallest deviation from the mean, by aggregation."""
    return abs_deviation(df, col).agg(F.min("abs_dev").alias("min_dev"))


def min_abs_deviation_sorted(df: DataFrame, col: str = "value") -> DataFrame:
    """Smallest deviation from the mean by a second route: ascending order, first row.

    Plans as ``TakeOrderedAndProject``: every task keeps its own best row, so
    nothing is sorted globally.  It must equal :func:`min_abs_deviation`.
    """
    return abs_deviation(df, col).orderBy(F.col("abs_dev").asc()).limit(1).select(F.col("abs_dev").alias("min_dev"))


def residue_sums(df: DataFrame, col: str = "value") -> DataFrame:
    """Sum and count of the values grouped by ``x % 2``.

    The remainder keeps the sign of the dividend and the fraction (−3 → −1,
    1.5 → 1.5).  Residue 0 is labelled ``even``, every other residue ``odd``.
    ``+ 0.0`` turns a −0.0 key into 0.0.  There are at most a handful of
    residue groups, and the partial aggregate folds each task's rows into
    one row per residue before the shuffle, so a residue holding most rows
    costs nothing extra.
    """
    residue = (F.col(col) % F.lit(2.0)) + F.lit(0.0)
    grouped = df.groupBy(residue.alias("residue")).agg(F.sum(F.col(col)).alias("total"), F.count(F.col(col)).alias("n"))
    return grouped.select(
        "residue",
        F.when(F.col("residue") == 0, F.lit("even")).otherwise(F.lit("odd")).alias("label"),
        "total",
        "n",
    )
