"""Adapters from the parquet tables to the engine's three data shapes.

* numbers: ``value double`` (plus whatever key columns the caller keeps)
* lines:   ``doc_id bigint, line_no int, line string``
* points:  ``id bigint, v array<double>``

Each adapter is a projection, so Catalyst prunes the parquet scan to the
columns used and pushes any later filter into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import split_lines
from tessera.functions.vectors import require_finite, to_vector


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; the file source deals its row groups to tasks."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbers_from_values(spark: SparkSession, values, num_partitions: int | None = None) -> DataFrame:
    """A number set from values held by the driver (small inputs and tests)."""
    df = spark.createDataFrame([(float(v),) for v in values], "value double")
    return df.repartition(num_partitions) if num_partitions else df


def numbers_from(df: DataFrame, col: str, *keep: str) -> DataFrame:
    """A number set from one numeric column, cast to double."""
    return df.select(*keep, F.col(col).cast("double").alias("value"))


def lines_from(df: DataFrame, text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """Documents to lines: one row per line of each text, numbered from 0.

    ``posexplode`` is a per-row generator, so no shuffle is involved and every
    line stays in the task that read its document.
    """
    return df.select(
        F.col(doc_col).cast("bigint").alias("doc_id"),
        F.posexplode(split_lines(text_col)).alias("line_no", "line"),
    )


def points_from(
    df: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", check_finite: bool = True
) -> DataFrame:
    """A point set: the id and the vector cast element by element to double.
    Non-finite coordinates fail the job (see :func:`require_finite`)."""
    pts = df.select(F.col(id_col).cast("bigint").alias("id"), to_vector(vec_col).alias("v"))
    return require_finite(pts) if check_finite else pts
