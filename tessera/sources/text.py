"""Text-file scans: numbers, lines and points.

All three are ``spark.read.text`` followed by column expressions, so a large
file is split across tasks by the file source like any other scan.

Lines and points are numbered in two levels.  A split of a file knows its
file and first byte; its rows are counted in one pass, the splits' first numbers
are a running sum over those few counts (in order of path and byte), and a
row's number is that of its split plus its place inside.  So numbers are
dense, do not depend on how the files were split, and no task sees all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.vectors import require_finite
from tessera.operators.vectors import broadcast_if_small
from tessera.session import scratch_path


def read_numbers(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """White-space separated doubles, any number per line.

    ``mode="strict"`` fails on a token that is not a number (ANSI cast);
    ``mode="permissive"`` drops such tokens.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError("mode must be 'strict' or 'permissive'")
    tokens = spark.read.text(path).select(F.explode(F.split(F.col("value"), r"\s+")).alias("tok"))
    tokens = tokens.where(F.col("tok") != "")
    if mode == "strict":
        return tokens.select(F.col("tok").cast("double").alias("value"))
    return tokens.select(F.expr("try_cast(tok AS double)").alias("value")).where(F.col("value").isNotNull())


def _numbered(raw: DataFrame, number: str) -> DataFrame:
    """``raw`` (a filtered text scan) with ``number``: 0, 1, ... over its rows by path, first byte of the split, place."""
    spark = raw.sparkSession
    split = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at")]
    rows = raw.select("*", *split, F.monotonically_increasing_id().alias("_row"))
    # a split lies in one task, and its rows come one after the other there
    counts = rows.groupBy("_file", "_at").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    path = scratch_path(spark, "splits")
    counts.write.parquet(path)  # a row per split; the text is read twice in all
    counts = spark.read.schema(counts.schema).parquet(path)
    before = F.sum("_n").over(Window.orderBy("_file", "_at").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("_file", "_at", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    met = rows.join(broadcast_if_small(first, counts.count(), 32), ["_file", "_at"])
    return met.withColumn(number, F.col("_row") + F.col("_shift")).drop("_file", "_at", "_row", "_shift")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Each text line is one document line.

    ``doc_id`` identifies the file (hash of its path).  ``line_no`` numbers the
    lines of all files read from 0, by path and place in the file.
    """
    raw = spark.read.text(path).select(F.xxhash64(F.input_file_name()).alias("doc_id"), F.col("value").alias("line"), "_metadata")
    return _numbered(raw, "line_no").select("doc_id", "line_no", "line")


def read_points(
    spark: SparkSession, path: str, sep: str = r"[,\s]+", with_id: bool = False, check_finite: bool = True
) -> DataFrame:
    """One vector per text line, coordinates separated by ``sep`` (a regex).

    With ``with_id=True`` the first field of each line is the point id;
    otherwise ids number the non-blank lines of all files from 0, by path and place in the file.
    """
    raw = spark.read.text(path).select(F.trim(F.col("value")).alias("line"), "_metadata").where(F.col("line") != "")
    fields = F.split(F.col("line"), sep)
    if with_id:
        pts = raw.select(
            F.element_at(fields, 1).cast("bigint").alias("id"),
            F.transform(F.slice(fields, 2, F.size(fields) - 1), lambda x: x.cast("double")).alias("v"),
        )
    else:
        pts = _numbered(raw, "id").select("id", F.transform(fields, lambda x: x.cast("double")).alias("v"))
    return require_finite(pts) if check_finite else pts
