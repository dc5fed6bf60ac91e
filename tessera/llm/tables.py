"""Intermediate tables in the shared folder, and joins with a measured side."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import partial
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

import tessera
from tessera.session import scratch_path

#: Rows of a few dozen bytes each that a side may hold to be broadcast (about 32 MB).
BROADCAST_ROWS = 500_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if ``df`` was counted to be small; else a plain (shuffled) join side."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


_shipped: set[str] = set()
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch sent to a worker, unless the application says otherwise: its vectors lie outside the heap,
#: twice a task, and their allocator keeps what it had.
BATCH_BYTES = 4 << 20
#: Bytes of a row group of a written table: what a writer of whole texts holds in the heap.
ROW_GROUP_BYTES = 16 << 20


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (as ``--py-files`` would), in batches of bounded size."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    if not spark.sparkContext.getConf().contains(_BATCH):  # stays set: workers of later queries need it too
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    package = Path(tessera.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tessera-py-")) / "tessera.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def arrow_map(df: DataFrame, fn: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with the package at hand in the workers, which give their memory back after a task."""
    ship(df.sparkSession)
    return df.mapInArrow(partial(_and_release, fn=fn), schema)


def _and_release(batches: Iterator[pa.RecordBatch], fn: Callable) -> Iterator[pa.RecordBatch]:
    """A worker lives on between tasks beside the executor's heap; freed arrays would stay with its allocator."""
    yield from fn(batches)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def schema_after(df: DataFrame, first: str, rest: str) -> StructType:
    """Column ``first`` of ``df`` (of any type, a struct of a whole row too), then the columns of a DDL string."""
    return StructType([StructField(first, df.schema[first].dataType), *StructType.fromDDL(rest).fields])
