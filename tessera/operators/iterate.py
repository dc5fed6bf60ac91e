"""Frames kept between the passes of a greedy selection, and their release.

The state of a pass is a function of the points and the choices so far; it is
persisted, and a lost block is rebuilt from the points.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def hold(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


_ADAPTIVE = "spark.sql.adaptive.enabled"


def hold_partitioned(df: DataFrame) -> DataFrame:
    """Persist ``df`` with the partitioning that its plan has now: later joins on the same key need no exchange.

    Adaptive execution stays out of this one plan (the setting is put back at
    once), which also keeps the plans of a chain of persisted frames linear in
    its length: an adaptive plan shows its frames twice.
    """
    conf = df.sparkSession.conf
    before = conf.get(_ADAPTIVE)
    conf.set(_ADAPTIVE, "false")
    try:
        return hold(df)
    finally:
        conf.set(_ADAPTIVE, before)


def drop(*dfs: DataFrame | None) -> None:
    for df in dfs:
        if df is not None:
            df.unpersist()
