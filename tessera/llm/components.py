"""Connected components of a link table: smallest label by joins, with pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import arrow_map, written

#: Links that a task holds at a time while it shortens them.
HELD_LINKS = 1 << 20


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as the given ones: every node but the least of its component, and that least node."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        p, q = label[x], label[y]
        apart = p != q
        if not apart.any():
            break
        x, y, p, q = x[apart], y[apart], p[apart], q[apart]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while (label != label[label]).any():
            label = label[label]
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _star_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of the stars of a task's links, ``HELD_LINKS`` at a time."""

    def out() -> pa.RecordBatch:
        a, b = _stars(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))], ["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        n += batch.num_rows
        if n >= HELD_LINKS:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def components(links: DataFrame) -> DataFrame:
    """``(a long, b long)`` -> ``(node, component)`` with the smallest node as component.

    Only nodes that have a link appear.  Every task first puts the stars of its
    own links in their place, which join the same nodes with fewer links and
    shorter ways.  Each round takes the smallest label among the neighbours and
    then the label of that label, so long chains halve; a round is one
    aggregate and a table in the shared folder, and only a count of changed
    rows reaches the driver.  A node with very many links is pre-aggregated by
    the partial ``min``.
    """
    both = written(arrow_map(links.where("a <> b").select("a", "b"), _star_batches, "a long, b long"), "links")
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "labels")
    while True:
        own = label.select("node", "component", F.col("component").alias("old"))
        near = both.join(label.select(F.col("node").alias("b"), "component"), "b").select(F.col("a").alias("node"), "component", F.lit(None).cast("long").alias("old"))
        stepped = near.unionByName(own).groupBy("node").agg(F.min("component").alias("s"), F.max("old").alias("old"))
        jumped = stepped.join(label.select(F.col("node").alias("s"), F.col("component").alias("j")), "s").select(
            "node", F.least("s", "j").alias("component"), (F.least("s", "j") < F.col("old")).alias("moved")
        )
        now = written(jumped, "labels")
        label = now.select("node", "component")
        if now.where("moved").limit(1).count() == 0:
            return label
