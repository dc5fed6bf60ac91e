"""MinHash near-duplicates with an LSH forest over word shingles.

1. *Sketch* (one pass over the texts): the set of distinct 5-word shingles of
   every document as 64-bit hashes, its size, a 128-bit digest of the set and
   64 MinHash values.  Documents with equal sets collapse to one node.
2. *Forest*: 16 sorted orders of the signature, the order ``t`` starting at
   position ``4 t``.  A region is a run of nodes that share the first four
   values of an order.  In a small region every two nodes are candidates; in a
   dense one the depth adapts: candidates are a node's neighbours in the
   sorted order (the longest common prefixes there) and the region's centre.
3. *Confirmation* on the full shingle sets, then components.
4. *Rest of the dense regions*: a region whose nodes still lie in two or more
   components is compared completely, in blocks of bounded bytes, by exact
   intersection counts; a component larger than a block is not compared with
   itself, and a block pair returns only links that join components, so
   neither pairs of a group are rows nor is a link between components lost.

The chance that two documents at similarity 0.85 share no region is
``(1 - 0.85^4)^16``, 7e-6, and less above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.tables import arrow_map, small_side, written
from tessera.llm.words import constants, mix64, slices, span_hashes, spans

SHINGLE = 5
N_HASHES = 64
DEPTH = 4
TREES = N_HASHES // DEPTH
#: Largest region of which all pairs are candidates.
SMALL_REGION = 12
#: Least equal MinHash values of a candidate: five standard deviations under the mean at 0.85.
MIN_AGREE = 40
#: Bytes of shingle sets in a block of a dense region.
BLOCK_BYTES = 1 << 20

_POSITION = constants(7, SHINGLE)
_SHORT = constants(17, SHINGLE)
_XOR = constants(13, N_HASHES)
_MUL = constants(11, N_HASHES)


def _shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, concatenated, and their bounds."""
    starts, ends, n_words = spans(data, offsets)
    h = span_hashes(data, starts, ends, lower=True)
    cut = np.concatenate([[0], np.cumsum(n_words)])
    with np.errstate(over="ignore"):
        if len(h) >= SHINGLE:
            n = len(h) - SHINGLE + 1
            full = mix64(sum(h[j : j + n] * _POSITION[j] for j in range(SHINGLE)))
        parts: list[np.ndarray] = []
        sizes = np.zeros(len(n_words), np.int64)
        for i, k in enumerate(n_words):
            a = cut[i]
            if k == 0:
                continue
            if k < SHINGLE:
                s = mix64((h[a : a + k] * _POSITION[:k]).sum(dtype=np.uint64, keepdims=True) ^ _SHORT[k])
            else:
                s = np.sort(full[a : a + k - SHINGLE + 1])
                s = s[np.concatenate([[True], s[1:] != s[:-1]])]
            parts.append(s)
            sizes[i] = len(s)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def _digests(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return (
            np.add.reduceat(mix64(sets ^ np.uint64(0xA5A5A5A55A5A5A5A)), first).view(np.int64),
            np.add.reduceat(mix64(sets + np.uint64(0x1234567887654321)), first).view(np.int64),
        )


def _signatures(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.empty((len(first), N_HASHES), np.uint32)
    bounds = np.append(first, len(sets))
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(first):  # a few hundred thousand shingles at a time stay in cache
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + 100_000, side="right")) - 1)
            hi = min(hi, len(first))
            part, f = sets[bounds[lo] : bounds[hi]], first[lo:hi] - first[lo]
            for k in range(N_HASHES):
                out[lo:hi, k] = np.minimum.reduceat((part ^ _XOR[k]) * _MUL[k], f) >> np.uint64(32)
            lo = hi
    return out


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, data, offsets in slices(batch.column(1)):
            sets, cut = _shingle_sets(data, offsets)
            sizes = np.diff(cut)
            has = np.flatnonzero(sizes)
            d1, d2 = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
            sig: list[bytes | None] = [None] * (hi - lo)
            if len(has):
                first = cut[:-1][has]
                d1[has], d2[has] = _digests(sets, first)
                for i, s in zip(has, _signatures(sets, first)):
                    sig[i] = s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(sizes), pa.array(d1), pa.array(d2), pa.array(sig, pa.binary())],
                ["doc_id", "n", "d1", "d2", "sig"],
            )


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, offsets in slices(batch.column(0)):
            sets, cut = _shingle_sets(data, offsets)
            has = np.flatnonzero(np.diff(cut))
            if not len(has):
                continue
            d1, d2 = _digests(sets, cut[:-1][has])
            rows = [sets[cut[i] : cut[i + 1]].tobytes() for i in has]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.diff(cut)[has]), pa.array(d1), pa.array(d2), pa.array(rows, pa.binary())], ["n", "d1", "d2", "shingles"]
            )


def _agree(sigs: np.ndarray) -> np.ndarray:
    return (sigs[:, None, :] == sigs[None, :, :]).sum(2)


def _near_sizes(a, b):
    """Sizes that allow 100 * intersection >= 85 * union."""
    return 100 * np.minimum(a, b) >= 85 * np.maximum(a, b)


def _small_region_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of a region whose sizes and signatures allow a link, in the first order they share."""
    for batch in batches:
        a_out, b_out = [], []
        for tree, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            nodes = np.array([m["node"] for m in members])
            n = np.array([m["n"] for m in members])
            sigs = np.frombuffer(b"".join(m["sig"] for m in members), np.uint32).reshape(len(members), N_HASHES)
            equal = sigs[:, None, :] == sigs[None, :, :]
            earlier = equal[:, :, : tree * DEPTH].reshape(len(n), len(n), tree, DEPTH).all(3).any(2)
            ok = (equal.sum(2) >= MIN_AGREE) & _near_sizes(n[:, None], n[None, :]) & ~earlier
            i, j = np.nonzero(np.triu(ok, 1))
            a_out.append(np.minimum(nodes[i], nodes[j]))
            b_out.append(np.maximum(nodes[i], nodes[j]))
        if a_out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], ["a", "b"])


def _neighbour_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of one sorted order and region."""
    last = None
    for batch in batches:
        t, node, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        sigs = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint32).reshape(len(t), N_HASHES)
        if last is not None:
            t, node, n = (np.concatenate([x, y]) for x, y in zip(last[:3], (t, node, n)))
            sigs = np.concatenate([last[3], sigs])
        last = (t[-1:], node[-1:], n[-1:], sigs[-1:])
        ok = (t[1:] == t[:-1]) & _near_sizes(n[1:], n[:-1]) & ((sigs[1:] == sigs[:-1]).sum(1) >= MIN_AGREE)
        i = np.flatnonzero(ok)
        a, b = node[i], node[i + 1]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, left, right = (batch.column(i) for i in range(4))
        keep = np.zeros(len(a), bool)
        for i in range(len(a)):
            x, y = np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * both >= 85 * (len(x) + len(y) - both)
        yield pa.RecordBatch.from_arrays([a.filter(pa.array(keep)), b.filter(pa.array(keep))], ["a", "b"])


def _block(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
    sizes = np.array([len(s) for s in sets])
    return np.array([r["node"] for r in rows]), np.array([r["component"] for r in rows]), sizes, np.concatenate(sets)


def _intersections(x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of every set of one block with every set of the other."""
    common = np.intersect1d(x, y)
    out = np.zeros((len(nx), len(ny)), np.float32)
    of_x, of_y = np.repeat(np.arange(len(nx)), nx), np.repeat(np.arange(len(ny)), ny)
    at_x, at_y = np.searchsorted(common, x), np.searchsorted(common, y)
    in_x = (at_x < len(common)) & (np.take(common, at_x, mode="clip") == x) if len(common) else np.zeros(len(x), bool)
    in_y = (at_y < len(common)) & (np.take(common, at_y, mode="clip") == y) if len(common) else np.zeros(len(y), bool)
    for lo in range(0, len(common), 4096):
        sx, sy = in_x & (at_x >= lo) & (at_x < lo + 4096), in_y & (at_y >= lo) & (at_y < lo + 4096)
        m, k = np.zeros((len(nx), 4096), np.float32), np.zeros((len(ny), 4096), np.float32)
        m[of_x[sx], at_x[sx] - lo] = 1
        k[of_y[sy], at_y[sy] - lo] = 1
        out += m @ k.T
    return out


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components that links of two blocks join, without those joined before in this block pair."""
    for batch in batches:
        a_out, b_out = [], []
        for r in range(batch.num_rows):
            x, y = _block(batch.column(0)[r].as_py()), _block(batch.column(1)[r].as_py())
            if len(np.union1d(x[1], y[1])) < 2:
                continue
            both = _intersections(x[3], x[2], y[3], y[2])
            linked = 100 * both >= 85 * (x[2][:, None] + y[2][None, :] - both)
            linked &= x[1][:, None] != y[1][None, :]
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while parent.get(c, c) != c:
                    c = parent[c]
                return c

            for i, j in zip(*np.nonzero(linked)):
                p, q = root(int(x[1][i])), root(int(y[1][j]))
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    a_out.append(p)
                    b_out.append(q)
        yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, node, sig`` per document; equal sets have equal ``node`` (null without words)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    raw = arrow_map(texts, _sketch_batches, "doc_id long, n long, d1 long, d2 long, sig binary")
    return raw.select("doc_id", "n", F.when(F.col("n") > 0, F.xxhash64("n", "d1", "d2")).alias("node"), "sig")


def _order(tree: int) -> F.Column:
    """The signature rotated to start at position ``4 * tree``, as comparable bytes."""
    at = tree * DEPTH * 4
    return F.concat(F.substring("sig", at + 1, N_HASHES * 4 - at), F.substring("sig", 1, at)) if at else F.col("sig")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Links are 100 * intersection >= 85 * union of the sets of distinct
    ``SHINGLE``-word shingles (A-Z lower-cased); a shorter text is one shingle
    of all its words.  Null or wordless texts have no shingle and stay alone.
    ``component_id`` is the smallest non-null id reachable (null if there is
    none), ``kept`` is ``doc_id = component_id`` (false for a null id).
    Repeated rows are rows of the same component; other columns are not read.
    """
    sketch = written(sketches(docs, id_col, text_col), "sketch")
    nodes = written(
        sketch.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "nodes",
    )

    keys = F.array(*[F.xxhash64(F.lit(t), F.substring("sig", t * DEPTH * 4 + 1, DEPTH * 4)) for t in range(TREES)])
    placed = nodes.select("node", F.posexplode(keys).alias("tree", "key"))
    regions = placed.groupBy("tree", "key").agg(F.count("*").alias("c"), F.min("node").alias("centre")).where("c > 1")
    members = written(placed.join(regions, ["tree", "key"]), "members")

    small = arrow_map(
        members.where(F.col("c") <= SMALL_REGION)
        .join(nodes.select("node", "n", "sig"), "node")
        .groupBy("tree", "key")
        .agg(F.collect_list(F.struct("node", "n", "sig")).alias("rows"))
        .select("tree", "rows"),
        _small_region_pairs,
        "a long, b long",
    )
    dense = members.where(F.col("c") > SMALL_REGION)
    signed = dense.join(nodes.select("node", "n", "sig"), "node")
    order = F.coalesce(*[F.when(F.col("tree") == t, _order(t)) for t in range(TREES)])
    neighbours = arrow_map(
        signed.select(F.xxhash64("tree", "key").alias("region"), "node", "n", "sig", "tree", order.alias("prefix"))
        .repartitionByRange("tree", "prefix")
        .sortWithinPartitions("tree", "prefix", "node")
        .select("region", "node", "n", "sig"),
        _neighbour_pairs,
        "a long, b long",
    )
    centre = dense.where("node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    pairs = written(small.unionByName(neighbours).unionByName(centre).distinct(), "pairs")

    # full sets of every node that is in a pair or a dense region
    wanted = written(
        pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(dense.select("node")).distinct(),
        "wanted",
    )
    ids = nodes.join(wanted, "node").select(F.col("doc_id").alias("wanted_id")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(small_side(ids, wanted.count()), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    found = arrow_map(texts, _set_batches, "n long, d1 long, d2 long, shingles binary")
    sets = written(
        found.select(F.xxhash64("n", "d1", "d2").alias("node"), "shingles")
        .join(wanted, "node", "left_semi")
        .groupBy("node")
        .agg(F.first("shingles").alias("shingles")),
        "sets",
    )
    lengths = nodes.select("node", "n")
    near = (
        pairs.join(lengths.toDF("a", "na"), "a")
        .join(lengths.toDF("b", "nb"), "b")
        .where("100 * least(na, nb) >= 85 * greatest(na, nb)")
        .select("a", "b")
    )
    both = near.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b").select("a", "b", "left", "right")
    links = written(arrow_map(both, _confirm, "a long, b long"), "links")
    label = components(links)

    # dense regions that still hold several components: complete, in blocks
    split = dense.join(label, "node", "left").select("tree", "key", "node", F.coalesce("component", "node").alias("component"))
    held = written(split.join(lengths, "node"), "regions")
    shares = written(
        held.groupBy("tree", "key", "component").agg(
            F.sum(8 * F.col("n")).alias("bytes"), F.count("*").alias("c"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("same")
        ),
        "shares",
    )
    # one comparison per set of nodes: a region that another order repeats is left out
    whole = shares.groupBy("tree", "key").agg(F.count("*").alias("components"), *[F.sum(x).alias(x) for x in ("bytes", "c", "same")])
    once = whole.where("components > 1").groupBy("c", "bytes", "same").agg(F.min(F.struct("tree", "key")).alias("r")).select("r.tree", "r.key")
    # a component of more than a block has blocks of its own, which are not compared with each other
    parts = shares.join(once, ["tree", "key"]).select("tree", "key", "component", "bytes")
    parts = written(parts.withColumn("own", F.when(F.col("bytes") >= BLOCK_BYTES, F.col("component"))), "parts")
    total = parts.groupBy("tree", "key", "own").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).alias("blocks"))
    placed_parts = (
        parts.select("tree", "key", "component", "own")
        .join(total.withColumnRenamed("own", "of"), ["tree", "key"])
        .where(F.col("own").eqNullSafe(F.col("of")))
        .select("tree", "key", "component", "own", "blocks")
    )
    blocked = (
        held.select("tree", "key", "node", "component")
        .join(placed_parts, ["tree", "key", "component"])
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")))
        .join(sets, "node")
        .groupBy("tree", "key", "own", "block")
        .agg(F.collect_list(F.struct("node", "component", "shingles")).alias("rows"))
        .withColumn("place", F.xxhash64("own", "block"))
    )
    blocked = written(blocked.select("tree", "key", "own", "place", "rows"), "blocks")
    left, right = blocked.toDF("tree", "key", "own_x", "i", "x"), blocked.toDF("tree", "key", "own_y", "j", "y")
    met = left.join(right, ["tree", "key"]).where("i <= j AND (own_x IS NULL OR own_y IS NULL OR own_x <> own_y)")
    rest = arrow_map(met.select("x", "y"), _block_links, "a long, b long")
    more = written(rest, "more-links")
    of_node = nodes.select("node", "doc_id").join(label, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    if more.limit(1).count():  # between whole components
        joined = components(more).toDF("component", "into")
        of_node = of_node.join(joined, "component", "left").select("node", "doc_id", F.coalesce("into", "component").alias("component"))

    least = of_node.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = of_node.join(least, "component").select("node", "component_id")
    out = sketch.select("doc_id", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )
