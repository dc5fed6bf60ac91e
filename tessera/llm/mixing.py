"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks.

Every source's documents are laid end to end in a shuffled (hash) order, the
source repeats up to ``REPEATS`` times, and this stream is cut into blocks of
``BLOCK`` words up to the source's target.  The mix is a sequence of slots,
one block each: slot ``i`` is the golden-ratio point ``frac((i + 1/2) phi)``
mapped through the cumulative targets, so every source is spread evenly over
the whole sequence; the ``r``-th slot of a source takes its block ``r``.  The
points give a source its share up to a few slots; slots beyond its blocks are
left out and missing ones follow at the end, so the words taken are the target.

Running numbers (place of a document in its source, rank of a slot within its
source) are made in two levels: sums per (source, chunk), offsets over those
sums, and a window inside a chunk of bounded size; a source with a third of
all rows is many chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.tables import small_side, written

#: Words in a block.
BLOCK = 512
#: Weights of the sources by code point, repeating.
WEIGHTS = (1, 2, 3)
#: A source gives at most this many times its own words.
REPEATS = 3
#: Documents in a chunk of a source's running sum, on average.
CHUNK_ROWS = 20_000
#: Slots in a chunk.
CHUNK_SLOTS = 1 << 18
#: Cells of the unit interval by which points find their source.
GRID = 1 << 12

WORD = r"[^\x20\x09-\x0D]+"
_PHI = 0.6180339887498949
_PHI_20 = 0.607787409740351  # frac(2^20 * phi): points of high numbers keep their digits


def word_count(text: Column) -> Column:
    """Number of words of a text (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def golden_point(i: Column) -> Column:
    """``frac((i + 1/2) * phi)``."""
    high = (F.shiftright(i, 20).cast("double") * F.lit(_PHI_20)) % 1.0
    low = (i.bitwiseAND(F.lit((1 << 20) - 1)).cast("double") + 0.5) * F.lit(_PHI)
    return (high + low) % 1.0


def positions(df: DataFrame, order: str) -> DataFrame:
    """Numbers rows 0, 1, ... by ``order`` (nulls last) as ``pos``, without bringing them into one task."""
    by = F.col(order).asc_nulls_last()
    ranged = df.repartitionByRange(by).sortWithinPartitions(by).withColumn("_at", F.monotonically_increasing_id())
    ranged = written(ranged.withColumn("_part", F.shiftright("_at", 33)), "ranged")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(before, "_part").withColumn("pos", F.col("_before") + inside).drop("_part", "_before", "_at")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``s, source, source_size, target`` of a ``source, source_size`` table; ``s`` numbers the sources.

    Sources share the total by weight; one above ``repeats`` times its size
    stops there and the excess is reshared by weight until none is above.
    Only sums reach the driver.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("s") % len(weights) + 1).cast("int"))
    table = positions(sizes, "source").withColumnRenamed("pos", "s").withColumn("weight", weight)
    table = written(table.withColumn("most", (repeats * F.col("source_size")).cast("double")), "sources")
    per_weight, stopped = 0.0, -1
    while True:  # the share of a weight only rises when sources stop, so each round stops more or is the last
        full = F.col("most") <= per_weight * F.col("weight")
        total, held, rest, n = table.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("most")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.count_if(full)
        ).first()
        if n == stopped or not rest or not total:
            break
        per_weight, stopped = (total - held) / rest, n
    return table.select("s", "source", "source_size", F.least("most", F.lit(per_weight) * F.col("weight")).alias("target"))


def running(df: DataFrame, order: list[str], value: str, name: str, by: str = "s") -> DataFrame:
    """Sum of ``value`` over the earlier rows of the same ``by`` by ``chunk`` and ``order``."""
    sums = df.groupBy(by, "chunk").agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(by, "chunk", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_before"))
    w = Window.partitionBy(by, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.withColumn("_inside", F.coalesce(F.sum(value).over(w), F.lit(0)))
    return inside.join(offsets, [by, "chunk"]).withColumn(name, F.col("_before") + F.col("_inside")).drop("_before", "_inside", "chunk")


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``slot, s, r, words`` of a ``s, target`` table: slot takes ``words`` words, block ``r`` of source ``s``.

    Slots are in mixing order.  Sources without words have none.
    """
    spark = targets.sparkSession
    goal = F.floor(F.col("target") + 0.5)
    t = targets.where(goal > 0).select("s", "target", goal.alias("goal"), F.ceil(goal / F.lit(block)).alias("blocks"))
    t = t.withColumn("all", F.lit(0)).withColumn("chunk", F.floor(F.col("s") / CHUNK_ROWS))  # sources may be many, too
    spans = written(running(t, ["s"], "target", "since", "all").withColumn("upto", F.col("since") + F.col("target")).drop("all"), "spans")
    total, last, n = spans.agg(F.max("upto"), F.max("s"), F.ceil(F.sum("target") / block)).first()
    n = int(n or 0)
    lo = F.col("since") / F.lit(total or 1.0)
    hi = F.when(F.col("s") == F.lit(-1 if last is None else last), 1.0).otherwise(F.col("upto") / F.lit(total or 1.0))
    cell = F.sequence(F.floor(F.col("lo") * GRID), F.least(F.floor(F.col("hi") * GRID), F.lit(GRID - 1)))
    cells = written(spans.select("s", "blocks", lo.alias("lo"), hi.alias("hi")).select("s", "blocks", "lo", "hi", F.explode(cell).alias("cell")), "cells")

    slots = spark.range(0, n, 1, max(1, -(-n // CHUNK_SLOTS))).select(F.col("id").alias("slot"), golden_point(F.col("id")).alias("u"))
    drawn = (
        slots.withColumn("cell", F.floor(F.col("u") * GRID))
        .join(small_side(cells), "cell")
        .where("u >= lo and u < hi")
        .select("s", "slot", "blocks", F.floor(F.col("slot") / CHUNK_SLOTS).alias("chunk"), F.lit(1).cast("long").alias("one"))
    )
    ranked = running(drawn, ["slot"], "one", "r").where("r < blocks").select("slot", "s", "r")
    taken = written(ranked, "slots")
    counts = taken.groupBy("s").agg(F.count("*").alias("n"))
    missing = spans.join(counts, "s", "left").select("s", "blocks", F.coalesce("n", F.lit(0)).alias("n")).where("n < blocks")
    more = missing.select("s", F.explode(F.sequence("n", F.col("blocks") - 1)).alias("r")).select((F.lit(n) + F.col("r")).alias("slot"), "s", "r")
    words = F.least(F.lit(block), F.col("goal") - F.col("r") * block)
    return taken.unionByName(more).join(small_side(spans.select("s", "goal")), "s").select("slot", "s", "r", words.cast("long").alias("words"))


def placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The documents with their place in their source's shuffled stream, and the targets."""
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col).cast("string")).alias("size")
    )
    sized = sized.withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "size")).withColumn("row", F.monotonically_increasing_id())
    sized = written(sized, "sized")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes), "targets")
    chunks = max(1, sized.count() // CHUNK_ROWS)
    # orders are spread evenly over the 64-bit numbers, so equal ranges hold about equally many documents
    chunk = F.floor((F.col("order").cast("double") / float(1 << 64) + 0.5) * chunks)
    named = small_side(targets.select(F.col("source").alias("name"), "s", "source_size", "target"))
    known = sized.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    return running(known.withColumn("chunk", chunk), ["order", "row"], "size", "start"), targets


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, block: int = BLOCK
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, first_slot, n_slots`` per row of ``docs``.

    ``taken`` counts the words that the mix takes from the document, repeats
    included: at most ``REPEATS`` times its size.  ``first_slot`` is the first
    slot of the schedule with words of the document (null if none is taken)
    and ``n_slots`` the number of such slots.  Null texts have size 0 and
    are not taken; a null source is a source, the last one.  Repeated rows are
    rows of their own; other columns are not read.  The same rows give the
    same mix.
    """
    at, targets = placed(docs, id_col, text_col, source_col, seed)
    at = written(at, "placed")
    slots = schedule(targets, block)
    # every pass of a source over its documents, as far as the target goes, by the blocks it lies in
    goal = F.floor(F.col("target") + 0.5)
    passes = at.where("size > 0").select(
        "row", "s", "start", "size", F.explode(F.transform(F.sequence(F.lit(0), F.lit(REPEATS - 1)), lambda p: p * F.col("source_size") + F.col("start"))).alias("begin"), goal.alias("goal")
    )
    passes = passes.where("begin < goal").withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("goal")))
    pieces = passes.select(
        "row", "s", "begin", "end", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))).alias("r")
    )
    overlap = F.least(F.col("end"), F.col("r") * block + F.col("words")) - F.greatest(F.col("begin"), F.col("r") * block)
    # a document has pieces of few blocks; two passes of a short source may meet in one block, and so in one slot
    met = pieces.join(slots, ["s", "r"]).groupBy("row", "slot").agg(F.sum(overlap).alias("words"))
    taken = met.groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("n_slots"))
    return at.join(taken, "row", "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "first_slot",
        F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"),
    )
