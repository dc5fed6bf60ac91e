"""Five stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows that stay, with
the columns of ``docs`` (the last one: the packed pieces).  Decisions are made
in the pass over the rows themselves where they need nothing but the row, so
texts are not shuffled for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import divergence, mixing, near_dup, packing, queries, toxicity
from tessera.llm.tables import free_name, small_side, written
from tessera.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not predicted toxic; learned from the labels of the rows at hand outside the held-out fold.

    Rows without text or id are judged like any other.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.where(~toxicity.held_out(F.col("doc_id"), queries.TOXIC_FOLDS, queries.TOXIC_FOLD))
    weights = toxicity.train(docs, labels)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return toxicity.toxicity(rows, weights, id_col="row").where("predicted = 0").select("doc_id.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep; the language references are those of the rows at hand.

    Null and empty texts have fewer than 50 words and go; a null language is judged by the base rules alone.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text", "lang")
    return divergence.quality_rules(rows, id_col="row").where("kept").select("doc_id.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Rows of one doc_id are one document: one of them stays (the one with the
    smallest text).  Rows without a doc_id stay.
    """
    known = free_name(docs, "known_id")
    verdict = written(near_dup.near_duplicates(docs).where("doc_id is not null"), "verdict")
    by_id = written(verdict.groupBy(F.col("doc_id").alias(known)).agg(F.max("kept").alias("kept"), F.count("*").alias("rows")), "verdict-ids")
    gone = by_id.where("not kept").select(known)
    repeated = by_id.where("kept and rows > 1").select(known)
    same = F.col("doc_id") == F.col(known)
    left = docs.join(small_side(gone), same, "left_anti")
    once = left.join(small_side(repeated), same, "left_anti")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = left.join(small_side(repeated), same, "left_semi").groupBy("doc_id").agg(F.min_by(row, F.coalesce("text", F.lit(""))).alias("row"))
    return once.unionByName(one.select("row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes its words, in whole copies (nearest number; 0 to 3).

    Rows equal in id and text share their copies evenly; null and empty texts have no words and go.  Order is
    not kept: packing deals the rows anew.
    """
    key = F.xxhash64("doc_id", "text")
    taken = mixing.mixed(docs.select(key.alias("key"), "text", "source"), id_col="key")
    known, n = free_name(docs, "known_key"), free_name(docs, "copies")
    copies = taken.groupBy(F.col("doc_id").alias(known)).agg(F.round(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).cast("int").alias(n))
    copies = written(copies.where(F.col(n) > 0), "copies")
    joined = docs.join(small_side(copies), key == F.col(known))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    repeated = joined.select(*columns, F.explode(F.sequence(F.lit(1), n)).alias(free_name(docs, "mix_copy")))
    return repeated.select(*columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of 1024 tokens; a null or empty text is the closing id alone."""
    return packing.packed(docs, packing.read_ranks(queries.PACKING_FILE))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack),
]

#: Learned weights, MinHash and hashed orders have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's documents."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
