"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.session import materialise


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where the frame already has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(texts: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null is the empty text."""
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def crc_remainder(doc_id: Column, n: int) -> Column:
    """``crc32(doc_id as text) mod n``; a row without an id has none and counts as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` of every node of the links ``(a, b)``; nodes are longs in random order, as hashes are.

    Every round gives each node the least node within two links of it, then links these instead and drops what
    became equal. Stars vanish in one round and chains shrink by a constant share, because the order of hashes is
    random. All of it is min aggregates and joins on single nodes, so hubs neither gather nor stall a task.
    Links of a round are written to the shared folder, which also cuts the lineage.
    """
    rounds: list[DataFrame] = []
    pairs = materialise(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while not pairs.isEmpty():
        both = pairs.union(pairs.select("b", "a"))
        near = both.groupBy("a").agg(F.least("a", F.min("b")).alias("near"))
        reach = both.join(near.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("near").alias("label"))
        to = materialise(reach.select(F.col("a").alias("node"), F.least("node", "label").alias("label")))
        rounds.append(to)
        ends = [to.select(F.col("node").alias(c), F.col("label").alias(f"{c}_to")) for c in ("a", "b")]
        moved = pairs.join(ends[0], "a").join(ends[1], "b").filter("a_to <> b_to")
        pairs = materialise(moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct())
    if not rounds:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = rounds.pop()
    while rounds:
        later = labels.select(F.col("node").alias("label"), F.col("label").alias("last"))
        labels = rounds.pop().join(later, "label", "left").select("node", F.coalesce("last", "label").alias("label"))
    return labels
