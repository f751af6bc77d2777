"""The corpus pipeline: five stages over ``documents``, each written and reread as the input of the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import common, decontam, mixing, sharding, simhash, toxicity
from tokenloom.session import shared_folder

#: A training set may use a document of a small source this often.
MAX_EPOCHS = 2.0


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of the classifier that the labels train; all of them if labels cannot train one."""
    return toxicity.drop_toxic(docs, common.table(spark, sf_dir, "labels", "doc_id", "toxic"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window; null, empty and wordless texts have none."""
    return decontam.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document is used at least once; small sources again, up to the repetition limit."""
    return mixing.mix(docs, max_epochs=MAX_EPOCHS)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its size, shard and slot, in columns named afresh where documents has such names."""
    names = [common.fresh(docs, c) for c in ("size", "shard", "slot")]
    return sharding.shard_by_bytes(docs, size=names[0], shard=names[1], slot=names[2])


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Training, hashing and prefix sums over runs have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents through all stages; the table of each lies in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
