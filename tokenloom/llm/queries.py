"""The operators of this folder as queries over the given tables, and the SQL forms of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import decontam, licenses, lm, merkle, mixing, negatives, phrases, secrets, sharding, simhash, substring, topk, toxicity
from tokenloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents", "doc_id", "text")


@query
def op1_passages(spark: SparkSession, sf: str) -> DataFrame:
    return substring.repeated_passages(_texts(spark, sf))


@query
def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.simhash_groups(_texts(spark, sf))


@query
def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.contamination_report(_texts(spark, sf), table(spark, sf, "benchmark", "item_id", "text"))


@query
def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity_report(_texts(spark, sf), table(spark, sf, "labels", "doc_id", "toxic"))


@query
def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.report(_texts(spark, sf))


@query
def op6_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(_texts(spark, sf))


ORACLES["op6_licenses"] = licenses.sql()


@query
def op7_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_products(table(spark, sf, "embeddings", "vec_id", "embedding"))


@query
def op8_lm(spark: SparkSession, sf: str) -> DataFrame:
    return lm.scores(_texts(spark, sf))


@query
def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Every use of a document in a mixture as large as the corpus, no source more than four times."""
    docs = table(spark, sf, "documents", "doc_id", "text", "source")
    budget = docs.agg(F.sum(mixing.n_tokens(F.col("text")))).first()[0] or 0
    uses = mixing.mix(docs, budget=budget, target_entropy=0.97, max_epochs=4.0, epoch="epoch", order="mix_order")
    return uses.select("doc_id", "source", mixing.n_tokens(F.col("text")).alias("tokens"), "epoch", "mix_order")


@query
def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    # The sum is taken of the text before it is dropped: only numbers are sorted and written.
    text = F.coalesce("text", F.lit(""))
    docs = _texts(spark, sf).select("doc_id", "text", F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.shard_by_bytes(docs, carry=["doc_id", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op11_merkle(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.edited_report(_texts(spark, sf))


ORACLES["op11_merkle"] = merkle.SQL


@query
def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return negatives.hard_negatives(negatives.changed_labels(table(spark, sf, "embeddings", "vec_id", "embedding", "label")))


ORACLES["op12_hard_negatives"] = negatives.SQL


@query
def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents", "lang", "text"))


ORACLES["op13_collocations"] = phrases.SQL
