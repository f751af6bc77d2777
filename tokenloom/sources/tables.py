"""Table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenloom.session import spread


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The documents with the columns asked for, the only ones the scan reads."""
    docs = read_table(spark, folder, "documents").select(*(columns or ("doc_id", "text")))
    return spread(docs, docs.columns[0])
