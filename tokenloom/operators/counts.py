"""Counting operators: every one is a hash aggregate with map-side partial sums, so a hot word costs one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import text as tx


def count_items(df: DataFrame, items: Column, name: str) -> DataFrame:
    """Occurrences of each element of an array column: ``(name, frequency)``."""
    return df.select(F.explode(items).alias(name)).groupBy(name).agg(F.count("*").alias("frequency"))


def word_occurrences(docs: DataFrame, key: str = "doc_id", pattern: str = tx.KEPT_PATTERN) -> DataFrame:
    """One row per word in reading order: ``(key, pos, word)``. No shuffle."""
    return docs.select(key, F.posexplode(tx.words(F.col("text"), pattern)).alias("pos", "word"))


def word_frequency(docs: DataFrame, pattern: str = tx.KEPT_PATTERN) -> DataFrame:
    return count_items(docs, tx.words(F.col("text"), pattern), "word")


def pretoken_frequency(docs: DataFrame, pattern: str = tx.KEPT_PATTERN) -> DataFrame:
    return count_items(docs, tx.pretokens(F.col("text"), pattern), "piece")


def role_token_counts(windows: DataFrame) -> DataFrame:
    """How often each token occurs as window input and as label: ``(role, token, n)``."""
    # Both roles leave in one pass, so the windows are computed only once; the label stands after the inputs.
    whole = F.concat("input", F.array("label"))
    placed = windows.select(F.size("input").alias("w"), F.posexplode(whole).alias("place", "token"))
    counted = placed.groupBy((F.col("place") < F.col("w")).alias("is_input"), "token").agg(F.count("*").alias("n"))
    return counted.select(F.when(F.col("is_input"), "input").otherwise("label").alias("role"), "token", "n")


def window_positions(windows: DataFrame) -> DataFrame:
    """How often each token occurs at each place of a window: ``(token, position, n)``."""
    placed = windows.select(F.posexplode("input").alias("position", "token"))
    return placed.groupBy("token", "position").agg(F.count("*").alias("n"))
