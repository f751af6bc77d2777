"""Merge token frequencies and neighbours into one record per token, and render the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.params import Params


def tagged_union(frequencies: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Both sources as one keyed stream: ``(source, token, payload)``."""
    left = frequencies.select(
        F.lit("tokenization").alias("source"),
        F.col("token").cast("string").alias("token"),
        F.concat_ws("\t", "word", F.col("frequency").cast("string")).alias("payload"),
    )
    right = neighbours.select(
        F.lit("semantic_similarity").alias("source"),
        F.col("token").cast("string").alias("token"),
        F.array_join("similar", ",").alias("payload"),
    )
    return left.unionByName(right)


def neighbour_lists(similar: DataFrame) -> DataFrame:
    """Ranked neighbours folded to ``(token, similar ARRAY<STRING>)``, best first. Groups hold at most k rows."""
    entry = F.struct("rank", F.col("similar").cast("string").alias("t"))
    lists = similar.groupBy("token").agg(F.array_sort(F.collect_list(entry)).alias("l"))
    return lists.select("token", F.col("l.t").alias("similar"))


def collate(frequencies: DataFrame, neighbours: DataFrame, params: Params = Params()) -> DataFrame:
    """Full outer merge by token: ``(word, token, frequency, similar)``.

    ``frequencies`` is ``(word, token, frequency)``, ``neighbours`` is ``(token, similar ARRAY<STRING>)``. A token may
    repeat on either side: its most frequent word is kept, and its lists are concatenated. Both groupings are by the
    join key, so the join adds no shuffle of its own. A token without word gets the N/A value and frequency 0; one
    without neighbours gets NULL, which only the report turns into text.
    """
    # max() over a struct is reduced map-side, unlike a sort per token.
    counted = frequencies.groupBy(F.col("token").cast("string").alias("token")).agg(
        F.max(F.struct("frequency", "word")).alias("f")
    )
    listed = neighbours.groupBy(F.col("token").cast("string").alias("token")).agg(
        F.flatten(F.array_sort(F.collect_list("similar"))).alias("similar")
    )
    merged = counted.join(listed, "token", "full_outer")
    word = F.when(F.col("f.word") != "", F.col("f.word"))
    return merged.select(
        F.coalesce(word, F.lit(params.na_value)).alias("word"),
        "token",
        F.coalesce(F.col("f.frequency"), F.lit(0)).cast("long").alias("frequency"),
        F.when(F.size("similar") > 0, F.col("similar")).alias("similar"),
    )


# Characters that YAML does not print and JSON leaves as they are.
_UNPRINTED = [chr(c) for c in (*range(0x7F, 0xA0), 0x2028, 0x2029, 0xFEFF)]


def _quoted(value: Column) -> Column:
    """A double-quoted scalar that YAML and JSON both read back: quotes, backslashes and control characters escaped."""
    record = F.to_json(F.struct(value.alias("v")))
    text = F.substring(record, F.lit(6), F.length(record) - 6)
    escaped = text
    for c in _UNPRINTED:
        escaped = F.replace(escaped, F.lit(c), F.lit(f"\\u{ord(c):04x}"))
    return F.when(text.rlike("[" + "".join(_UNPRINTED) + "]"), escaped).otherwise(text)


def report_yaml(collated: DataFrame, params: Params = Params()) -> DataFrame:
    """One four-key YAML mapping per token: ``(token, text)``. Strings are always quoted."""
    listed = F.concat(F.lit("["), F.array_join(F.transform("similar", _quoted), ", "), F.lit("]"))
    text = F.concat(
        F.lit(f"{params.word_key}: "), _quoted(F.col("word")), F.lit("\n"),
        F.lit(f"{params.int_token_key}: "), _quoted(F.col("token")), F.lit("\n"),
        F.lit(f"{params.frequency_key}: "), F.col("frequency").cast("string"), F.lit("\n"),
        F.lit(f"{params.similar_tokens_key}: "), F.coalesce(listed, _quoted(F.lit(params.na_value))), F.lit("\n"),
    )
    return collated.select("token", text.alias("text"))


def report_json(collated: DataFrame, params: Params = Params()) -> DataFrame:
    """The same record as one JSON object per token: ``(token, text)``, the list absent for a token without one."""
    record = F.struct(
        F.col("word").alias(params.word_key),
        F.col("token").alias(params.int_token_key),
        F.col("frequency").alias(params.frequency_key),
        F.col("similar").alias(params.similar_tokens_key),
    )
    return collated.select("token", F.to_json(record).alias("text"))
