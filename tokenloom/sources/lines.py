"""Text sources and the line formats exchanged between stages.

Every ``parse_*`` keeps the well-formed lines of a ``value STRING`` frame as typed rows; ``malformed`` selects the
others by the same predicate. A well-formed line has the right number of fields, where trailing empty fields do not
count. ``strict=True`` raises on the first bad line instead of dropping it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tokenloom.params import Params


def read_lines(spark: SparkSession, path: str, params: Params = Params()) -> DataFrame:
    """One row per line of a file or directory; names starting with ``_`` or ``.`` are skipped by Spark.

    ``split_mb`` caps the bytes one task reads. It is set in a child session with the caller's other settings, so the
    caller's own scans keep theirs.
    """
    child = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if child.conf.isModifiable(name):
            child.conf.set(name, value)
    child.conf.set("spark.sql.files.maxPartitionBytes", str(params.split_mb * 1024 * 1024))
    return child.read.text(path)


def fields(line: Column, delimiter: str = "\t") -> Column:
    """Split on a literal delimiter. Trailing empty fields are dropped, so a line of delimiters only has none."""
    if len(delimiter) == 1:
        trimmed = F.rtrim(line, F.lit(delimiter))
    else:
        trimmed = F.regexp_replace(line, f"(?:{_literal(delimiter)})+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _literal(delimiter)))


def _literal(delimiter: str) -> str:
    return "".join(c if c.isalnum() or c.isspace() else "\\" + c for c in delimiter)


def well_formed(line: Column, kind: str, params: Params = Params()) -> Column:
    """Whether a line has the shape its format demands."""
    split = fields(line, params.field_delimiter)
    size = F.size(split)
    rules: dict[str, Callable[[], Column]] = {
        "tokens": lambda: size > params.token_index,
        "frequencies": lambda: (size == 3) & F.get(split, F.lit(2)).try_cast("long").isNotNull(),
        "windows": lambda: size == 2,
        "vectors": lambda: size == 2,
        "similar": lambda: size == 2,
    }
    return rules[kind]()


def observed(lines: DataFrame, kind: str, observation: Observation, params: Params = Params()) -> DataFrame:
    """The same lines; whatever reads them also leaves ``n_ok`` and ``n_bad``, by the rule of the format, in ``observation``."""
    good = well_formed(F.col("value"), kind, params)
    return lines.observe(observation, F.count_if(good).alias("n_ok"), F.count_if(~good).alias("n_bad"))


def malformed(lines: DataFrame, kind: str, params: Params = Params()) -> DataFrame:
    return lines.filter(~well_formed(F.col("value"), kind, params))


def count_malformed(lines: DataFrame, kind: str, params: Params = Params()) -> DataFrame:
    """``(format, n_ok, n_bad)`` in one pass."""
    good = well_formed(F.col("value"), kind, params)
    return lines.agg(F.count_if(good).alias("n_ok"), F.count_if(~good).alias("n_bad")).select(
        F.lit(kind).alias("format"), "n_ok", "n_bad"
    )


def _good_fields(lines: DataFrame, kind: str, params: Params, strict: bool) -> DataFrame:
    good = well_formed(F.col("value"), kind, params)
    split = fields(F.col("value"), params.field_delimiter)
    if strict:
        failure = F.raise_error(F.concat(F.lit(f"malformed {kind} line: "), F.col("value"))).cast("array<string>")
        return lines.select(F.when(good, split).otherwise(failure).alias("f"))
    return lines.filter(good).select(split.alias("f"))


def parse_tokens(lines: DataFrame, params: Params = Params(), strict: bool = False) -> DataFrame:
    """The token field of token-frequency lines with at least that many fields: ``(token STRING)``."""
    return _good_fields(lines, "tokens", params, strict).select(F.get("f", F.lit(params.token_index)).alias("token"))


def parse_frequencies(lines: DataFrame, params: Params = Params(), strict: bool = False) -> DataFrame:
    """Token-frequency lines of exactly three fields: ``(word, token STRING, frequency BIGINT)``.

    A line whose frequency is no number is malformed.
    """
    f = _good_fields(lines, "frequencies", params, strict)
    number = F.get("f", F.lit(2)).try_cast("long")
    return f.select(F.get("f", F.lit(0)).alias("word"), F.get("f", F.lit(1)).alias("token"), number.alias("frequency"))


def parse_windows(lines: DataFrame, params: Params = Params(), strict: bool = False) -> DataFrame:
    """Window lines: ``(role, idx STRING, tokens ARRAY<INT>)``; a token that is no integer fails the query."""
    f = _good_fields(lines, "windows", params, strict)
    name = F.get("f", F.lit(0))
    return f.select(
        F.split_part(name, F.lit("_"), F.lit(1)).alias("role"),
        F.regexp_extract(name, "_(.*)$", 1).alias("idx"),
        fields(F.get("f", F.lit(1)), ",").cast("array<int>").alias("tokens"),
    )


def pair_windows(parsed: DataFrame) -> DataFrame:
    """Bring each window together with its label by their shared index: ``(idx, input, label)``."""
    inputs = parsed.filter(F.col("role") == "input").select("idx", F.col("tokens").alias("input"))
    labels = parsed.filter(F.col("role") == "label").select("idx", F.get("tokens", F.lit(0)).alias("label"))
    return inputs.join(labels, "idx")


def parse_vector(text: Column) -> Column:
    """``[a, b]`` to ``ARRAY<FLOAT>``; a bad number fails the query."""
    inner = F.regexp_replace(text, r"^\[|\]$", "")
    return F.transform(fields(inner, ","), lambda x: F.trim(x).cast("float"))


def parse_vectors(lines: DataFrame, params: Params = Params(), strict: bool = False) -> DataFrame:
    """Vector lines: ``(token STRING, vector ARRAY<FLOAT>)``."""
    f = _good_fields(lines, "vectors", params, strict)
    return f.select(F.get("f", F.lit(0)).alias("token"), parse_vector(F.get("f", F.lit(1))).alias("vector"))


def pack_vector(token: Column, vector_text: Column, params: Params = Params()) -> Column:
    """Token and vector text in one string, e.g. ``t|[0.1, 0.2]``."""
    return F.concat(token, F.lit(params.embedding_delimiter), vector_text)


def parse_packed_vectors(packed: DataFrame, params: Params = Params()) -> DataFrame:
    """The inverse of :func:`pack_vector` over a ``value`` column; other shapes are dropped."""
    f = packed.select(fields(F.col("value"), params.embedding_delimiter).alias("f")).filter(F.size("f") == 2)
    return f.select(F.get("f", F.lit(0)).alias("token"), parse_vector(F.get("f", F.lit(1))).alias("vector"))


def similar_tokens(text: Column, params: Params = Params()) -> Column:
    """The tokens of ``t(score),…`` without their scores; a malformed pair becomes the N/A value."""

    def token(pair: Column) -> Column:
        parts = fields(F.trim(pair), params.similarity_score_delimiter)
        return F.when(F.size(parts) == 2, F.get(parts, F.lit(0))).otherwise(F.lit(params.na_value))

    return F.transform(fields(text, params.similarity_pair_delimiter), token)


def parse_similar(lines: DataFrame, params: Params = Params(), strict: bool = False) -> DataFrame:
    """Neighbour lines: ``(token STRING, similar ARRAY<STRING>)``."""
    f = _good_fields(lines, "similar", params, strict)
    return f.select(F.get("f", F.lit(0)).alias("token"), similar_tokens(F.get("f", F.lit(1)), params).alias("similar"))
