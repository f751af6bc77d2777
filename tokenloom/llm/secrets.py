"""Secret scans in column expressions only: fixed patterns, and character Markov models for what they miss.

Two first-order models of characters are trained on labelled samples: values that the fixed patterns found are random
strings, names of letters with few digits at the end are ordinary identifiers. Tokens that mix letters and digits and lie in no
found span become spans of their own when the log-likelihood ratio of the two models is high enough. Counts are taken
of whole texts of all rows; what reaches the driver is one count per pair of characters.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the known kinds, in the order of the kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")
MIN_VALUE = 8

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/=_-"
_CLASS = r"A-Za-z0-9+/=_-"
CANDIDATE = rf"(?<![{_CLASS}])[{_CLASS}]{{16,}}"
#: Ordinary names: letters and joints, with at most a few digits at the end.
IDENTIFIER = rf"(?<![{_CLASS}])[A-Za-z_-]{{8,}}[0-9]{{0,4}}(?![{_CLASS}])"
#: Log-likelihood ratio, in nats, above which a token counts as random.
RATIO = 10.0
_STATES = len(ALPHABET) + 1
_SPAN = "struct<start:int,kind:int,end:int>"


def _positions(text: Column, pattern: str, kind: int, value: Column | None = None) -> Column:
    """Spans of the leftmost matches, from the lengths of the pieces between them; those with a short value are dropped."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.zip_with(
        F.zip_with(F.split(text, pattern, -1), hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit"))),
        hits if value is None else value,
        lambda x, v: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), F.length(v).alias("value")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + F.coalesce(x["hit"], F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        spans = F.when(x["value"] >= MIN_VALUE, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    spans = F.aggregate(lengths, start, step, lambda s: s["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{_SPAN}>"))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start, then kind."""
    value = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    return F.array_sort(F.concat(_positions(text, ASSIGN, 0, value), _positions(text, ACCESS, 1), _positions(text, HEX, 2)))


def _free(spans: Column, base: Column) -> Column:
    """The spans that touch no base span."""
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))


def _transitions(token: Column) -> Column:
    """Numbers of the pairs of neighbouring characters, the first after a start state."""
    states = F.transform(F.split(token, ""), lambda c: F.position(c, F.lit(ALPHABET)))
    before = F.concat(F.array(F.lit(0)), F.slice(states, 1, F.greatest(F.size(states) - 1, F.lit(0))))
    return F.zip_with(before, states, lambda a, b: a * _STATES + b)


def _present(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def train(docs: DataFrame) -> list[float] | None:
    """The log-likelihood ratio of every pair of characters, random over ordinary; None without samples of either kind.

    Random strings are the values of the fixed patterns; ordinary ones are all names outside them.
    """
    text = docs.select(_present(F.col("text")).alias("text"))
    hits = F.concat(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= MIN_VALUE),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
    )
    random = text.filter(F.col("text").rlike(f"{ASSIGN}|{ACCESS}")).select(F.explode(hits).alias("token"), F.lit(1).alias("kind"))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    ordinary = text.select(F.explode(F.regexp_extract_all(plain, F.lit(IDENTIFIER), F.lit(0))).alias("token"), F.lit(0).alias("kind"))
    pairs = random.unionByName(ordinary).select("kind", F.explode(_transitions(F.col("token"))).alias("pair"))
    # At most one row for each kind and pair of characters.
    counted = pairs.groupBy("kind", "pair").count().collect()
    counts = [[0] * (_STATES * _STATES) for _ in range(2)]
    for kind, pair, n in counted:
        counts[kind][pair] = n
    if not sum(counts[0]) or not sum(counts[1]):
        return None
    out = [0.0] * (_STATES * _STATES)
    for a in range(_STATES):
        row = slice(a * _STATES + 1, (a + 1) * _STATES)
        totals = [sum(c[row]) + 0.5 * len(ALPHABET) for c in counts]
        for b in range(row.start, row.stop):
            chances = [(c[b] + 0.5) / t for c, t in zip(counts, totals)]
            out[b] = round(math.log(chances[1] / chances[0]), 3)
    return out


def ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a token, random over ordinary."""
    table = F.lit(model).cast("array<double>")
    return F.aggregate(_transitions(token), F.lit(0.0), lambda s, pair: s + F.get(table, pair))


def _text_of(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    each = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: base spans and all spans, as ``array<struct<start,kind,end>>`` of code points.

    Null and empty texts have no spans; repeated rows are scanned each for itself; ids may be null; without samples of
    random strings there are no spans beyond the base ones; an empty table gives an empty one.
    """
    model = train(docs)
    found = docs.select("doc_id", _present(F.col("text")).alias("text")).withColumn("base", base_spans(F.col("text")))
    if model is None:
        return found.select("doc_id", "base", F.col("base").alias("spans"))
    mixed = found.withColumn("candidates", _free(_positions(F.col("text"), CANDIDATE, 3), F.col("base")))

    def random(s: Column) -> Column:
        token = F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])
        return token.rlike("[0-9]") & token.rlike("[A-Za-z]") & (ratio(token, model) >= RATIO)

    added = F.when(F.size("candidates") > 0, F.filter("candidates", random)).otherwise(F.col("candidates"))
    return mixed.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    found = scan(docs.select("doc_id", "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    digest = F.sha2(_text_of(F.col("base")), 256)
    return found.select("doc_id", count(0), count(1), count(2), digest.alias("base_sha256"), _text_of(F.col("spans")).alias("spans"))
