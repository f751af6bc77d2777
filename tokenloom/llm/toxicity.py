"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression.

Labels are taken from a bounded sample of training rows, ``MAX_LABELLED``, chosen by a hash of the id; nothing else is
bounded. The lexicon is learned from that sample too: words that occur in far more toxic documents than in others.
Every text is scored whole, in one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import crc_remainder, fresh
from tokenloom.session import materialise

MAX_LABELLED = 20_000
MAX_LEXICON = 200
THRESHOLD = 0.7
#: Of the sampled rows, one in so many calibrates and does not train the trees.
CALIBRATION = 4
NEAR = 5

# Second-person words of the languages covered.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros os vuestro".split()
)
_MARKS = ".,;:!?\"'()[]{}<>|&%#~…«»“”’`*$@+=/\\-_"
_SPACED = str.maketrans(_MARKS, " " * len(_MARKS))
_PLAIN = str.maketrans("0134578@$!|+", "oieastbasilt")
_HIDDEN = re.compile(r"[^\W\d_]+[\d@$!|*+.\-_]+[^\W\d_]")
_RUN = re.compile(r"([^\W\d_])\1\1")
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
N_FEATURES = 14


def words_of(text: str) -> list[str]:
    return text.lower().translate(_SPACED).split()


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """Densities of lexicon words, their nearness to second-person words, and rates of form."""
    words = words_of(text)
    n, size = max(1, len(words)), max(1, len(text))
    found = lexicon.keys() & set(words)
    hits = [i for i, w in enumerate(words) if w in found] if found else []
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if hits and second:
        at = np.array(second)
        left = np.searchsorted(at, np.array(hits) - NEAR)
        near = int(((left < len(at)) & (at[np.minimum(left, len(at) - 1)] <= np.array(hits) + NEAR)).sum())
    hidden = [t for t in text.lower().split() if not t.isalpha() and _HIDDEN.search(t)]
    plain = sum(t.strip(_MARKS).translate(_PLAIN).replace("*", "").replace(".", "").replace("-", "") in lexicon for t in hidden)
    raw = text.encode()
    upper = len(raw) - len(raw.translate(None, _UPPER))
    lower = len(raw) - len(raw.translate(None, _LOWER))
    weight = sum(lexicon[words[i]] for i in hits)
    return [
        len(hits) / n,
        math.log1p(len(hits)),
        float(len(found)),
        weight / n,
        max((lexicon[w] for w in found), default=0.0),
        near / max(1, len(hits)),
        len(second) / n,
        upper / max(1, upper + lower),
        text.count("!") / size,
        text.count("?") / size,
        sum(map(text.count, ".,;:#$%&*|")) / size,
        len(hidden) / n,
        math.log1p(plain),
        len(_RUN.findall(text)) / n,
    ]


def feature_column(text: Column, lexicon: dict[str, float]) -> Column:
    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        rows = [features(t or "", lexicon) for t in texts.to_pylist()]
        return pa.array(rows, pa.list_(pa.float64()))

    return of(text)


@dataclass
class Model:
    """Without trees, when the labels are missing or all alike, every score is ``prior``."""

    lexicon: dict[str, float]
    prior: float
    trees: GBTClassificationModel | None = None
    steps: IsotonicRegressionModel | None = None


def _lexicon(sample: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Words by the log odds of a toxic document that has them, where these are large and the likelihood ratio is sure."""

    @F.arrow_udf("array<string>")
    def distinct(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(set(words_of(t or ""))) for t in texts.to_pylist()], pa.list_(pa.string()))

    each = sample.select("toxic", F.explode(distinct("text")).alias("word"))
    counted = each.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    odds = F.log((a + 0.5) / (toxic - a + 0.5)) - F.log((b + 0.5) / (clean - b + 0.5))
    share = (a + b) / (toxic + clean)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    sure = 2 * (
        part(a, toxic * share)
        + part(toxic - a, toxic * (1 - share))
        + part(b, clean * share)
        + part(clean - b, clean * (1 - share))
    )
    chosen = counted.select("word", odds.alias("odds"), sure.alias("sure")).filter("odds > 2 and sure > 20")
    # The lexicon is as long as its parameter at most.
    return {r["word"]: r["odds"] for r in chosen.orderBy(F.desc("sure"), "word").limit(MAX_LEXICON).collect()}


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from ``labels(doc_id, toxic)`` of documents; rows with a null id or another label than 0 and 1 are left out."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    # At most max_labelled rows of two numbers.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = materialise(sample.select("doc_id", "text", F.col("toxic").cast("long")))
    toxic, n = sample.agg(F.sum("toxic"), F.count("*")).first()
    if not toxic or toxic == n:
        return Model({}, (toxic or 0) / n if n else 0.0)
    lexicon = _lexicon(sample, toxic, n - toxic)
    fold = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(CALIBRATION))
    dense = sample.select(feature_column(F.col("text"), lexicon).alias("f"), F.col("toxic").cast("double").alias("label"), fold.alias("fold"))
    dense = materialise(dense).coalesce(4).select("fold", "label", array_to_vector("f").alias("features")).cache()
    try:
        fit, held = dense.filter("fold > 0"), dense.filter("fold = 0")
        if {r[0] for r in fit.select("label").distinct().collect()} != {0.0, 1.0} or held.isEmpty():
            return Model(lexicon, toxic / n)
        trees = GBTClassifier(maxIter=15, maxDepth=3, stepSize=0.3, seed=42, maxBins=64, cacheNodeIds=False).fit(fit)
        steps = IsotonicRegression(featuresCol="margin").fit(_margin(trees, held, "margin"))
    finally:
        dense.unpersist()
    return Model(lexicon, toxic / n, trees, steps)


def _margin(trees: GBTClassificationModel, df: DataFrame, name: str) -> DataFrame:
    """``df(features, …)`` with the summed margin of the trees; the trees' own columns are dropped."""
    outputs = [trees.getRawPredictionCol(), trees.getProbabilityCol(), trees.getPredictionCol()]
    return trees.transform(df).withColumn(name, vector_to_array(outputs[0])[1]).drop(*outputs)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the calibrated chance, 0 to 1, that a row is toxic. Null and empty texts are scored as empty."""
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"docs already has a column {name}")
    if model.trees is None:
        return docs.withColumn(name, F.lit(float(model.prior)))
    row = "row"
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(row), feature_column(F.col("text"), model.lexicon).alias("f"))
    ready = packed.select(row, array_to_vector("f").alias("features"))
    margins = _margin(model.trees.copy(), ready, "margin")
    scored = model.steps.transform(margins)
    value = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(model.steps.getPredictionCol())))
    return scored.select(f"{row}.*", value.alias(name))


def toxicity_report(docs: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row; labels of held-out rows are never seen.

    Held out are rows whose ``crc32(doc_id as text) mod folds`` is ``held_fold``. Repeated rows are scored each for
    itself, with equal scores; without usable labels every score is the share of toxic ones, 0 if there are none.
    """
    texts = docs.select("doc_id", "text")
    model = train(texts, labels.filter(crc_remainder(F.col("doc_id"), folds) != held_fold))
    scored = score(texts, model)
    held = crc_remainder(F.col("doc_id"), folds) == held_fold
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with their columns.

    Where the labels are missing, all alike or too few to fit and calibrate trees, nothing tells rows apart and all are
    kept. Null and empty texts are scored as empty, repeated rows each for itself with equal scores, so all of them stay
    or go; a score at the threshold goes. An empty table stays empty, and columns of any further name are untouched.
    """
    model = train(docs, labels)
    if model.trees is None:
        return docs
    name = fresh(docs, "toxicity")
    return score(docs, model, name).filter(F.col(name) < threshold).drop(name)
