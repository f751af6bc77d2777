"""Hard negatives by rotated one-bit codes.

Quantised vectors are rotated (random signs and Walsh-Hadamard transforms, twice) and coded by the signs of their components,
one bit each. With a code goes its alignment: the inner product of the vector and the unit code vector. What a step along
the code leaves over is coded again, ``LEVELS`` times. A product with a query is at first estimated from the first code, by
popcounts against the bit planes of the query's components, and lies within an interval that is certain: the length of the
vector beside the code, times that of the query beside it (Cauchy-Schwarz), and the rounding of the query's planes.
Later codes narrow the interval of the rows that are still open. Only rows whose interval reaches a list
that they could enter are scored in whole numbers.

Anchors come in blocks of bounded size. Every task compares a block with its own rows and keeps a few per list; lists
are merged per list. No rows are grouped by label, so a label may hold any share of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.session import materialise, shared_folder, spread

K = 5
#: Anchors are the rows whose id is divisible by this.
EVERY = 100
#: A negative's score is between this many per cent of the positive's score and the whole of it.
LEAST_PERCENT = 80
LEVELS = 6
PLANES = 8
#: Bytes of anchor vectors in one pass over the rows; more anchors take more passes.
PASS_BYTES = 8 << 20
_SEED = 12
_EXACT = float(1 << 53)
_SLACK = 1e-9
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_INDEX = "vec_id long, label long, size int, vector array<double>, codes binary, aligned binary"


def _rotated(x: np.ndarray) -> np.ndarray:
    """Rows turned by one fixed orthogonal matrix, padded to a multiple of 64 that is a power of two."""
    n, size = x.shape
    width = max(64, 1 << max(0, size - 1).bit_length())
    y = np.zeros((n, width))
    y[:, :size] = x
    rng = np.random.default_rng(_SEED)
    for _ in range(2):
        y *= np.where(rng.integers(0, 2, width), 1.0, -1.0)
        h = 1
        while h < width:
            pairs = y.reshape(n, width // (2 * h), 2, h)
            y = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, width)
            h *= 2
        y /= np.sqrt(width)
    return y


def encoded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes ``(rows, levels, words)`` and numbers ``(rows, 1 + 3 levels)``: length, alignments, lengths beside, steps.

    A code's alignment and the length beside it split what there is before the code. The next code is taken of what is
    left after a step of half the greatest component, so that every code halves the greatest.
    """
    rest = _rotated(x)
    n, width = rest.shape
    root = np.sqrt(width)
    codes = np.empty((n, LEVELS, width // 64), np.uint64)
    aligned = np.empty((n, 1 + 3 * LEVELS))
    aligned[:, 0] = np.sqrt((x * x).sum(1))
    for level in range(LEVELS):
        up = rest >= 0
        codes[:, level] = np.packbits(up, axis=1, bitorder="little").view(np.uint64)
        size = np.abs(rest)
        alignment, step = size.sum(1) / root, size.max(1) / 2
        aligned[:, 1 + level] = alignment
        aligned[:, 1 + LEVELS + level] = np.sqrt(((size - (alignment / root)[:, None]) ** 2).sum(1))
        aligned[:, 1 + 2 * LEVELS + level] = step * root
        rest = rest - np.where(up, 1.0, -1.0) * step[:, None]
    return codes, aligned


class Query:
    """A vector's bit planes, and the intervals of its products with coded rows."""

    def __init__(self, vector: np.ndarray):
        self.vector = vector
        self.norm = float(np.sqrt(vector @ vector))
        turned = _rotated(vector[None])[0]
        self.width = len(turned)
        self.low = float(turned.min())
        self.step = max((float(turned.max()) - self.low) / ((1 << PLANES) - 1), 1e-300)
        steps = np.clip(np.rint((turned - self.low) / self.step), 0, (1 << PLANES) - 1) if np.isfinite(self.norm) else np.zeros(self.width)
        self.error = float(np.linalg.norm(turned - (self.low + self.step * steps)))
        bits = (steps.astype(np.int64)[None, :] >> np.arange(PLANES)[:, None]) & 1
        self.planes = np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view(np.uint64)
        self.total = int(steps.sum())

    def _along(self, code: np.ndarray) -> np.ndarray:
        """Products of the query's planes with unit code vectors ``(rows, words)``, by popcounts."""
        weighted = np.zeros(len(code), np.int64)
        for plane, word in enumerate(self.planes):
            weighted += np.bitwise_count(code & word).sum(1, dtype=np.int64) << plane
        ones = np.bitwise_count(code).sum(1, dtype=np.int64)
        return (self.low * (2 * ones - self.width) + self.step * (2 * weighted - self.total)) / np.sqrt(self.width)

    def intervals(self, codes: np.ndarray, aligned: np.ndarray, open_: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """Places of the rows that are open after the last code; ``open_(low, high)`` says which are after each."""
        places = np.arange(len(codes))
        estimate = np.zeros(len(codes))
        for level in range(LEVELS):
            along = self._along(codes[places, level])
            middle = estimate + aligned[places, 1 + level] * along
            estimate = estimate + aligned[places, 1 + 2 * LEVELS + level] * along
            certain = np.maximum(np.abs(along) - self.error, 0.0)
            beside = np.sqrt(np.maximum(self.norm * self.norm - certain * certain, 0.0))
            left = aligned[places, 1 + LEVELS + level]
            far = beside * left + self.error * (aligned[places, 0] + left)
            far += _SLACK * self.norm * aligned[places, 0] + _SLACK
            low, high = middle - far, middle + far
            bad = ~(np.isfinite(low) & np.isfinite(high))
            low[bad], high[bad] = -np.inf, np.inf
            kept = open_(low, high)
            places, estimate = places[kept], estimate[kept]
            if not places.size:
                break
        return places

    def scores(self, rows: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Whole inner products, cut to the range of a long."""
        with np.errstate(all="ignore"):
            huge = ~(self.norm * norms < _EXACT)
            products = rows @ self.vector
        products[huge] = 0
        scores = products.astype(np.int64)
        for i in np.flatnonzero(huge):
            whole = sum(int(a) * int(b) for a, b in zip(self.vector.tolist(), rows[i].tolist(), strict=True))
            scores[i] = min(max(whole, _LEAST), _MOST)
        return scores


class Lists:
    """The best ``k`` (score, id) of lists that each take scores of a range; worst entries are floors for what may still enter."""

    def __init__(self, ranges: list[tuple[int, int]], k: int):
        self.ranges, self.k = ranges, k
        self.scores = [np.empty(0, np.int64) for _ in ranges]
        self.ids = [np.empty(0, np.int64) for _ in ranges]

    def open(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        # Scores are cut to the range of a long, so intervals are too.
        low, high = np.clip(low, _LEAST, _MOST), np.clip(high, _LEAST, _MOST)
        out = np.zeros(len(low), bool)
        for (least, most), held in zip(self.ranges, self.scores, strict=True):
            floor = float(held[-1]) if len(held) == self.k else -np.inf
            sure = low[(low >= least) & (high <= most)]
            if len(sure) >= self.k:
                floor = max(floor, np.partition(sure, len(sure) - self.k)[len(sure) - self.k])
            # A double may round a bound of 64 bits; a unit in the last place keeps it on the safe side.
            floor = np.nextafter(max(floor, float(least)), -np.inf)
            out |= (high >= floor) & (low <= np.nextafter(float(most), np.inf))
        return out

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for i, (least, most) in enumerate(self.ranges):
            taken = (scores >= least) & (scores <= most)
            if taken.any():
                found, score = np.concatenate((self.ids[i], ids[taken])), np.concatenate((self.scores[i], scores[taken]))
                # ~score falls as score grows and, unlike -score, exists for every long.
                best = np.lexsort((found, ~score))[: self.k]
                self.ids[i], self.scores[i] = found[best], score[best]


def _doubles(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), width)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels, vectors, codes and alignments of the rows of each length in a batch of the index."""
    sizes = batch.column(2).to_numpy()
    for size in np.unique(sizes).tolist():
        rows = batch.take(pa.array(np.flatnonzero(sizes == size)))
        n = len(rows)
        codes = np.frombuffer(b"".join(rows.column(4).to_pylist()), np.uint64).reshape(n, LEVELS, -1)
        aligned = np.frombuffer(b"".join(rows.column(5).to_pylist()), np.float64).reshape(n, 1 + 3 * LEVELS)
        yield rows.column(0).to_numpy(), rows.column(1).to_numpy(), _doubles(rows.column(3), size), codes, aligned


def index(vectors: DataFrame) -> DataFrame:
    """The rows of ``vectors(vec_id, embedding, label)`` that take part, with their codes: written to the shared folder.

    Null ids, labels and vectors, and vectors with a null or non-finite component, take no part.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    usable = usable.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                rows = batch.take(pa.array(np.flatnonzero(sizes == size)))
                with np.errstate(all="ignore"):
                    x = np.clip(np.floor(256.0 * _doubles(rows.column(2), size)), -np.finfo(float).max, np.finfo(float).max)
                    codes, aligned = encoded(x)
                offsets = np.arange(len(rows) + 1, dtype=np.int32) * size
                columns = [rows.column(0), rows.column(1), pa.array(np.full(len(rows), size, np.int32))]
                columns += [pa.ListArray.from_arrays(offsets, x.ravel())]
                columns += [pa.array([r.tobytes() for r in part], pa.binary()) for part in (codes, aligned)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "size", "vector", "codes", "aligned"])

    return materialise(spread(usable, "vec_id").mapInArrow(encode, _INDEX))


def _pass(rows: DataFrame, asked: list[dict], same_label: bool, k: int) -> DataFrame:
    """The best of every task for each list: ``(anchor, place, vec_id, score)``.

    ``asked`` holds id, label, vector and ranges of every anchor. Rows of the anchor's label are taken, or all others.
    """
    sent = rows.sparkSession.sparkContext.broadcast(asked)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = [(a["anchor"], a["label"], Query(np.array(a["vector"])), Lists(a["ranges"], k)) for a in sent.value if a["ranges"]]
        for batch in batches:
            for ids, labels, x, codes, aligned in _groups(batch):
                of_label = {n: np.flatnonzero((labels == n) == same_label) for n in {label for _, label, _, _ in work}}
                for anchor, label, query, lists in work:
                    at = of_label[label]
                    if len(query.vector) != x.shape[1] or not at.size:
                        continue
                    at = at[ids[at] != anchor]
                    at = at[query.intervals(codes[at], aligned[at], lists.open)]
                    if at.size:
                        lists.add(ids[at], query.scores(x[at], aligned[at, 0]))
        found = [(a, i, ids, scores) for a, _, _, lists in work for i, (ids, scores) in enumerate(zip(lists.ids, lists.scores, strict=True))]
        if found:
            lengths = [len(f[2]) for f in found]
            columns = [np.repeat([f[0] for f in found], lengths), np.repeat([f[1] for f in found], lengths)]
            columns += [np.concatenate([f[i] for f in found]) for i in (2, 3)]
            columns = [pa.array(c.astype(np.int64)) for c in columns]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "place", "vec_id", "score"])

    best = rows.mapInArrow(search, "anchor long, place long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, k: int = K, every: int = EVERY, percent: int = LEAST_PERCENT, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of ``vectors(vec_id, embedding, label)``.

    Components become ``floor(256 x)``, a score is the inner product, cut to the range of a long; higher scores come first, ties
    by smaller id. Anchors are the rows with ids divisible by ``every``, their positives the first ``k`` other rows of the
    same label, and the negatives of a positive the first ``k`` rows of other labels with
    ``percent * positive_score <= 100 * negative_score <= 100 * positive_score``.

    Rows without id or label, and vectors that are null or hold null or non-finite components, take no part; vectors meet only
    vectors of their own length. Of rows with one anchor id the least (label, vector) asks, and none of them is its own
    positive or negative; other rows with equal ids count each for itself. A positive without negatives and an anchor
    without positives give no rows; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    rows = index(vectors)
    anchors = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    anchors = materialise(anchors.select(F.col("vec_id").alias("anchor"), "row.label", "row.vector"))
    parts = 1 + int((anchors.agg(F.sum(8 * F.size("vector") + 16)).first()[0] or 0) // pass_bytes)
    base = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for part in range(parts):
        # About ``pass_bytes``: the blocks are dealt by a hash of unique ids.
        block = [r.asDict() for r in anchors.filter(F.pmod(F.xxhash64("anchor"), F.lit(parts)) == part).toLocalIterator()]
        asked = [{**a, "ranges": [(_LEAST, _MOST)]} for a in block]
        positives: dict[int, list[tuple[int, int]]] = {}
        # At most ``k`` rows for each anchor of the block.
        for r in _pass(rows, asked, True, k).orderBy("anchor", "rank").collect():
            positives.setdefault(r.anchor, []).append((r.vec_id, r.score))
        # The least whole number that is at least ``percent`` per cent of the positive's score.
        asked = [{**a, "ranges": [(-(-percent * s // 100), s) for _, s in positives.get(a["anchor"], [])]} for a in block]
        named = [(a, i, p, s) for a, found in positives.items() for i, (p, s) in enumerate(found)]
        known = spark.createDataFrame(named, "anchor long, place long, positive_id long, positive_score long")
        negatives = _pass(rows, asked, False, k).join(known, ["anchor", "place"])
        negatives.select(
            F.col("anchor").alias("anchor_id"),
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ).write.parquet(f"{base}/pass={part}")
    return spark.read.schema(schema).parquet(*[f"{base}/pass={part}" for part in range(parts)])


def changed_labels(vectors: DataFrame) -> DataFrame:
    """Rows with ids divisible by 7 take the next label of ten; the columns ``(vec_id, embedding, label)``."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return vectors.select("vec_id", "embedding", moved.alias("label"))


#: Over whole tables with unique ids and vectors of one length.
SQL = f"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), products AS (
  SELECT a.vec_id AS anchor, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT * FROM products WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= {K}
)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
  row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other)::INT AS rank,
  n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN products n ON n.anchor = p.anchor AND NOT n.same
  AND {LEAST_PERCENT} * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= {K}
"""
