"""Exact top-k inner products by multi-resolution segment statistics.

Over a segment of the dimensions two vectors' product is at most that of their means plus that of their deviations
(Cauchy-Schwarz), so ``|q|^2 + |x|^2`` less twice the sum over segments is a lower bound of their squared distance. The
statistics of few long segments are tried first, those of more and shorter ones on what is left, and exact products are
taken of the survivors only. Every task keeps the best few of each query; these are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 5
EVERY = 50
SEGMENTS = (1, 4, 16)
#: Bytes of query vectors in one pass over the candidates; more queries take more passes.
PASS_BYTES = 16 << 20
_CELLS = 1 << 22
_EXACT = float(1 << 53)
_SLACK = 1e-9


def quantised(values: np.ndarray) -> np.ndarray:
    return np.floor(256.0 * values.astype(np.float64))


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per vector: scaled segment means, then segment deviations; products of these rows bound inner products."""
    edges = np.unique(np.linspace(0, x.shape[1], segments + 1).astype(int))
    starts, sizes = edges[:-1], np.diff(edges)
    means = np.add.reduceat(x, starts, axis=1) / np.sqrt(sizes)
    squares = np.add.reduceat(x * x, starts, axis=1)
    return np.hstack((means, np.sqrt(np.maximum(squares - means * means, 0.0))))


class Best:
    """The best ``k`` (score, id) of every query so far, over vectors of one length."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.zeros((len(ids), k), np.int64)
        self.norms = np.sqrt((queries * queries).sum(1))
        self.levels = [statistics(queries, s) for s in SEGMENTS if s < queries.shape[1]]
        self.exact: dict[tuple[int, int], int] = {}

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        # The first few fill the lists, so that later bounds have something to beat.
        step, at = 64, 0
        most = max(64, _CELLS // max(1, len(self.ids)))
        while at < len(ids):
            self._add(ids[at : at + step], vectors[at : at + step])
            at, step = at + step, min(4 * step, most)

    def _add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        norms = np.sqrt((vectors * vectors).sum(1))
        least = self.scores[:, -1]
        rows, cols = np.arange(len(self.ids)), np.arange(len(ids))
        for level, queries in zip((s for s in SEGMENTS if s < vectors.shape[1]), self.levels, strict=True):
            bound = queries[rows] @ statistics(vectors[cols], level).T
            slack = _SLACK * np.outer(self.norms[rows], norms[cols]) + _SLACK
            open_ = bound + slack >= least[rows, None]
            rows, cols = rows[open_.any(1)], cols[open_.any(0)]
            if not rows.size or not cols.size:
                return
        products = self.queries[rows] @ vectors[cols].T
        huge = np.outer(self.norms[rows], norms[cols]) >= _EXACT
        if huge.any():
            # Beyond the whole numbers that a double holds: Python's own, cut to a long.
            for i, j in zip(*np.nonzero(huge), strict=True):
                whole = sum(int(a) * int(b) for a, b in zip(self.queries[rows[i]], vectors[cols[j]], strict=True))
                products[i, j] = min(max(whole, -(1 << 63)), (1 << 63) - 1)
                self.exact[int(self.ids[rows[i]]), int(ids[cols[j]])] = min(max(whole, -(1 << 63)), (1 << 63) - 1)
        other = self.ids[rows, None] != ids[None, cols]
        i, j = np.nonzero((products >= least[rows, None]) & other)
        if not i.size:
            return
        touched = np.unique(rows[i])
        query = np.concatenate((np.repeat(touched, self.k), rows[i]))
        score = np.concatenate((self.scores[touched].ravel(), products[i, j]))
        found = np.concatenate((self.found[touched].ravel(), ids[cols[j]]))
        order = np.lexsort((found, -score, query))
        query, score, found = query[order], score[order], found[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        self.scores[query[kept], place[kept]] = score[kept]
        self.found[query[kept], place[kept]] = found[kept]

    def rows(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        i, j = np.nonzero(self.scores > -np.inf)
        ids, found = self.ids[i], self.found[i, j]
        scores = self.scores[i, j]
        if not self.exact:
            return ids, found, scores.astype(np.int64).tolist()
        get = self.exact.get
        return ids, found, [get((int(a), int(b)), int(s) if abs(s) < 2**63 else 0) for a, b, s in zip(ids, found, scores, strict=True)]


def _by_length(ids: np.ndarray, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and quantised matrices of rows of equal length."""
    offsets = vectors.offsets.to_numpy()
    sizes, flat = np.diff(offsets), vectors.values.to_numpy(zero_copy_only=False)
    for n in np.unique(sizes):
        rows = np.flatnonzero(sizes == n)
        at = offsets[:-1][rows, None] + np.arange(n)
        yield ids[rows], quantised(flat[at])


def top_products(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for queries whose id is divisible by ``every``, over all other rows.

    Components become ``floor(256 x)``; the score is their inner product, cut to the range of a long. Ties go to the
    smaller id. Rows without an id, and vectors that are null or hold null or non-finite components, take no part;
    vectors meet only vectors of their own length. Of queries with equal ids the least vector asks; candidates with
    equal ids are rows of their own, unless the id is the query's. An empty table gives an empty one.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    usable = usable.filter(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
    queries = usable.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    bytes_ = queries.agg(F.sum(8 * F.size("embedding") + 8)).first()[0] or 0
    parts = 1 + int(bytes_ // PASS_BYTES)
    found = [_pass(usable, queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == i), k) for i in range(parts)]
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pass(usable: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best of every task for one bounded part of the queries."""
    asked = queries.toArrow().combine_chunks()
    blocks: list[tuple[np.ndarray, np.ndarray]] = []
    for chunk in asked.to_batches():
        blocks += _by_length(chunk.column(0).to_numpy(), chunk.column(1))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {q.shape[1]: Best(ids, q, k) for ids, q in blocks}
        for batch in batches:
            for ids, rows in _by_length(batch.column(0).to_numpy(), batch.column(1)):
                if rows.shape[1] in best:
                    best[rows.shape[1]].add(ids, rows)
        for b in best.values():
            query, found, score = b.rows()
            columns = [pa.array(query, pa.int64()), pa.array(found, pa.int64()), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    return usable.mapInArrow(search, "query_id long, vec_id long, score long")
