"""Exact top-k cosine neighbours of every vector, without forming or shuffling pairs.

1. Copies of a vector are merged into one *class* that remembers its k + 1 smallest ids, the only ones that can appear
   in a result. A group of copies, however large, therefore costs one row.
2. Classes are numbered by their smallest id and cut into groups of stretches, both of a bounded size in bytes. A task gets
   two groups and compares them once for both sides. It holds one of them as it travelled, packed and compressed, and unpacks
   a stretch of the other and a few packs of this one at a time. Nothing passes through the driver.
3. Products are taken in single precision first. Their rounding error has a proven bound, so those that cannot reach a
   list are certain to be out; the few others are taken again in double precision, which alone decides.
4. A task returns the best few of each of its classes, and these short lists are merged per class. Vectors and lists travel once
   per group, not per stretch.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.vectors import as_doubles, common_size, norm
from tokenloom.operators.ordering import global_index
from tokenloom.session import materialise

# Scores are ranked by their tenth decimal, so that rounding in the last bit cannot swap neighbours.
_RANK_DECIMALS = 10
_BEYOND = 1.1 * 10.0**-_RANK_DECIMALS
# Vectors on either side of one matrix product, and vectors that travel as one row.
_ROWS = 512
_COLUMNS = 2048
_PACK = 1024
# Packs that are unpacked together, and stretches of a group.
_TOGETHER = 8
_GROUP = 8
# Above this share of a tile, products are taken anew as a whole instead of one by one.
_DENSE = 1 / 16


def top_similar(vectors: DataFrame, key: str, vector: str, k: int, chunk_bytes: int = 16 << 20) -> DataFrame:
    """The ``k`` nearest other tokens of each: ``(key, rank, similar, score)``, ranks from 1.

    Ties go to the smaller id. A zero vector, and one with a component that is no finite number, has the score NaN with
    every other, which ranks last. Null vectors, null components and unequal lengths raise. ``chunk_bytes`` bounds a
    stretch; a task holds one of them and, packed, a group of eight.
    """
    rows = vectors.select(F.col(key).alias("id"), as_doubles(F.col(vector)).alias("v"))
    rows = materialise(rows.select("id", "v", norm(F.col("v")).alias("norm")))
    size = common_size(rows, "v")
    # NaN counts as greater than every number.
    defined = (F.col("norm") > 0) & (F.col("norm") < float("inf"))
    stats = rows.agg(F.count_if(defined).alias("nonzero"), F.count_if(~defined).alias("zero")).first()
    zero = rows.filter(~defined).select("id")
    nonzero = rows.filter(defined)
    classes = global_index(_classes(nonzero, k), "rep", name="place")
    n = classes.count()
    nearest = _nearest_classes(classes, n, k, size, chunk_bytes, "v", "norm")

    if n == stats.nonzero and (n > k or not stats.zero):
        # Every class is one vector, so its best classes are the answer; none is so short that undefined scores fill it up.
        others = F.slice(F.filter("best", lambda c: c["other"] != F.col("place")), 1, k)
        ranked = nearest.select(F.col("rep").alias(key), F.posexplode(others).alias("at", "c"))
        named = classes.select(F.col("place").alias("other"), F.col("rep").alias("similar"))
        found = ranked.select(key, (F.col("at") + 1).alias("rank"), "c.other", "c.score").join(named, "other")
        found = found.select(key, "rank", "similar", "score")
        if not stats.zero:
            return found
        return found.unionByName(_ranked(zero.select("id", _undefined(_smallest_ids(rows, k + 1), rows).alias("list")), key, k))

    # Every vector takes its class's list. The few smallest ids fill up behind it with undefined scores.
    members = nonzero.select("id", "v").join(classes.select("v", "place"), "v").select("id", "place")
    listed = members.join(_candidate_lists(nearest, classes, k), "place")
    fill = _smallest_ids(zero, k + 1)
    everyone = _smallest_ids(rows, k + 1)
    done = listed.select("id", F.concat("list", _undefined(fill, rows)).alias("list")).unionByName(
        zero.select("id", _undefined(everyone, rows).alias("list"))
    )
    return _ranked(done, key, k)


def _ranked(done: DataFrame, key: str, k: int) -> DataFrame:
    """The first ``k`` others of each list ``(id, list)``, as they are returned."""
    others = F.slice(F.filter("list", lambda c: c["id"] != F.col("id")), 1, k)
    ranked = done.select("id", F.posexplode(others).alias("place", "c"))
    return ranked.select(
        F.col("id").alias(key),
        (F.col("place") + 1).alias("rank"),
        F.col("c.id").alias("similar"),
        F.col("c.score").alias("score"),
    )


def _smallest_ids(ids: DataFrame, n: int) -> list:
    return [row.id for row in ids.select("id").orderBy("id").limit(n).collect()]


def _undefined(ids: list, rows: DataFrame) -> Column:
    kind = f"array<struct<id:{rows.schema['id'].dataType.simpleString()},score:double>>"
    nan = F.lit(float("nan"))
    return F.array(*[F.struct(F.lit(i).alias("id"), nan.alias("score")) for i in ids]).cast(kind)


def _classes(nonzero: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: ``(v, norm, rep, ids)``, ``ids`` being its k + 1 smallest ids."""
    # Spark prunes row_number() <= n before the shuffle, so no task receives a whole group of copies.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = nonzero.withColumn("place", place).filter(F.col("place") <= k + 1)
    grouped = few.groupBy("v", "norm").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return grouped.select("v", "norm", F.element_at("ids", 1).alias("rep"), "ids")


def _layout(n: int, size: int, cores: int, chunk_bytes: int) -> tuple[int, int, int]:
    """How many groups ``n`` classes are cut into, by size and so that every core has a few pairs of them; and the classes of
    a group and of a stretch."""
    width = 8 * max(1, size)
    by_size = -(-width * n // (_GROUP * chunk_bytes))
    by_cores = min(math.isqrt(6 * cores) + 1, -(-n // _COLUMNS))
    groups = max(1, by_size, by_cores)
    in_group = max(1, -(-n // groups))
    return groups, in_group, -(-in_group // -(-in_group * width // chunk_bytes))


def _nearest_classes(
    classes: DataFrame, n: int, k: int, size: int, chunk_bytes: int, vector: str = "unit", norm: str | None = None
) -> DataFrame:
    """The k + 1 best classes of each, itself among the equals: ``(place, rep, best ARRAY<STRUCT<other, score>>)``.

    ``vector`` divided by ``norm`` is of length 1; with no ``norm``, it is so by itself.
    """
    cores = classes.sparkSession.sparkContext.defaultParallelism
    groups, in_group, in_stretch = _layout(n, size, cores, chunk_bytes)
    pack = min(_PACK, in_stretch)
    # A pack lies in one stretch and is known by its first place.
    within = F.pmod("place", F.lit(in_group))
    low = F.col("place") - F.pmod(F.pmod(within, F.lit(in_stretch)), F.lit(pack))
    length = F.lit(1.0) if norm is None else F.col(norm)
    numbered = classes.select(low.alias("low"), "place", F.col(vector).alias("v"), length.alias("norm"))
    keyed = numbered.repartition("low").sortWithinPartitions("low", "place").select("low", "v", "norm")
    packed = keyed.mapInArrow(_pack, "low long, vectors binary, norms binary")
    group = F.floor(F.col("low") / in_group).cast("int")
    stretch = F.floor((F.col("low") - group * in_group) / in_stretch).cast("int")
    placed = packed.select(group.alias("group"), stretch.alias("stretch"), "low", "vectors", "norms")
    # The pair of groups i <= j is number i + j (j + 1) / 2, so every group goes to ``groups`` pairs.
    every = F.sequence(F.lit(0), F.lit(groups - 1))

    def pair(other: Column) -> Column:
        first, last = F.least("group", other), F.greatest("group", other)
        number = first + F.floor(last * (last + 1) / 2)
        return F.struct(number.cast("int").alias("pair"), (F.col("group") == last).alias("late"))

    dealt = placed.select("stretch", "low", "vectors", "norms", F.inline(F.transform(every, pair)))
    dealt = dealt.repartitionById(groups * (groups + 1) // 2, "pair").sortWithinPartitions("pair", F.desc("late"), "low")
    lists = "place long, others array<bigint>, scores array<double>"
    found = dealt.mapInArrow(_compare_pairs(k + 1, size), lists)
    merged = found.repartition("place").sortWithinPartitions("place").mapInArrow(_merge(k + 1), lists)
    pairs = F.arrays_zip(F.col("others").alias("other"), F.col("scores").alias("score"))
    return classes.select("place", "rep").join(merged.select("place", pairs.alias("best")), "place")


def _candidate_lists(nearest: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """Each class's k + 1 best ids, its own included: ``(place, list ARRAY<STRUCT<id, score>>)``."""
    members = classes.select(F.col("place").alias("other"), "ids")
    near = nearest.select("place", F.inline("best"))
    ids = near.join(members, "other").select("place", "score", F.explode("ids").alias("id"))
    # At most (k + 1)² short entries per class.
    entry = F.struct((-F.round("score", _RANK_DECIMALS)).alias("order"), F.col("id"), F.col("score"))
    lists = ids.groupBy("place").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k + 1).alias("sorted"))
    short = F.transform("sorted", lambda c: F.struct(c["id"].alias("id"), c["score"].alias("score")))
    return lists.select("place", short.alias("list"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows ``(low, v, norm)`` of a pack as one row, its vectors compressed byte by byte of their doubles."""
    held: list[pa.RecordBatch] = []

    def packed() -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        vectors = whole.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        squeezed = pa.compress(vectors.view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)
        norms = whole.column("norm").to_numpy().tobytes()
        cells = [pa.array([squeezed], pa.binary()), pa.array([norms], pa.binary())]
        return pa.RecordBatch.from_arrays([whole.column("low")[:1].combine_chunks(), *cells], names=["low", "vectors", "norms"])

    for batch in batches:
        if not len(batch):
            continue
        lows = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(lows[1:] != lows[:-1]) + 1).tolist(), len(batch)]
        for low, high in zip(cuts, cuts[1:]):
            part = batch.slice(low, high - low)
            if held and held[0].column(0)[0] != part.column(0)[0]:
                yield packed()
                held = []
            held.append(part)
    if held:
        yield packed()


def _unpacked(packs: list[tuple[bytes, bytes]], size: int) -> np.ndarray:
    """The unit vectors of packs ``(vectors, norms)``, one under the other."""
    parts = []
    for vectors, norms in packs:
        lengths = np.frombuffer(norms, np.float64)
        raw = pa.decompress(vectors, 8 * size * len(lengths), codec="zstd", asbytes=True)
        parts.append(np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view(np.float64).reshape(-1, size) / lengths[:, None])
    return np.concatenate(parts)


def _best_rows(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the ``n`` best columns of each row; equal scores go to the earlier column."""
    width = scores.shape[1]
    if width > n:
        least = np.partition(scores, width - n, axis=1)[:, width - n, None]
        row, col = np.nonzero(scores >= least)
    else:
        row, col = np.nonzero(np.ones_like(scores, dtype=bool))
    order = np.lexsort((col, -scores[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < n], col[place < n]


class _Best:
    """The ``n`` best partners of every vector of a stretch, best first; equal scores go to the smaller place."""

    def __init__(self, rows: int, n: int):
        self.n = n
        self.others = np.full((rows, n), np.iinfo(np.int64).max)
        self.scores = np.full((rows, n), -np.inf)
        # Products below this cannot enter the list of a row.
        self.floors = np.full(rows, -np.inf)

    def add(self, rows: np.ndarray, others: np.ndarray, scores: np.ndarray) -> None:
        touched, at = np.unique(rows, return_inverse=True)
        owner = np.concatenate((np.repeat(np.arange(len(touched)), self.n), at))
        found = np.concatenate((self.others[touched].ravel(), others))
        values = np.concatenate((self.scores[touched].ravel(), scores))
        order = np.lexsort((found, -np.round(values, _RANK_DECIMALS), owner))
        owner = owner[order]
        kept = order[np.arange(len(owner)) - np.searchsorted(owner, owner) < self.n]
        self.others[touched], self.scores[touched] = found[kept].reshape(-1, self.n), values[kept].reshape(-1, self.n)
        self.raise_floors(touched, self.scores[touched, -1])

    def raise_floors(self, rows: np.ndarray | slice, least: np.ndarray) -> None:
        self.floors[rows] = np.maximum(self.floors[rows], least - _BEYOND)

    def settle(self, own: np.ndarray, others: np.ndarray, low: int) -> None:
        """Take the scores of the lists once more, as they are returned; of partners in ``others`` only."""
        row, place = np.nonzero((self.others >= low) & (self.others < low + len(others)))
        self.scores[row, place] = _chained(own, row, others, self.others[row, place] - low)

    def lists(self, low: int) -> pa.RecordBatch:
        real = self.scores > -np.inf
        some = np.flatnonzero(real.any(1))
        offsets = np.concatenate(([0], np.cumsum(real[some].sum(1)))).astype(np.int32)
        columns = [pa.ListArray.from_arrays(offsets, values[real]) for values in (self.others, self.scores)]
        return pa.RecordBatch.from_arrays([pa.array(low + some), *columns], names=["place", "others", "scores"])


def _set(mask: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` for few set places: eight of them are looked at together."""
    if mask.size % 8:
        return np.flatnonzero(mask)
    words = np.flatnonzero(mask.reshape(-1).view(np.uint64))
    near = (words[:, None] * 8 + np.arange(8)).ravel()
    return near[mask.reshape(-1)[near]]


def _rounding(size: int) -> float:
    """How far a single-precision product of two unit vectors can be from the true one.

    Components and partial sums are rounded by at most 2**-24 of themselves, size + 2 times on the way of any term, and the
    sum of the terms' sizes is at most 1. One more covers units that are not quite so long and the double's own rounding.
    """
    roundings = (size + 3) * 2.0**-24
    return roundings / (1 - roundings)


def _products(a: np.ndarray, rows: np.ndarray, b: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Double-precision products of pairs of rows, a few megabytes at a time."""
    step = max(1, (1 << 19) // a.shape[1])
    parts = [np.einsum("ij,ij->i", a[rows[i : i + step]], b[columns[i : i + step]]) for i in range(0, len(rows), step)]
    return np.concatenate(parts) if parts else np.empty(0)


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Doubles as sums of two of 26 bits, whose products are exact (Veltkamp)."""
    scaled = x * 134217729.0
    high = scaled - (scaled - x)
    return high, x - high


def _chained(a: np.ndarray, rows: np.ndarray, b: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Products as a chain of fused multiply-adds in the order of components: the same on every machine.

    The exact product of two components and its exact sum with what came before are each held in two doubles (Dekker,
    Knuth), which are rounded to one.
    """
    out = np.zeros(len(rows))
    step = max(1, (1 << 19) // a.shape[1])
    for i in range(0, len(rows), step):
        x, y = a[rows[i : i + step]].T.copy(), b[columns[i : i + step]].T.copy()
        total = out[i : i + step]
        for p, q in zip(x, y):
            product = p * q
            (p_high, p_low), (q_high, q_low) = _halves(p), _halves(q)
            rest = ((p_high * q_high - product) + p_high * q_low + p_low * q_high) + p_low * q_low
            added = total + product
            part = added - total
            rest += (total - (added - part)) + (product - part)
            total[:] = added + rest
    return out


def _meet(best: _Best, a: np.ndarray, rounded: np.ndarray, low_a: int, best_other: _Best | None, other: np.ndarray, low_other: int) -> None:
    """Enter the unit vectors ``other`` into the lists of ``a`` and, if these are given, ``a`` into the lists of ``other``.

    ``rounded`` is ``a`` in single precision.
    """
    other_rounded = other.astype(np.float32).T.copy()
    n, margin = best.n, _rounding(a.shape[1])
    for i in range(0, len(a), _ROWS):
        for j in range(0, len(other), _COLUMNS):
            products = rounded[i : i + _ROWS] @ other_rounded[:, j : j + _COLUMNS]
            sides = [(best, slice(i, i + _ROWS), products)]
            if best_other is not None:
                sides.append((best_other, slice(j, j + _COLUMNS), products.T))
            reach = None
            for side, at, seen in sides:
                if np.isneginf(side.floors[at][0]) and seen.shape[1] >= n:
                    # The n-th best so far in single precision, less its error, bounds the n-th best from below.
                    side.raise_floors(at, np.partition(seen, seen.shape[1] - n, axis=1)[:, seen.shape[1] - n] - margin)
                # Rounded down, so that single precision compares on the safe side.
                floors = np.nextafter((side.floors[at] - margin).astype(np.float32), np.float32(-np.inf))
                over = products >= (floors[:, None] if side is best else floors[None, :])
                reach = over if reach is None else np.logical_or(reach, over, out=reach)
            found = _set(reach)
            if not found.size:
                continue
            if found.size > _DENSE * products.size + 4 * n * sum(products.shape):
                keys = np.round(a[i : i + _ROWS] @ other[j : j + _COLUMNS].T, _RANK_DECIMALS)
                row, col = _best_rows(keys, n)
                best.add(i + row, low_other + j + col, _products(a, i + row, other, j + col))
                if best_other is not None:
                    col, row = _best_rows(keys.T, n)
                    best_other.add(j + col, low_a + i + row, _products(a, i + row, other, j + col))
                continue
            row, col = np.divmod(found, products.shape[1])
            exact = _products(a, i + row, other, j + col)
            taken = exact >= best.floors[i + row]
            best.add(i + row[taken], low_other + j + col[taken], exact[taken])
            if best_other is not None:
                taken = exact >= best_other.floors[j + col]
                best_other.add(j + col[taken], low_a + i + row[taken], exact[taken])
    best.settle(a, other, low_other)
    if best_other is not None:
        best_other.settle(other, a, low_a)


def _compare(a: np.ndarray, low_a: int, b: np.ndarray | None, low_b: int, n: int) -> Iterator[tuple[int, _Best]]:
    """The best of the unit vectors ``a`` among ``b`` and of ``b`` among ``a``; without ``b``, of ``a`` among themselves."""
    best, best_other = _Best(len(a), n), None if b is None else _Best(len(b), n)
    _meet(best, a, a.astype(np.float32), low_a, best_other, a if b is None else b, low_a if b is None else low_b)
    yield low_a, best
    if best_other is not None:
        yield low_b, best_other


class _Packs:
    """A few packs of a stretch as they travel, and the lists of their vectors."""

    def __init__(self, stretch: int, low: int):
        self.stretch, self.low = stretch, low
        self.packs: list[tuple[bytes, bytes]] = []
        self.best: _Best | None = None

    @staticmethod
    def grow(held: list[_Packs], stretch: int, low: int, pack: tuple[bytes, bytes]) -> None:
        if not held or held[-1].stretch != stretch or len(held[-1].packs) >= _TOGETHER:
            held.append(_Packs(stretch, low))
        held[-1].packs.append(pack)


def _compare_pairs(n: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs ``(stretch, low, vectors, norms, pair, late)``, in order of pair and the late group first, to lists of both groups."""

    def compared(stretch: list[_Packs], group: list[_Packs], same: bool) -> pa.RecordBatch:
        """The lists of a stretch among a group, whose own lists get the stretch's vectors.

        Within the ``same`` group, pairs of stretches are looked at once, and a stretch also among itself.
        """
        a = _unpacked([pack for few in stretch for pack in few.packs], size)
        rounded, low, best = a.astype(np.float32), stretch[0].low, _Best(len(a), n)
        for few in group:
            if same and few.stretch < stretch[0].stretch:
                continue
            other = _unpacked(few.packs, size)
            if same and few.stretch == stretch[0].stretch:
                _meet(best, a, rounded, low, None, other, few.low)
                continue
            few.best = few.best or _Best(len(other), n)
            _meet(best, a, rounded, low, few.best, other, few.low)
        return best.lists(low)

    def rest(stretch: list[_Packs], group: list[_Packs]) -> Iterator[pa.RecordBatch]:
        """What is left at the end of a pair: its last stretch, or all of them if it is one group with itself."""
        if stretch:
            yield compared(stretch, group, False)
        else:
            for number in dict.fromkeys(few.stretch for few in group):
                yield compared([few for few in group if few.stretch == number], group, True)
        for few in group:
            if few.best is not None:
                yield few.best.lists(few.low)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[_Packs] = []
        stretch: list[_Packs] = []
        current = None
        for batch in batches:
            for number, low, vectors, norms, pair, late in zip(*(c.to_pylist() for c in batch.columns)):
                if pair != current:
                    if group:
                        yield from rest(stretch, group)
                    group, stretch, current = [], [], pair
                if not late and stretch and stretch[0].stretch != number:
                    yield compared(stretch, group, False)
                    stretch = []
                _Packs.grow(group if late else stretch, number, low, (vectors, norms))
        if group:
            yield from rest(stretch, group)

    return compare


def _merge(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(place, others, scores)`` in order of place to one row per place with its ``n`` best."""

    def merged(table: pa.Table) -> pa.RecordBatch:
        places = table.column(0).to_numpy()
        others, scores = (table.column(i).combine_chunks() for i in (1, 2))
        owner = np.repeat(places, np.diff(others.offsets.to_numpy()))
        found, values = others.flatten().to_numpy(), scores.flatten().to_numpy()
        order = np.lexsort((found, -np.round(values, _RANK_DECIMALS), owner))
        owner = owner[order]
        kept = np.arange(len(owner)) - np.searchsorted(owner, owner) < n
        owner, order = owner[kept], order[kept]
        distinct, starts = np.unique(owner, return_index=True)
        offsets = np.append(starts, len(owner)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(offsets, values_[order]) for values_ in (found, values)]
        return pa.RecordBatch.from_arrays([pa.array(distinct), *lists], names=["place", "others", "scores"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            # The last place of a batch may go on in the next one.
            cut = int(np.searchsorted(batch.column(0).to_numpy(), batch.column(0)[-1].as_py()))
            if cut:
                yield merged(pa.Table.from_batches([*rest, batch.slice(0, cut)]))
                rest = []
            rest.append(batch.slice(cut))
        if rest:
            yield merged(pa.Table.from_batches(rest))

    return merge
