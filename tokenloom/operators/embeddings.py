"""Token vectors learnt from context windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.operators import grams

# One md5 digest block gives 13 hex digits = 52 sign bits that fit a BIGINT.
_BITS = 52
# Tokens whose neighbours are added up at a time, and the greatest distance at which a byte holds the sums of signs.
_SLICE_TOKENS = 1 << 19
# Pairs that are counted as numbers at a time.
_SLICE_PAIRS = 1 << 23
# Pairs by number that travel as tables of their keys, and those whose signs are added up at a time; stored bytes of text per bucket of keys.
_HELD_PAIRS = 1 << 22
_SUMMED_PAIRS = 1 << 14
_KEYS_BYTES = 32 << 20
_MOST_IN_BYTE = 63


def cooccurrence_counts(segments: DataFrame, distance: int, vocabulary: DataFrame | None = None) -> DataFrame:
    """How often two tokens stand at most ``distance`` apart: ``(word, context, n)``, both directions.

    Pairs are formed inside each segment and counted unordered, first as numbers in runs of segments. What differs within a run
    travels packed, a table to a bucket of pairs; the two directions are mirrored after the only shuffle. ``vocabulary`` (column ``word``)
    restricts both sides of the counted pairs; if it also has ``token``, the result names words by these ids.
    """
    kind = segments.schema["tokens"].dataType.elementType
    fields = [T.StructField("a", kind), T.StructField("b", kind), T.StructField("n", T.LongType())]
    listed = segments.filter(F.col("tokens").isNotNull()).select("owned", "tokens")
    buckets = grams.buckets_of(listed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for owned, tokens in _runs(batches, _SLICE_PAIRS // max(1, distance)):
            words, ids, n = _pairs(owned, tokens, distance)
            yield from grams.deal([words], ids, n, _pair_homes(grams.token_hashes(words), ids), buckets)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tables in grams.by_bucket(batches):
            for words, ids, n in grams.whole(tables, buckets, _pair_homes):
                for some in grams.slices(len(n)):
                    sides = (words.take(pa.array(row[some])) for row in ids)
                    yield pa.RecordBatch.from_arrays([*sides, pa.array(n[some])], names=["a", "b", "n"])

    counts = grams.gathered(listed, count, buckets).mapInArrow(add, T.StructType(fields))
    if vocabulary is not None:
        counts = _restrict(counts, vocabulary)

    def directed(word: str, context: str, n: Column) -> Column:
        return F.struct(F.col(word).alias("word"), F.col(context).alias("context"), n.alias("n"))

    both = F.when(F.col("a") == F.col("b"), F.array(directed("a", "a", F.col("n") * 2))).otherwise(
        F.array(directed("a", "b", F.col("n")), directed("b", "a", F.col("n")))
    )
    return counts.select(F.inline(both))


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, pa.ListArray]]:
    """Rows ``(owned, tokens)`` in runs of about ``most`` tokens; a longer row is a run of its own."""
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(batch):
            so_far = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, so_far + most, "right")))
            part = batch.slice(at, to - at)
            yield part.column(0).to_numpy(), part.column(1)
            at = to


def _placed(owned: np.ndarray, tokens: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Per token of some segments, the number of its segment and whether the segment owns it."""
    sizes = np.diff(tokens.offsets.to_numpy())
    segment = np.repeat(np.arange(len(sizes)), sizes)
    return segment, np.arange(len(segment)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < np.repeat(owned, sizes)


def _pairs(owned: np.ndarray, tokens: pa.ListArray, distance: int) -> grams.Grams:
    """The distinct unordered pairs of some segments, the lesser token first, with their number: ``(words, ids, n)``.

    A pair belongs to the segment that owns its earlier token. Beside a null, the last of the words, a token pairs with itself.
    """
    coded = tokens.flatten().dictionary_encode()
    words = coded.dictionary.take(pc.sort_indices(coded.dictionary))
    ranks = np.empty(len(words) + 1, np.int64)
    ranks[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(words))
    ranks[-1] = -1
    ids = ranks[pc.fill_null(coded.indices, len(words)).to_numpy(zero_copy_only=False)]
    segment, own = _placed(owned, tokens)
    codes = []
    for d in range(1, min(distance, len(ids) - 1) + 1):
        pair = np.flatnonzero((segment[:-d] == segment[d:]) & own[:-d])
        x, y = ids[pair], ids[pair + d]
        x, y = np.where(x < 0, y, x), np.where(y < 0, x, y)
        codes.append((np.minimum(x, y) + 1) << 32 | (np.maximum(x, y) + 1))
    found, n = np.unique(np.concatenate(codes) if codes else np.empty(0, np.int64), return_counts=True)
    sides = np.stack([(found >> 32) - 1, (found & 0xFFFFFFFF) - 1])
    return pa.concat_arrays([words, pa.nulls(1, words.type)]), np.where(sides < 0, len(words), sides), n


def _counted_pairs(owned: np.ndarray, tokens: pa.ListArray, distance: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """:func:`_pairs` as words."""
    words, ids, n = _pairs(owned, tokens, distance)
    return *(words.take(pa.array(side)) for side in ids), pa.array(n, pa.int64())


def _pair_homes(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """What gives pairs their buckets: both tokens, so that a frequent one's pairs are in many."""
    return grams.mixed(hashes[ids[0]] + hashes[ids[1]])


def _restrict(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Pairs whose sides are both in the vocabulary, under its ids where it has any."""
    for side in ("a", "b"):
        if "token" in vocabulary.columns:
            known = vocabulary.select(F.col("word").alias(side), F.col("token").alias("id"))
            pairs = pairs.join(known, side).drop(side).withColumnRenamed("id", side)
        else:
            pairs = pairs.join(vocabulary.select(F.col("word").alias(side)), side, "left_semi")
    return pairs


def random_index(cooccurrence: DataFrame, size: int, key: str = "word") -> DataFrame:
    """Sum of the contexts' random ±1 vectors, weighted by count (random indexing): ``(key, vector ARRAY<BIGINT>)``.

    The signs of a context are bits of its md5, so vectors are integers that depend neither on order nor on a seed. Counted
    pairs travel, packed by bucket of their key, not sums: a task then holds the sums of the words of a bucket only.
    """
    kind = cooccurrence.schema[key].dataType
    listed = cooccurrence.select(key, F.col("context").cast("string"), F.coalesce(F.col("n").cast("long"), F.lit(0)).alias("n"))
    buckets = grams.buckets_of(listed, _KEYS_BYTES)

    def dealt(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        keys, of = grams.coded(table.column(0))
        contexts, by = grams.coded(table.column(1))
        order = np.argsort(of, kind="stable")
        ids = np.stack((of, by))[:, order]
        yield from grams.deal([keys, contexts], ids, table.column(2).to_numpy()[order], grams.token_hashes(keys)[ids[0]], buckets)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= _HELD_PAIRS:
                yield from dealt(held)
                held, rows = [], 0
        if rows:
            yield from dealt(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tables in grams.by_bucket(batches):
            keys, sums = _signed_sums((table for table, _ in tables), size)
            for some in grams.slices(len(keys)):
                part = sums[some]
                offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * size)
                vectors = pa.ListArray.from_arrays(offsets, pa.array(part.ravel()))
                yield pa.RecordBatch.from_arrays([keys[some.start : some.stop], vectors], names=[key, "vector"])

    fields = [T.StructField(key, kind), T.StructField("vector", T.ArrayType(T.LongType()))]
    return grams.gathered(listed, deal, buckets).mapInArrow(add, T.StructType(fields))


def _signed_sums(tables: Iterable[bytes], size: int) -> tuple[pa.Array, np.ndarray]:
    """The keys of a bucket's tables of pairs, sorted by key, and the sums of their contexts' signs by number; one table at a time."""
    held: list[tuple[pa.Array, np.ndarray]] = []
    for table in tables:
        (keys, contexts), (of, by), n = grams.unpack(table)
        signs = _sign_rows(contexts.to_pylist(), size)
        sums = np.zeros((len(keys), size), np.int64)
        for i in range(0, len(n), _SUMMED_PAIRS):
            rows = slice(i, i + _SUMMED_PAIRS)
            found, starts = np.unique(of[rows], return_index=True)
            sums[found] += np.add.reduceat(signs[by[rows]] * n[rows, None], starts, axis=0)
        held.append((keys, sums))
        if sum(len(some) for some, _ in held[1:]) > max(_SUMMED_PAIRS, len(held[0][0])):
            held = [_together(held)]
    return _together(held)


def _together(parts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
    """Sums by key as one: the keys of a part differ."""
    keys, at = grams.coded(pa.concat_arrays([some for some, _ in parts]))
    sums = np.zeros((len(keys), parts[0][1].shape[1]), np.int64)
    low = 0
    for some, part in parts:
        sums[at[low : low + len(some)]] += part
        low += len(some)
    return keys, sums


def _sign_rows(tokens: list, size: int) -> np.ndarray:
    """The random signs of tokens as rows of +1 and -1: as many bits of a token's md5 as there are dimensions, 52 to a block."""
    blocks = -(-size // _BITS)
    texts = [f"{b}" if t is None else f"{t}:{b}" for t in tokens for b in range(blocks)]
    digests = b"".join([hashlib.md5(text.encode()).digest()[:8] for text in texts])
    masks = (np.frombuffer(digests, ">u8") >> (64 - _BITS)).astype("<u8").view(np.uint8).reshape(len(tokens), blocks, 8)
    bits = np.unpackbits(masks, axis=2, bitorder="little")[:, :, :_BITS].reshape(len(tokens), blocks * _BITS)
    return bits[:, :size].astype(np.int8) * 2 - 1


def _neighbour_sums(owned: np.ndarray, tokens: pa.ListArray, distance: int, size: int) -> tuple[pa.Array, np.ndarray]:
    """Per distinct token of some segments that has neighbours, the sum of their signs over all its places.

    A pair of neighbours belongs to the segment that owns the earlier one. Sums at one place fit a byte.
    """
    coded = tokens.flatten().dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False)
    segment, own = _placed(owned, tokens)
    signs = _sign_rows(coded.dictionary.to_pylist(), size)[ids]
    near, count = np.zeros_like(signs), np.zeros(len(ids), np.int64)
    for d in range(1, distance + 1):
        if len(ids) <= d:
            break
        pair = (segment[:-d] == segment[d:]) & own[:-d]
        near[:-d] += signs[d:] * pair[:, None]
        near[d:] += signs[:-d] * pair[:, None]
        count[:-d] += pair
        count[d:] += pair
    places = np.flatnonzero(count)
    places = places[np.argsort(ids[places], kind="stable")]
    found, starts = np.unique(ids[places], return_index=True)
    sums = np.add.reduceat(near[places], starts, axis=0, dtype=np.int64) if len(places) else np.zeros((0, size), np.int64)
    return coded.dictionary.take(pa.array(found)), sums


def context_vectors(segments: DataFrame, distance: int, size: int, vocabulary: DataFrame | None = None) -> DataFrame:
    """The vectors of :func:`random_index` straight from the text: ``(word, vector ARRAY<BIGINT>)``.

    Vectors are sums over occurrences, so pairs are neither formed nor counted: in each batch of segments the signs of
    every place's neighbours are added up as bytes, then by token, in slices of bounded size. The only shuffle carries one row of
    sums per token and slice, summed up map-side first. ``vocabulary`` (column ``word``) restricts tokens and contexts, by
    way of counted pairs; so does a distance beyond what a byte holds.
    """
    if vocabulary is not None or distance > _MOST_IN_BYTE:
        known = None if vocabulary is None else vocabulary.select("word")
        return random_index(cooccurrence_counts(segments, distance, known), size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", *[f"v{d}" for d in range(size)]]
        for owned, tokens in _runs(batches, _SLICE_TOKENS):
            words, sums = _neighbour_sums(owned, tokens, distance, size)
            yield pa.RecordBatch.from_arrays([words, *(pa.array(column) for column in sums.T.copy())], names=names)

    kind = segments.schema["tokens"].dataType.elementType
    fields = [T.StructField("word", kind), *(T.StructField(f"v{d}", T.LongType()) for d in range(size))]
    rows = segments.filter(F.col("tokens").isNotNull()).select("owned", "tokens").mapInArrow(add, T.StructType(fields))
    sums = rows.groupBy("word").agg(*[F.sum(f"v{d}").alias(f"v{d}") for d in range(size)])
    return sums.select("word", F.array(*[F.col(f"v{d}") for d in range(size)]).alias("vector"))


def dedup_vectors(tagged: DataFrame, token: str = "token", role: str = "role", vector: str = "vector") -> DataFrame:
    """One vector per token: that of role ``input`` where there is one, else that of the first other role by name.

    Equal roles are settled by the smaller vector; a null or empty one is taken only where the role has no other, and a null
    role comes before names. All rows take part in an aggregate of one number per token, the least first component of its
    inputs, which Spark keeps in a hash table and reduces before the shuffle. Whole vectors are compared only among the rows
    that reach it, or where a token has no input.
    """
    is_input = F.coalesce(F.col(role) == "input", F.lit(False))
    head = F.get(F.col(vector), F.lit(0)).cast("double")
    rows = tagged.select(F.col(token).alias("t"), F.col(role).alias("r"), F.col(vector).alias("v"), is_input.alias("own"), head.alias("head"))
    inputs = rows.filter("own").groupBy("t").agg(F.min("head").alias("least"), F.count("*").alias("n"))
    inputs = inputs.withColumnRenamed("t", "u")
    joined = rows.join(inputs, F.col("t").eqNullSafe(F.col("u")), "left")
    reached = joined.filter(F.col("n").isNull() | (F.col("own") & F.col("head").eqNullSafe(F.col("least"))))
    order = F.struct("r", F.col("head").isNull().alias("none"), F.col("v").isNull().alias("null"), "v")
    best = reached.groupBy("t").agg(F.min(order).alias("best"))
    return best.select(F.col("t").alias(token), F.col("best.r").alias(role), F.col("best.v").alias(vector))
