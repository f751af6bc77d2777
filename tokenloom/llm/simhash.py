"""Near-duplicate documents by SimHash fingerprints compared bit-sliced.

Fingerprints are taken in the row. Equal ones become one, so copies cost nothing further. Two fingerprints within
``radius`` bits agree on at least ``BLOCKS - radius`` of ``BLOCKS`` blocks of bits, so every choice of that many blocks
is a bucket key and no link is lost. Buckets above ``TILE`` rows are cut into tiles and every two tiles meet, so no task
holds a large bucket. In a bucket the fingerprints lie as bit planes: word ``w`` of plane ``p`` has bit ``p`` of 64
fingerprints. A shift of the planes by ``d`` lanes pairs every fingerprint with its ``d``-th follower; the differing
planes are added up by carry-save counters, and the shift is given up as soon as every lane is beyond the radius.
A bucket gives a spanning forest of its links, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import components, fresh, utf8
from tokenloom.session import materialise

SHINGLE = 4
RADIUS = 4
BLOCKS = 6
TILE = 4096
_SEED = 42


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half the shingle hashes, repeats included; no words give zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[-n:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 65536):
        spans = zip(starts[i : min(n, i + 65536)].tolist(), last[i : i + 65536].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], _SEED) for a, b in spans], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, shingle) for t in utf8(texts)], np.uint64).view(np.int64))

    return of(text)


def _planes(values: np.ndarray) -> np.ndarray:
    """64 rows of ``len / 64`` words: row ``p`` holds bit ``p`` of every value."""
    padded = np.zeros(-(-len(values) // 64) * 64, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _shift(planes: np.ndarray, lanes: int) -> np.ndarray:
    """Lane ``i`` of the result is lane ``i + lanes``; the end is cut by whole words."""
    words, bits = divmod(lanes, 64)
    out = planes[:, words:] >> np.uint64(bits)
    if bits:
        out[:, :-1] |= planes[:, words + 1 :] << np.uint64(64 - bits)
    return out


def _beyond(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count exceeds ``radius`` (at most 7)."""
    above, equal = over.copy(), ~over
    for plane, bit in ((fours, radius & 4), (twos, radius & 2), (ones, radius & 1)):
        if bit:
            equal &= plane
        else:
            above |= equal & plane
            equal &= ~plane
    return above


def lanes_within(planes: np.ndarray, lag: int, active: np.ndarray, radius: int) -> np.ndarray:
    """Of the active lanes ``i``, those whose value differs from that of lane ``i + lag`` by at most ``radius`` bits."""
    width = planes.shape[1] - lag // 64
    ones, twos, fours, over = (np.zeros(width, np.uint64) for _ in range(4))
    wanted = np.packbits(active, bitorder="little").view(np.uint64)[:width]
    for top in range(0, 64, 16):
        rows = planes[top : top + 16]
        for differ in rows[:, :width] ^ _shift(rows, lag):
            carry = ones & differ
            ones ^= differ
            more = twos & carry
            twos ^= carry
            over |= fours & more
            fours ^= more
        alive = wanted & ~_beyond(ones, twos, fours, over, radius)
        if not alive.any():
            return np.empty(0, np.int64)
    return np.flatnonzero(np.unpackbits(alive.view(np.uint8), bitorder="little"))


def forest(groups: np.ndarray, values: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For rows sorted by group, the first row that each is linked to, directly or through others of its group."""
    n = len(groups)
    parent = np.arange(n)
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    sizes = np.diff(np.append(first, n))
    size = np.repeat(sizes, sizes)
    lag, rows = 1, np.flatnonzero(size > 1)
    while rows.size:
        planes, group = _planes(values[rows]), groups[rows]
        lanes = planes.shape[1] * 64
        while lag < rows.size and 2 * np.count_nonzero(size[rows] > lag) >= rows.size:
            active = np.zeros(lanes, bool)
            active[: rows.size - lag] = group[lag:] == group[:-lag]
            found = lanes_within(planes, lag, active, radius)
            if found.size:
                parent = _unite(parent, rows[found], rows[found + lag])
            lag += 1
        rows = rows[size[rows] > lag]
    return parent


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return parent
        parent[np.maximum(a, b)[apart]] = np.minimum(a, b)[apart]
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up


def _bucket_keys(radius: int) -> list[tuple[int, int]]:
    """Masks of the block choices, numbered."""
    edges = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [(i, sum(chosen)) for i, chosen in enumerate(combinations(masks, BLOCKS - radius))]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(values: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(a, b)``: links that connect whatever the distinct fingerprints ``fp`` within ``radius`` bits connect."""
    if not 0 <= radius < BLOCKS:
        raise ValueError(f"radius must be below {BLOCKS}")
    choices = F.array(
        *[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in _bucket_keys(radius)]
    )
    keyed = values.select("fp", F.inline(choices))
    hot = keyed.groupBy("part", "key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")).filter("tiles > 1")
    tile = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    other = F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = keyed.join(hot, ["part", "key"], "left").select("*", F.coalesce(tile, F.lit(0)).alias("t"), other.alias("o"))
    cell = F.xxhash64("part", "key", F.least("t", "o"), F.greatest("t", "o"))
    # Two cells with an equal hash only meet needlessly: every link is checked on all bits.
    rows = tiled.select(cell.alias("cell"), "fp").repartition("cell").sortWithinPartitions("cell", "fp")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 2

        def edges(cells: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            to = fps[forest(cells, fps.view(np.uint64), radius)]
            return pa.RecordBatch.from_arrays([pa.array(x[to != fps]) for x in (fps, to)], names=["a", "b"])

        for batch in batches:
            cells, fps = (np.concatenate((h, c.to_numpy())) for h, c in zip(held, batch.columns, strict=True))
            cut = int(np.searchsorted(cells, cells[-1])) if len(cells) else 0
            held = [cells[cut:], fps[cut:]]
            if cut:
                yield edges(cells[:cut], fps[:cut])
        if len(held[0]):
            yield edges(*held)

    return rows.mapInArrow(linked, "a long, b long").distinct()


def groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, text_hash, fp, component)`` of every row of ``docs(doc_id, text)``, written to the shared folder.

    ``component`` is ``(missing, doc_id, text_hash)`` of the first row, by these, of all rows that links reach. Null and
    empty texts have fingerprint zero and are linked like any other; a null id comes after all others; repeated rows
    and rows with equal ids stay rows of their own; an empty table gives an empty one.
    """
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = materialise(docs.select("doc_id", hashed.alias("text_hash"), fingerprints(F.col("text"), shingle).alias("fp")))
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")
    classes = rows.groupBy("fp").agg(F.min(order).alias("first"))
    label = components(links(classes.select("fp"), radius)).withColumnRenamed("node", "fp")
    labelled = classes.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    labelled = materialise(labelled)
    least = labelled.groupBy("label").agg(F.min("first").alias("component"))
    # One row per fingerprint against many: skewed partitions of a plain join are split at run time.
    return rows.join(labelled.join(least, "label").select("fp", "component"), "fp")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row; see :func:`groups`."""
    found = groups(docs.select("doc_id", "text"), shingle, radius)
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", text.alias("fingerprint"), F.col("component.doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that are first in their group, with all columns; of repeated rows one stays.

    First is the smallest id, then the text hash. Rows that share both count as repeats of each other.
    """
    found = materialise(groups(docs.select("doc_id", "text"), shingle, radius).select("doc_id", "text_hash", "component"))
    firsts = found.select("component.doc_id", "component.text_hash").distinct()
    many = found.groupBy("doc_id", "text_hash").count().filter("count > 1").drop("count")
    id_, hash_ = fresh(docs, "kept_id"), fresh(docs, "kept_hash")

    def named(keys: DataFrame) -> DataFrame:
        return keys.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_))

    hashed = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    once = firsts.join(many, [firsts["doc_id"].eqNullSafe(many["doc_id"]), firsts["text_hash"] == many["text_hash"]], "left_anti")
    twice = firsts.join(many, [firsts["doc_id"].eqNullSafe(many["doc_id"]), firsts["text_hash"] == many["text_hash"]], "left_semi")

    def matching(keys: DataFrame) -> DataFrame:
        kept = named(keys)
        return docs.join(kept, [docs["doc_id"].eqNullSafe(kept[id_]), hashed == kept[hash_]], "left_semi")

    repeated = matching(twice)
    return matching(once).unionByName(repeated.dropDuplicates(["doc_id", "text"]))
