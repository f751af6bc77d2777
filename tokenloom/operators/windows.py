"""Row-count sliding windows over token sequences.

A *segment* is one row holding a stretch of a sequence: ``(seq, start, owned, tokens)``. It owns the first ``owned``
positions; any tokens after them are a short look-ahead copied from the following segment. Windows and pairs are then
computed inside each row, so sliding costs no shuffle and no per-sequence task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.operators import grams

# Windows that are counted together before they travel.
_RUN = 1 << 20


def corpus_segments(docs: DataFrame, tokens: Column, key: str = "doc_id", block: int = 4096, ahead: int = 16) -> DataFrame:
    """Tokens in reading order, ``block`` of them to a segment with a look-ahead of ``ahead``.

    Windows, and pairs at a distance, must be shorter than the look-ahead. A very long document becomes many rows.
    """
    if ahead > block:
        raise ValueError("a block must be longer than its look-ahead")
    listed = docs.select(F.col(key).alias("seq"), tokens.alias("tokens"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("tokens") - 1, F.lit(0)), F.lit(block))
    cut = F.transform(
        starts, lambda s: F.struct(s.cast("long").alias("start"), F.slice("tokens", s + 1, block + ahead).alias("tokens"))
    )
    return listed.select("seq", F.inline(cut)).select(
        "seq", "start", F.least(F.size("tokens"), F.lit(block)).alias("owned"), "tokens"
    )


def listing_segments(indexed: DataFrame, token: str, window_size: int, index: str = "idx", block: int = 4096) -> DataFrame:
    """Cut one long numbered sequence into segments of ``block`` tokens plus a look-ahead of ``window_size + 1``.

    Each token goes to its own segment and, when among the first of a segment, to the preceding one as well, so a group
    never holds more than ``block + window_size + 1`` rows however long the sequence is.
    """
    ahead = window_size + 1
    if ahead > block:
        raise ValueError("a block must be longer than its look-ahead")
    own = F.floor(F.col(index) / F.lit(block)).cast("long")
    shared = (F.col(index) % block < ahead) & (F.col(index) >= block)
    homes = F.when(shared, F.array(own, own - 1)).otherwise(F.array(own))
    spread = indexed.select(F.explode(homes).alias("part"), F.col(index).alias("i"), F.col(token).alias("t"))
    grouped = spread.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("i", "t"))).alias("items"))
    return grouped.select(
        F.lit(0).cast("long").alias("seq"),
        (F.col("part") * block).alias("start"),
        F.least(F.size("items"), F.lit(block)).alias("owned"),
        F.col("items.t").alias("tokens"),
    )


def context_windows(segments: DataFrame, window_size: int) -> DataFrame:
    """Windows of ``window_size`` tokens with the token that follows: ``(seq, pos, input, label, is_last)``.

    A sequence of n tokens yields max(0, n - window_size) windows, step 1.
    """
    w = window_size
    n = F.size("tokens")
    count = F.greatest(F.lit(0), F.least(F.col("owned"), n - w))
    columns = F.arrays_zip(*[F.slice("tokens", i + 1, count).alias(f"t{i}") for i in range(w + 1)])
    rows = segments.select("seq", "start", (n - w - 1).alias("final"), F.posexplode(columns).alias("i", "t"))
    return rows.select(
        "seq",
        (F.col("start") + F.col("i")).alias("pos"),
        F.array(*[F.col(f"t.t{i}") for i in range(w)]).alias("input"),
        F.col(f"t.t{w}").alias("label"),
        (F.col("i") == F.col("final")).alias("is_last"),
    )


def _flattened_places(w: int) -> Column:
    """The windows over concatenated inputs that start in this window, by place.

    The concatenation of windows i and i+1 reads t_i … t_{i+w-1}, t_{i+1} …, so the one that starts at place p of window
    i holds t_{i+p} … t_{i+w-1} followed by t_{i+1} … t_{i+p}: all of them in window i itself. Every place but the first
    needs a following window to exist.
    """
    variants = [F.array(*[F.get("input", F.lit(i)) for i in (*range(p, w), *range(1, p + 1))]) for p in range(w)]
    return F.when(F.col("is_last"), F.array(variants[0])).otherwise(F.array(*variants))


def _label_window(w: int) -> Column:
    """The window over labels that ends at this window's label: its last w - 1 inputs and that label."""
    return F.concat(F.slice("input", 2, w - 1), F.array("label"))


def flattened_windows(windows: DataFrame, window_size: int) -> DataFrame:
    """Windows of the same size over the concatenated inputs of a sequence's windows: ``(seq, idx, tokens)``."""
    w = window_size
    return windows.select("seq", "pos", F.posexplode(_flattened_places(w)).alias("p", "tokens")).select(
        "seq", (F.col("pos") * w + F.col("p")).alias("idx"), "tokens"
    )


def label_windows(windows: DataFrame, window_size: int) -> DataFrame:
    """Windows of the same size over a sequence's labels, from its w-th window on: ``(seq, idx, tokens)``."""
    w = window_size
    late = windows.filter(F.col("pos") >= w - 1)
    return late.select("seq", (F.col("pos") - (w - 1)).alias("idx"), _label_window(w).alias("tokens"))


def training_windows(windows: DataFrame, window_size: int) -> DataFrame:
    """The distinct flattened and label windows with their number of occurrences: ``(tokens, weight)``.

    ``windows`` are those of whole sequences. The label window of a window is the input of the next one, so a window sends
    its input, once or twice, and the last one also its label window. The flattened windows at the places after the first
    are the w - 1 rotations of the last w - 1 inputs, each with its first token repeated at the end; they travel as one
    *loop*, the last w - 1 inputs, and are made where their counts arrive. Both are counted in runs of windows and travel packed, in one
    shuffle. A window that ends as it begins has the bucket of the rotations that are equal to it.
    """
    w = window_size
    kind = windows.schema["input"].dataType
    listed = windows.select("input", "label", (F.col("pos") >= w - 1).alias("late"), (F.col("pos") >= w).alias("twice"), "is_last")
    buckets = grams.buckets_of(listed)

    def homes(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        total = hashes[ids[: max(1, w - 1)]].sum(0, dtype=np.uint64)
        if len(ids) == w > 1:
            total += np.where(ids[0] == ids[-1], np.uint64(0), np.uint64(3) * hashes[ids[-1]])
        return grams.mixed(total)

    def loops(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(ids) == w:
            return ids, n
        return np.concatenate([np.concatenate((ids[p:], ids[: p + 1])) for p in range(w - 1)], axis=1), np.tile(n, w - 1)

    def dealt(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        labels = table.column("label").combine_chunks()
        words, ids = grams.coded(pa.concat_arrays([table.column("input").combine_chunks().flatten(), labels]))
        after = ids[len(ids) - len(labels) :]
        ids = np.ascontiguousarray(ids[: len(ids) - len(labels)].reshape(-1, w).T)
        late, twice, last = (table.column(c).to_numpy() for c in ("late", "twice", "is_last"))
        hashes = grams.token_hashes(words)
        ends = np.concatenate((ids[1:], after[None]))[:, late & last]
        sent = np.concatenate((ids, ends), axis=1), np.concatenate((1 + twice, np.ones(ends.shape[1], np.int64)))
        found, n = grams.counted(*sent, len(words))
        yield from grams.deal([words], found, n, homes(hashes, found), buckets)
        if w > 1:
            found, n = grams.counted(ids[1:, ~last], np.ones((~last).sum(), np.int64), len(words))
            yield from grams.deal([words], found, n, homes(hashes, found), buckets, w - 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= _RUN:
                yield from dealt(held)
                held, rows = [], 0
        if rows:
            yield from dealt(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tables in grams.by_bucket(batches):
            for words, ids, n in grams.whole(tables, buckets, homes, loops):
                for some in grams.slices(len(n)):
                    part = ids[:, some].T
                    offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * w)
                    tokens = pa.ListArray.from_arrays(offsets, words.take(pa.array(part.ravel())))
                    yield pa.RecordBatch.from_arrays([tokens, pa.array(n[some])], names=["tokens", "weight"])

    fields = [T.StructField("tokens", kind), T.StructField("weight", T.LongType())]
    return grams.gathered(listed, deal, buckets).mapInArrow(add, T.StructType(fields))


def identified(segments: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Segments of words as segments of their ids, from ``vocabulary(word, token)``, which holds all words.

    Groups are segments, so none has more tokens than a block and its look-ahead.
    """
    placed = segments.select("seq", "start", "owned", F.posexplode("tokens").alias("i", "word"))
    named = placed.join(vocabulary, "word").groupBy("seq", "start", "owned")
    listed = named.agg(F.array_sort(F.collect_list(F.struct("i", F.col("token").cast("int").alias("token")))).alias("items"))
    return listed.select("seq", "start", "owned", F.col("items.token").alias("tokens"))


def forward_pairs(segments: DataFrame, distance: int) -> DataFrame:
    """Each token with each of the next ``distance`` tokens: one row ``(a, b)`` per occurrence. No shuffle."""
    n = F.size("tokens")

    def at(d: int) -> Column:
        count = F.greatest(F.lit(0), F.least(F.col("owned"), n - d))
        return F.arrays_zip(F.slice("tokens", 1, count).alias("a"), F.slice("tokens", F.lit(1 + d), count).alias("b"))

    pairs = reduce(F.concat, [at(d) for d in range(1, distance + 1)])
    return segments.select(F.inline(pairs))
