"""Benchmark decontamination by an FM-index over each shard of the documents.

A shard is a bounded run of document texts inside a task. Its words become numbers of the benchmark's vocabulary, and
a word outside that vocabulary ends a run, since no occurrence can pass it; runs shorter than the shortest test phrase
hold none. The shard's suffix array gives its Burrows-Wheeler transform, stored as a wavelet matrix. All phrases go
through backward search together, one word a step; occurrences are located by walking back to sampled suffixes, and
their spans are merged per document. Texts never leave their task, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import fresh, utf8

WINDOW = 10
SAMPLE = 8
SHARD_BYTES = 16 << 20
#: Benchmark text in one pass over the documents; a larger benchmark takes several passes.
PASS_BYTES = 32 << 20

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SPACED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of all beyond ASCII."""
    return text.lower().translate(_SPACED).split()


@dataclass
class Phrases:
    """Distinct test phrases as rows of word numbers (right-aligned, 0 before), and the items that each belongs to."""

    vocabulary: dict[bytes, int]
    rows: np.ndarray
    lengths: np.ndarray
    items: list[tuple[str, ...]]


def phrases_of(items: list[tuple[object, str | None]], window: int = WINDOW) -> Phrases:
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of((text or "").encode())]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            owners.setdefault(tuple(ids[i : i + window]), set()).add("null" if item is None else str(item))
    rows = np.zeros((len(owners), window), np.int64)
    for i, p in enumerate(owners):
        rows[i, window - len(p) :] = p
    return Phrases(vocabulary, rows, np.count_nonzero(rows, axis=1), [tuple(sorted(x)) for x in owners.values()])


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; every 0 is an end of its own, so no comparison passes one."""
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    rank = symbols + len(ends)
    rank[ends] = np.arange(len(ends))
    step = 1
    while True:
        next_ = np.zeros(n, np.int64)
        next_[: max(0, n - step)] = rank[step:] + 1
        key = rank * (int(next_.max(initial=0)) + 1) + next_
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        step *= 2


class FmIndex:
    """Backward search and location over a sequence of numbers in which 0 separates runs."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        order = suffix_array(symbols)
        self.last = symbols[order - 1]
        counts = np.bincount(symbols, minlength=2)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        self.levels: list[tuple[int, np.ndarray, int]] = []
        level = self.last
        for bit in reversed(range(max(1, int(symbols.max(initial=0)).bit_length()))):
            ones = (level >> bit) & 1
            rank = np.concatenate(([0], np.cumsum(ones))).astype(np.int64)
            zeros = len(level) - int(rank[-1])
            self.levels.append((bit, rank, zeros))
            level = np.concatenate((level[ones == 0], level[ones == 1]))
        # Sampled: every few positions, and every start of a run, so that no walk passes a separator.
        kept = (order % sample == 0) | (symbols[order - 1] == 0)
        self.sampled = np.where(kept, order, -1)

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before ``end``."""
        start = np.zeros_like(end)
        for bit, ones, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            start = np.where(one, zeros + ones[start], start - ones[start])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - start

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix interval of every right-aligned phrase."""
        n = len(self.last)
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), n, np.int64)
        for column in phrases.T[::-1]:
            at = np.flatnonzero((column > 0) & (low < high))
            symbol = column[at]
            known = symbol < len(self.before) - 1
            high[at[~known]] = low[at[~known]]
            at, symbol = at[known], symbol[known]
            low[at] = self.before[symbol] + self.rank(symbol, low[at])
            high[at] = self.before[symbol] + self.rank(symbol, high[at])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by steps back to the nearest sampled one."""
        position = self.sampled[rows]
        left, walked = np.flatnonzero(position < 0), rows.copy()
        steps = 0
        while left.size:
            steps += 1
            symbol = self.last[walked[left]]
            walked[left] = self.before[symbol] + self.rank(symbol, walked[left])
            found = self.sampled[walked[left]]
            position[left[found >= 0]] = found[found >= 0] + steps
            left = left[found < 0]
        return position


def shard_hits(docs: list[np.ndarray], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences in a shard: phrase, and first and one past the last word in the row of all words of the shard.

    Document ``i`` begins at the sum of the lengths before it, each with one word more for the gap after it.
    """
    gap = np.zeros(1, np.int64)
    words = np.concatenate([x for d in docs for x in (d, gap)]) if docs else gap
    inside = np.concatenate(([0], words > 0, [0]))
    turns = np.flatnonzero(np.diff(inside))
    starts, ends = turns[::2], turns[1::2]
    shortest = int(phrases.lengths.min(initial=1 << 30))
    long = ends - starts >= shortest
    starts, ends = starts[long], ends[long]
    if not starts.size:
        return (np.empty(0, np.int64),) * 3
    # Each kept run with the separator after it.
    sizes = ends - starts + 1
    offsets = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    origin = np.arange(sizes.sum()) + np.repeat(starts - offsets, sizes)
    index = FmIndex(words[origin])
    low, high = index.search(phrases.rows)
    found = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(low)), found)
    rows = np.arange(found.sum()) + np.repeat(low - np.concatenate(([0], np.cumsum(found)[:-1])), found)
    at = origin[index.locate(rows)]
    return which, at, at + phrases.lengths[which]


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts.tolist(), ends.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def scan(texts: list[bytes], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per text: number of words, merged word spans, sorted items."""
    get = phrases.vocabulary.get
    docs = []
    for text in texts:
        words = words_of(text)
        docs.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
    which, starts, ends = shard_hits(docs, phrases)
    begins = np.concatenate(([0], np.cumsum([len(d) + 1 for d in docs]))).astype(np.int64)
    doc = np.searchsorted(begins, starts, "right") - 1
    order = np.argsort(doc, kind="stable")
    which, starts, ends, doc = which[order], starts[order], ends[order], doc[order]
    cuts = np.searchsorted(doc, np.arange(len(docs) + 1))
    out = []
    for i, ids in enumerate(docs):
        s = slice(cuts[i], cuts[i + 1])
        owners = {x for w in set(which[s].tolist()) for x in phrases.items[w]}
        out.append((len(ids), merged(starts[s] - begins[i], ends[s] - begins[i]), sorted(owners)))
    return out


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    kept, last = [], 0
    for a, b in spans:
        kept.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*kept, text[last:]])


_RESULT = "struct<n_words:long,spans:array<struct<start:int,end:int>>,items:array<string>>"


def _scanned(text: Column, phrases: Phrases) -> Column:
    @F.arrow_udf(_RESULT)
    def found(texts: pa.Array) -> pa.Array:
        rows, shard, size = [], [], 0
        for t in utf8(texts):
            shard.append(t)
            size += len(t)
            if size >= SHARD_BYTES:
                rows += scan(shard, phrases)
                shard, size = [], 0
        rows += scan(shard, phrases)
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        fields = [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([[{"start": a, "end": b} for a, b in r[1]] for r in rows], pa.list_(span)),
            pa.array([r[2] for r in rows], pa.list_(pa.string())),
        ]
        return pa.StructArray.from_arrays(fields, names=["n_words", "spans", "items"])

    return found(text)


def _passes(benchmark: DataFrame, window: int) -> Iterator[Phrases]:
    """Test phrases in parts of a bounded size, each small enough to be sent to all tasks."""
    items = benchmark.select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + int(size // PASS_BYTES)
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        yield phrases_of([tuple(r) for r in rows], window)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, name: str = "found") -> DataFrame:
    """``docs`` with a struct ``name``: ``n_words``, merged ``spans`` of words (end exclusive), sorted ``items``.

    A null or empty text has no words. An item with fewer words than the window is one phrase, an item without words is
    none; an item without an id counts as "null"; an empty benchmark or table finds nothing. Repeated rows are scanned
    each for itself. Clashing columns of ``docs`` are left as they are unless ``name`` itself clashes.
    """
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"docs already has a column {name}")
    parts = [(fresh(docs, f"pass_{i}"), p) for i, p in enumerate(_passes(benchmark, window))]
    for column, phrases in parts:
        docs = docs.withColumn(column, _scanned(F.col("text"), phrases))
    names = [c for c, _ in parts]
    if len(names) == 1:
        return docs.withColumnRenamed(names[0], name)
    spans = F.sort_array(F.concat(*[F.col(f"{c}.spans") for c in names]))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def joined(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        overlaps = (F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["end"])
        return F.when(overlaps, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(span)))

    items = F.array_sort(F.array_distinct(F.concat(*[F.col(f"{c}.items") for c in names])))
    whole = F.struct(
        F.col(f"{names[0]}.n_words").alias("n_words"), F.aggregate(spans, empty, joined).alias("spans"), items.alias("items")
    )
    return docs.withColumn(name, whole).drop(*names)


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: counts of words, hit words and items, a digest of the items, and whether any word is hit."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark, window)
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select(
        "doc_id",
        "found.n_words",
        hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.size("found.spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no test phrase occurs, with their columns.

    A null, empty or wordless text holds no phrase and stays; of repeated rows all stay or go. Without documents or test
    phrases the table is returned as it is, and columns of any further name are untouched.
    """
    name = fresh(docs, "found")
    return find_contamination(docs, benchmark, window, name).filter(F.size(f"{name}.spans") == 0).drop(name)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the hit spans cut out of ``text``; other rows and a null text stay as they are."""
    name = fresh(docs, "found")
    found = find_contamination(docs, benchmark, window, name)

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        pairs = zip(utf8(texts), spans.to_pylist(), strict=True)
        return pa.array([cut_spans(t, [(s["start"], s["end"]) for s in x]).decode() for t, x in pairs], pa.string())

    shorter = F.when(F.size(f"{name}.spans") > 0, cut("text", f"{name}.spans")).otherwise(F.col("text"))
    return found.withColumn("text", shorter).drop(name)
