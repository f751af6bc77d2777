"""Subword tokens by byte-pair merges (Sennrich et al. 2016) over the normalised alphabet.

Merges are learnt and applied on *distinct* pre-tokens weighted by their frequency, so the work grows with the
vocabulary, not with the text. A merge table is any ordered list of ``(left, right)`` symbol pairs.
"""

from __future__ import annotations

import heapq
import string
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.operators.counts import pretoken_frequency
from tokenloom.session import fits, materialise

Merges = list[tuple[str, str]]

ALPHABET = string.ascii_lowercase + string.digits
# Ids of symbols while merges are learnt: characters by code point, merged pieces from here on.
_FIRST_MERGED = 0x110000
# Merges that a pass of the training tries, at most and at least, and merges after which the split pre-tokens are written anew.
_TRIED = 32
_TRIED_LEAST = 4
_REWRITTEN = 32
# Pre-tokens of a batch of documents that are laid out at a time, and those whose tokens a task remembers.
_UNITS = 1 << 17
_REMEMBERED = 1 << 16


def vocabulary(merges: Merges) -> list[str]:
    """Piece of every token id: the alphabet first, then one piece per merge by rank."""
    pieces = list(ALPHABET)
    seen = set(pieces)
    for left, right in merges:
        if left + right not in seen:
            seen.add(left + right)
            pieces.append(left + right)
    return pieces


def vocabulary_frame(spark: SparkSession, merges: Merges) -> DataFrame:
    """``(token, word)``: the decode table. As long as the merge table, whatever the corpus."""
    return spark.createDataFrame(list(enumerate(vocabulary(merges))), "token int, word string")


def merges_frame(spark: SparkSession, merges: Merges) -> DataFrame:
    """A merge table as rows ``(rank, left, right)``."""
    rows = [(rank, left, right) for rank, (left, right) in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left string, right string")


def merges_from_frame(table: DataFrame, limit: int = 500_000) -> Merges:
    """The merge list of rows ``(rank, left, right)``, refused beyond ``limit`` because every task carries it."""
    if not fits(table, limit):
        raise ValueError(f"more than {limit} merges")
    return [(row.left, row.right) for row in table.orderBy("rank").collect()]


def marked(piece: Column) -> Column:
    """A pre-token as a string of ``<symbol>`` marks, one per character."""
    return F.regexp_replace(piece, "(.)", "<$1>")


def symbols(marks: Column) -> Column:
    """The symbols of one marked pre-token."""
    return F.split(F.btrim(marks, F.lit("<>")), "><")


def rank_table(merges: Merges) -> dict[tuple[str, str], tuple[int, ...]]:
    """The ranks of each pair; a pair can be learnt again after another merge recreated it."""
    ranks: dict[tuple[str, str], tuple[int, ...]] = {}
    for rank, pair in enumerate(merges):
        ranks[pair] = ranks.get(pair, ()) + (rank,)
    return ranks


def merge_word(word: str, ranks: dict[tuple[str, str], tuple[int, ...]]) -> list[str]:
    """One pre-token into pieces: the merges in rank order, equal ones from the left.

    Pieces are linked to their neighbours and the pairs that can merge wait in a heap by rank and place, so a word of n
    characters takes about n log n steps. A pair that a merge creates waits for its next rank only.
    """
    n = len(word)
    parts: list[str | None] = list(word)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r[0], i) for i, r in enumerate(map(ranks.get, zip(word, word[1:]))) if r]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        # A piece that has been taken up, or has another neighbour by now, no longer has this rank.
        if parts[i] is None or j >= n or rank not in ranks.get((parts[i], parts[j]), ()):
            continue
        parts[i], parts[j] = parts[i] + parts[j], None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        for left, right in ((before[i], i), (i, k)):
            if left >= 0 and right < n:
                later = next((r for r in ranks.get((parts[left], parts[right]), ()) if r > rank), None)
                if later is not None:
                    heapq.heappush(heap, (later, left))
    return [p for p in parts if p is not None]


def _once(udf):
    """Keep Spark from repeating the function in the not-empty filter that it puts before an explode."""
    return udf.asNondeterministic()


def encode_pieces(piece: Column, merges: Merges) -> Column:
    """The subword pieces of a pre-token column, as an array of strings."""
    ranks = rank_table(merges)

    @F.arrow_udf("array<string>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if word is None else merge_word(word, ranks) for word in batch.to_pylist()], pa.list_(pa.string()))

    return _once(encode)(piece)


def _laid_out(merges: Merges, pieces: bool) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """Arrays of pre-tokens to arrays of token ids, or of the pieces themselves.

    Documents are taken in runs of bounded length. Each is dictionary-encoded, so a distinct pre-token is merged at most once
    per run, and a frequent one seldom twice per task; tokens are then laid out by index arithmetic.
    """
    words = vocabulary(merges)
    ids = {piece: i for i, piece in enumerate(words)}
    ranks = rank_table(merges)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        named = pa.array(words, pa.string())

        @lru_cache(maxsize=_REMEMBERED)
        def token_ids(word: str) -> tuple[int, ...]:
            return tuple(ids[piece] for piece in merge_word(word, ranks))

        def laid_out(run: pa.Array) -> pa.Array:
            units = run.flatten().dictionary_encode()
            encoded = [token_ids(word) for word in units.dictionary.to_pylist()]
            lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
            pool = np.fromiter((i for e in encoded for i in e), np.int32, lengths.sum())
            starts = np.cumsum(lengths) - lengths

            which = units.indices.to_numpy(zero_copy_only=False)
            sizes = lengths[which]
            ends = np.cumsum(sizes)
            within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
            tokens = pa.array(pool[np.repeat(starts[which], sizes) + within])

            # Row limits count units; turn them into limits that count tokens.
            rows = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(run), 0).to_numpy(zero_copy_only=False))])
            limits = np.concatenate([[0], ends])[rows]
            return pa.ListArray.from_arrays(pa.array(limits, pa.int32()), named.take(tokens) if pieces else tokens)

        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
            run = np.cumsum(sizes, dtype=np.int64) // _UNITS
            cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(batch)]
            for low, high in zip(cuts, cuts[1:]):
                yield laid_out(batch.slice(low, high - low))

    return encode


def encode_documents(docs: DataFrame, merges: Merges, key: str = "doc_id", pattern: str = tx.KEPT_PATTERN) -> DataFrame:
    """Token ids of each document in reading order: ``(key, tokens ARRAY<INT>)``. Runs where the document lies: no shuffle."""
    encode = _laid_out(merges, pieces=False)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from encode(batches)

    return docs.select(key, _once(ids)(tx.pretokens(F.col("text"), pattern)).alias("tokens"))


def document_pieces(docs: DataFrame, merges: Merges, key: str = "doc_id", pattern: str = tx.KEPT_PATTERN) -> DataFrame:
    """As :func:`encode_documents` but with pieces instead of ids: ``(key, tokens ARRAY<STRING>)``."""
    encode = _laid_out(merges, pieces=True)

    @F.arrow_udf("array<string>")
    def named(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from encode(batches)

    return docs.select(key, _once(named)(tx.pretokens(F.col("text"), pattern)).alias("tokens"))


def subword_frequency(docs: DataFrame, merges: Merges, pattern: str = tx.KEPT_PATTERN) -> DataFrame:
    """Occurrences of each subword: ``(word, token, frequency)``, where ``word`` is the decoded piece."""
    return frequency_of_pieces(pretoken_frequency(docs, pattern), merges)


def frequency_of_pieces(counted: DataFrame, merges: Merges) -> DataFrame:
    """As :func:`subword_frequency`, from counted pre-tokens ``(piece, frequency)``."""
    pieces = counted.select(F.explode(encode_pieces(F.col("piece"), merges)).alias("word"), "frequency")
    totals = pieces.groupBy("word").agg(F.sum("frequency").alias("frequency"))
    # As long as the merge table, which is a parameter.
    decode = vocabulary_frame(counted.sparkSession, merges)
    return totals.join(F.broadcast(decode), "word").select("word", "token", "frequency")


def pair_counts(encoded: DataFrame, marks: str = "marks") -> DataFrame:
    """Frequency of each adjacent symbol pair over weighted, marked pre-tokens: ``(left, right, frequency)``."""
    with_symbols = encoded.select(symbols(F.col(marks)).alias("s"), "frequency").filter(F.size("s") > 1)
    n = F.size("s") - 1
    pairs = F.arrays_zip(F.slice("s", 1, n).alias("a"), F.slice("s", 2, n).alias("b"))
    return (
        with_symbols.select(F.explode(pairs).alias("p"), "frequency")
        .groupBy(F.col("p.a").alias("left"), F.col("p.b").alias("right"))
        .agg(F.sum("frequency").alias("frequency"))
    )


def train_merges(docs: DataFrame, n_merges: int, pattern: str = tx.KEPT_PATTERN, tried: int = _TRIED) -> Merges:
    """Learn ``n_merges`` merges: each time the most frequent adjacent pair, ties by (left, right)."""
    return merges_of_pieces(pretoken_frequency(docs, pattern), n_merges, tried)


def _merged(symbols: np.ndarray, weights: np.ndarray, left: int, right: int, new: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Replace a pair in symbols, whose words are kept apart by -1: symbols, weights, and what that changes in pair counts.

    The change is ``(left << 32 | right, weight)`` with repeats: the pairs at and beside each place before, less, and
    those beside the new symbol after.
    """
    at = np.flatnonzero((symbols[:-1] == left) & (symbols[1:] == right))
    if left == right and at.size:
        # In a run of one symbol every second place starts a pair.
        run = np.concatenate(([0], np.cumsum(np.diff(at) != 1)))
        at = at[(at - at[np.searchsorted(run, run)]) % 2 == 0]
    if not at.size:
        return symbols, weights, np.empty(0, np.int64), np.empty(0, np.int64)

    def pairs(of: np.ndarray, by: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.unique(places)
        places = places[(places >= 0) & (places < len(of) - 1)]
        places = places[(of[places] >= 0) & (of[places + 1] >= 0)]
        return of[places] << 32 | of[places + 1], by[places]

    gone, gone_weight = pairs(symbols, weights, np.concatenate((at - 1, at, at + 1)))
    symbols = symbols.copy()
    symbols[at] = new
    symbols, weights = np.delete(symbols, at + 1), np.delete(weights, at + 1)
    at = at - np.arange(len(at))
    made, made_weight = pairs(symbols, weights, np.concatenate((at - 1, at)))
    return symbols, weights, np.concatenate((gone, made)), np.concatenate((-gone_weight, made_weight))


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of rows ``(symbols, frequency)`` with -1 after each row, and the row's frequency beside each."""
    offsets = batch.column(0).offsets.to_numpy()
    sizes = np.diff(offsets)
    ends = np.cumsum(sizes + 1)
    symbols = np.full(ends[-1] if len(ends) else 0, -1, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False
    symbols[inside] = batch.column(0).flatten().to_numpy()
    return symbols, np.repeat(batch.column(1).to_numpy(), sizes + 1)


def _split(counted: DataFrame) -> DataFrame:
    """Pre-tokens ``(piece, frequency)`` as ``(symbols, frequency)``, one code point to a symbol."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = batch.column(0).to_pylist()
            points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.int32)
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, points), batch.column(1)], names=["symbols", "frequency"])

    return counted.select("piece", F.col("frequency").cast("long")).mapInArrow(split, "symbols array<int>, frequency long")


def _rewritten(split: DataFrame, steps: list[tuple[int, int, int]]) -> DataFrame:
    """The rows after merges ``(left, right, new)``."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, weights = _flat(batch)
            for step in steps:
                symbols, weights, _, _ = _merged(symbols, weights, *step)
            ends = np.flatnonzero(symbols < 0)
            offsets = np.concatenate(([0], ends - np.arange(len(ends)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, symbols[symbols >= 0].astype(np.int32))
            yield pa.RecordBatch.from_arrays([lists, batch.column(1)], names=batch.schema.names)

    return split.mapInArrow(rewrite, split.schema)


def _changes(split: DataFrame, done: list[tuple[int, int, int]], tried: list[tuple[int, int, int]]) -> DataFrame:
    """What each merge of ``tried``, after ``done`` and those before it, changes: ``(step, left, right, frequency)``.

    Without ``tried``, the counts of all pairs after ``done``, as step 0.
    """

    def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        for batch in batches:
            symbols, weights = _flat(batch)
            for step in done:
                symbols, weights, _, _ = _merged(symbols, weights, *step)
            if not tried and len(symbols):
                whole = (symbols[:-1] >= 0) & (symbols[1:] >= 0)
                found[0].append((symbols[:-1][whole] << 32 | symbols[1:][whole], weights[:-1][whole]))
            for number, step in enumerate(tried):
                symbols, weights, codes, amounts = _merged(symbols, weights, *step)
                if codes.size:
                    found[number].append((codes, amounts))
        for number, parts in found.items():
            codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            totals = np.zeros(len(codes), np.int64)
            np.add.at(totals, place, np.concatenate([w for _, w in parts]))
            columns = [np.full(len(codes), number), codes >> 32, codes & 0xFFFFFFFF, totals]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["step", "left", "right", "frequency"])

    rows = split.mapInArrow(changes, "step long, left long, right long, frequency long")
    summed = rows.groupBy("step", "left", "right").agg(F.sum("frequency").alias("frequency"))
    return summed.filter("frequency <> 0")


class _Pairs:
    """Counts of the pairs of symbols that come first, the next to merge at hand.

    Pairs order by count, descending, then by their pieces. Those that are not held come after ``last``, except pairs of
    ``fresh`` symbols, made since the count, which are all held.
    """

    def __init__(self, counts: dict[tuple[int, int], int], complete: bool, pieces: list[str]):
        self.counts, self.pieces = counts, pieces
        self.fresh: set[int] = set()
        self.heap = [self._key(pair, n) for pair, n in counts.items()]
        self.last = (0, "", "") if complete else max(self.heap)[:3]
        heapq.heapify(self.heap)

    def name(self, symbol: int) -> str:
        return chr(symbol) if symbol < _FIRST_MERGED else self.pieces[symbol - _FIRST_MERGED]

    def _key(self, pair: tuple[int, int], count: int) -> tuple[int, str, str, tuple[int, int]]:
        return -count, self.name(pair[0]), self.name(pair[1]), pair

    def add(self, pair: tuple[int, int], amount: int) -> None:
        if pair not in self.counts and self.last[0] and not self.fresh.intersection(pair):
            if amount > 0:
                # It may now come before ``last`` by as much.
                self.last = (self.last[0] - amount, "", "")
            return
        self.counts[pair] = count = self.counts.get(pair, 0) + amount
        if count > 0:
            heapq.heappush(self.heap, self._key(pair, count))

    def best(self) -> tuple[int, int] | None:
        """The first pair; None if there is none, or if one that is not held may come before it."""
        while self.heap and self.counts.get(self.heap[0][-1], 0) != -self.heap[0][0]:
            heapq.heappop(self.heap)
        if not self.heap or (self.last[0] and self.heap[0][:3] > self.last):
            return None
        return self.heap[0][-1]

    def likely(self, n: int) -> list[tuple[int, int, int]]:
        """The next ``n`` merges ``(left, right, new)`` as they would come if a symbol's neighbours did not depend on each other.

        Only the first is certain; a wrong guess further on costs a pass, not the result.
        """
        counts = {pair: float(c) for pair, c in self.counts.items() if c > 0}
        pieces = list(self.pieces)
        known = {piece: _FIRST_MERGED + i for i, piece in enumerate(pieces)}
        after, before = defaultdict(set), defaultdict(set)
        for left, right in counts:
            after[left].add(right)
            before[right].add(left)

        def name(symbol: int) -> str:
            return chr(symbol) if symbol < _FIRST_MERGED else pieces[symbol - _FIRST_MERGED]

        def move(pair: tuple[int, int], to: tuple[int, int], share: float) -> None:
            amount = counts[pair] * share
            counts[pair] -= amount
            counts[to] = counts.get(to, 0.0) + amount
            after[to[0]].add(to[1])
            before[to[1]].add(to[0])
            for changed in (pair, to):
                heapq.heappush(heap, (-counts[changed], name(changed[0]), name(changed[1]), changed))

        heap = [(-c, name(pair[0]), name(pair[1]), pair) for pair, c in counts.items()]
        heapq.heapify(heap)
        out: list[tuple[int, int, int]] = []
        while heap and len(out) < n:
            count, _, _, (left, right) = heapq.heappop(heap)
            if counts.get((left, right), 0.0) != -count or count >= 0:
                continue
            piece = name(left) + name(right)
            if piece not in known:
                known[piece] = _FIRST_MERGED + len(pieces)
                pieces.append(piece)
            new = known[piece]
            out.append((left, right, new))
            ends = sum(counts.get((x, left), 0.0) for x in before[left]), sum(counts.get((right, y), 0.0) for y in after[right])
            counts[left, right] = 0.0
            if left != right:
                for x in sorted(before[left] - {right}):
                    if counts.get((x, left), 0.0) > 0:
                        move((x, left), (x, new), min(1.0, -count / max(ends[0], -count)))
                for y in sorted(after[right] - {left}):
                    if counts.get((right, y), 0.0) > 0:
                        move((right, y), (new, y), min(1.0, -count / max(ends[1], -count)))
        return out


def _counted_pairs(split: DataFrame, done: list[tuple[int, int, int]], limit: int, pieces: list[str]) -> _Pairs:
    """The first ``limit`` pairs after the merges ``done``, counted over all pre-tokens."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [[chr(i) if i < _FIRST_MERGED else pieces[i - _FIRST_MERGED] for i in batch.column(c).to_pylist()] for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(n, pa.string()) for n in names)], names=names_out)

    names_out = ["left", "right", "frequency", "left_name", "right_name"]
    counted = _changes(split, done, []).select("left", "right", "frequency")
    rows = counted.mapInArrow(named, "left long, right long, frequency long, left_name string, right_name string")
    first = rows.orderBy(F.desc("frequency"), "left_name", "right_name").limit(limit).collect()
    return _Pairs({(r.left, r.right): r.frequency for r in first}, len(first) < limit, pieces)


def merges_of_pieces(counted: DataFrame, n_merges: int, tried: int = _TRIED) -> Merges:
    """As :func:`train_merges`, from counted pre-tokens ``(piece, frequency)``.

    Pairs are counted over all pre-tokens once. From then on a pass guesses the next ``tried`` merges, carries them out one after
    another where they occur, and returns by how much each of them changes which counts. The driver replays these
    changes: it takes a merge if it is in fact the most frequent pair at that point and drops the rest at the first that
    is not, so the result is that of one merge at a time. The driver holds pairs that can come up within the merges
    left, not all; if others could, pairs are counted anew. A pass tries twice as many merges as the one before it kept, and
    every so many merges the pre-tokens are written as they are by then, so a pass carries out few merges besides those it keeps.
    """
    n_merges = max(0, n_merges)
    trying = tried
    tasks = max(counted.sparkSession.sparkContext.defaultParallelism, int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    split = materialise(_split(counted.filter(F.length("piece") > 1).repartition(tasks, "piece")))
    merges: Merges = []
    pieces: list[str] = []
    done: list[tuple[int, int, int]] = []
    pairs: _Pairs | None = None
    while len(merges) < n_merges:
        if pairs is None:
            pairs = _counted_pairs(split, done, 2 * (n_merges - len(merges)) + 1000, pieces)
            if pairs.best() is None:
                return merges
        guesses = pairs.likely(min(trying, n_merges - len(merges)))
        known = len(merges)
        changes = defaultdict(list)
        for row in _changes(split, done, guesses).collect():
            changes[row.step].append(((row.left, row.right), row.frequency))
        for number, (left, right, new) in enumerate(guesses):
            if pairs.best() != (left, right):
                break
            merges.append((pairs.name(left), pairs.name(right)))
            done.append((left, right, new))
            if new == _FIRST_MERGED + len(pieces):
                pieces.append("".join(merges[-1]))
                pairs.fresh.add(new)
            for pair, amount in changes[number]:
                pairs.add(pair, amount)
        trying = min(tried, max(_TRIED_LEAST, 2 * (len(merges) - known)))
        if pairs.best() is None and pairs.last[0]:
            pairs = None
        elif pairs.best() is None:
            return merges
        if len(done) >= _REWRITTEN and len(merges) < n_merges:
            # The counts are those of the same pieces, so they stay.
            split, done = materialise(_rewritten(split, done)), []
    return merges
