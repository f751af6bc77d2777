"""Language-model scores by logistic context mixing.

A text is a row of bytes and an end mark. Each symbol is a path in the Huffman tree of what followed the byte before it
in training, so that it is a few binary decisions. For each of several orders the preceding bytes and the tree node are hashed to a slot that holds
how often the decision was 0 and 1 in the training texts. The slots' log odds are mixed by weights that a gate, the
confidence of the slots, selects; the mixed chance is refined by an adaptive map. Both are learnt from all training texts, each
decision being left out of the counts that predict it. While a text is read, the weights and the map go on learning
from every stretch after it was scored. The sum of the decisions' logarithms is the score.

The unigram score beside it looks up the most frequent words, bounded in number, where the text lies, and joins the
counts of all other words.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import crc_remainder, utf8
from tokenloom.session import materialise

#: Bytes in the contexts of a fixed length: the first has a slot for every context, the second is hashed. The third
#: context, also hashed, is the word so far.
SHORT, LONG = 1, 3
N_CONTEXTS = 3
SLOT_BITS = 20
END = 256
#: Words whose counts go to every task.
HEAD = 1 << 17
#: Bytes whose decisions are laid out at once.
GROUP = 1 << 16
#: Decisions between two updates of the weights.
STRETCH = 4096
_FLUSH = 1 << 18
#: Symbols of a task that are sorted and counted at once.
_SORTED = 1 << 22
#: Bytes of text whose words are looked up at once.
_PART = 1 << 22
#: Steps of Newton's method from equal weights.
_ROUNDS = 5
_CLASSES = 4
_GATES = _CLASSES**N_CONTEXTS
_SCALE = 1024.0
_BUCKETS = 33
_PAD = 64


@dataclass
class Code:
    """Per pair of a byte and the symbol after it the steps of its path, ``2 node + bit``, one after the other."""

    start: np.ndarray
    length: np.ndarray
    steps: np.ndarray


def pair_counts(texts: list[bytes]) -> np.ndarray:
    """How often each symbol follows each byte; a text begins after byte 0."""
    joined = np.frombuffer(b"".join(b"\0" + t for t in texts), np.uint8).astype(np.int32)
    after = np.append(joined[1:], END)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) - 1
    after[ends[ends >= 0]] = END
    return np.bincount(joined * (END + 1) + after[: len(joined)], minlength=256 * (END + 1))


def _paths(counts: list[int]) -> list[tuple[list[int], list[int]]]:
    """Nodes and bits of the way to every symbol in a Huffman tree; unseen symbols count as one."""
    heap: list[tuple[int, int, object]] = [(max(1, n), i, i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    number = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a[0] + b[0], len(counts) + number, (number, a[2], b[2])))
        number += 1
    out: list[tuple[list[int], list[int]]] = [([], [])] * len(counts)
    stack: list[tuple[object, list[int], list[int]]] = [(heap[0][2], [], [])]
    while stack:
        at, nodes, bits = stack.pop()
        if isinstance(at, tuple):
            stack += [(at[1], [*nodes, at[0]], [*bits, 0]), (at[2], [*nodes, at[0]], [*bits, 1])]
        else:
            out[at] = (nodes, bits)
    return out


def huffman(pairs: np.ndarray) -> Code:
    """One tree for each preceding byte, so that the more likely a symbol is there, the fewer decisions it takes."""
    table = pairs.reshape(256, END + 1)
    unseen = _paths([0] * (END + 1))
    paths = [p for row in table for p in (_paths(row.tolist()) if row.any() else unseen)]
    length = np.array([len(p[0]) for p in paths], np.int64)
    start = np.concatenate(([0], np.cumsum(length)[:-1]))
    steps = np.fromiter((2 * n + b for p in paths for n, b in zip(*p, strict=True)), np.uint16, int(length.sum()))
    return Code(start, length, steps)


def table_sizes() -> list[int]:
    return [1 << 16, *[1 << SLOT_BITS] * (N_CONTEXTS - 1)]


def _few_and_word(raw: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last few bytes before each place as one number, and a hash of the word so far (of ``_PAD`` bytes at most)."""
    back = [raw[place - i].astype(np.uint32) for i in range(1, LONG + 1)]
    few = back[0] | back[1] << np.uint32(8) | back[2] << np.uint32(16)
    # A word's hash is a difference of prefix sums, moved back to the start of the word.
    parts = (raw.astype(np.uint64) + np.uint64(1)) * _UP[: len(raw)]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(parts)))
    at = np.arange(len(raw) + 1)
    start = np.maximum.accumulate(np.where(np.concatenate(([True], raw <= 32)), at, 0))
    start = np.maximum(start, at - _PAD)
    word = (sums[place] - sums[start[place]]) * _DOWN[start[place]]
    return few.astype(np.uint64), _spread(word).astype(np.uint64)


def contexts(raw: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Hashes of the contexts before each place: the last byte, the last few, and the word so far."""
    few, word = _few_and_word(raw, place)
    return [(few & np.uint64(255)).astype(np.uint32), _spread(few), word.astype(np.uint32)]


def _spread(x: np.ndarray) -> np.ndarray:
    return ((x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


_CYCLE = 2 * (GROUP + _PAD + 1)
_UP, _DOWN = (
    np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(_CYCLE - 1, b, np.uint64))))
    for b in (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64))
)


def decisions(symbols: np.ndarray, hashes: list[np.ndarray], code: Code) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per context the slots of all decisions, the bits, and the number of decisions of each symbol."""
    pair = hashes[0] * np.int64(END + 1) + symbols
    length = code.length[pair]
    ends = np.cumsum(length)
    # Places are in range by construction: "clip" only spares their check, here and below.
    owner = np.repeat(np.arange(len(length)), length)
    at = (code.start[pair] - (ends - length)).take(owner, mode="clip")
    at += np.arange(len(at))
    step = code.steps.take(at, mode="clip")
    node, bit = (step >> np.uint16(1)).astype(np.uint32), (step & np.uint16(1)).astype(np.uint8)
    slots = [(hashes[0] << np.uint32(8)).take(owner, mode="clip")]
    slots[0] |= node
    salt = node * np.uint32(0x85EBCA6B)
    for k in range(1, N_CONTEXTS):
        mixed = (hashes[k] * np.uint32(2 * k + 1)).take(owner, mode="clip")
        mixed ^= salt
        mixed *= np.uint32(0xC2B2AE35)
        mixed >>= np.uint32(32 - SLOT_BITS)
        slots.append(mixed)
    return slots, bit, length


def pieces(texts: list[bytes]) -> Iterator[list[tuple[int, bytes, bytes, bool]]]:
    """Groups of a bounded size of ``(text number, preceding bytes, bytes, whether the text ends)``."""
    group, size = [], 0
    for i, text in enumerate(texts):
        for begin in range(0, max(1, len(text)), GROUP):
            part = text[begin : begin + GROUP]
            group.append((i, text[max(0, begin - _PAD) : begin], part, begin + GROUP >= len(text)))
            size += len(part) + _PAD + 1
            if size >= GROUP:
                yield group
                group, size = [], 0
    if group:
        yield group


def _placed(group: list[tuple[int, bytes, bytes, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a group, the places of all its symbols, which of these are ends of texts, and the symbols of each part."""
    zeros = bytes(_PAD)
    joined = b"".join((zeros + before)[-_PAD:] + part + b"\0" for _, before, part, _ in group)
    sizes = np.array([len(part) for _, _, part, _ in group])
    starts = np.concatenate(([0], np.cumsum(sizes + _PAD + 1)[:-1])) + _PAD
    has_end = np.array([ends for *_, ends in group])
    count = sizes + has_end
    first = np.cumsum(count) - count
    place = np.repeat(starts - first, count) + np.arange(int(count.sum()))
    return np.frombuffer(joined, np.uint8), place, (first + sizes)[has_end], count


def laid_out(group: list[tuple[int, bytes, bytes, bool]], code: Code) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Slots and bits of all decisions of a group, and where the decisions of its parts end."""
    raw, place, end, count = _placed(group)
    symbols = raw[place].astype(np.int64)
    symbols[end] = END
    slots, bits, length = decisions(symbols, contexts(raw, place), code)
    total = np.concatenate(([0], np.cumsum(length)))
    return slots, bits, total[np.cumsum(count)]


# Training


def parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``_PART`` bytes together, or one longer text."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(size, dtype=np.int64) // _PART
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        if end > begin:
            yield batch.slice(begin, end - begin)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Per word its row and its place among the distinct words, and these (the empty one may be there, unused)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    which, distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.intp), coded.dictionary.cast(pa.binary()).to_pylist()
    if b"" in distinct:
        kept = which != distinct.index(b"")
        row, which = row[kept], which[kept]
    return row, which, distinct


def _training_counts(docs: DataFrame) -> DataFrame:
    """``(kind, key, n)``: counts of words (0), of pairs of a byte and the next symbol (1), and of texts (2)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = {}
        symbols, n_texts = np.zeros(256 * (END + 1), np.int64), 0

        def rows(kind: int, keys: list[bytes], n: list[int]) -> pa.RecordBatch:
            columns = [pa.array([kind] * len(keys), pa.int32()), pa.array(keys, pa.binary()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["kind", "key", "n"])

        for part in (p for batch in batches for p in parts(batch, 0)):
            texts = utf8(part.column(0))
            n_texts += len(texts)
            for i in range(0, len(texts), 256):
                symbols += pair_counts(texts[i : i + 256])
            _, which, distinct = words_of(part.column(0))
            for word, n in zip(distinct, np.bincount(which, minlength=len(distinct)).tolist(), strict=True):
                if n:
                    words[word] = words.get(word, 0) + n
            if len(words) >= _FLUSH:
                yield rows(0, list(words.keys()), list(words.values()))
                words.clear()
        yield rows(0, list(words.keys()), list(words.values()))
        used = np.flatnonzero(symbols).tolist()
        yield rows(1, [i.to_bytes(4, "big") for i in used], symbols[used].tolist())
        yield rows(2, [b""], [n_texts])

    counted = docs.mapInArrow(count, "kind int, key binary, n long")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _symbol_counts(docs: DataFrame) -> DataFrame:
    """``(few, word, symbol, n)``: how often each symbol follows the last few bytes and the hash of the word so far."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        ends: list[np.ndarray] = []
        held = 0
        for group in (g for batch in batches for g in pieces(utf8(batch.column(0)))):
            raw, place, end, _ = _placed(group)
            few, word = _few_and_word(raw, place)
            key = few << np.uint64(40) | raw[place].astype(np.uint64) << np.uint64(32) | word
            keys.append(np.delete(key, end))
            ends.append(few[end] << np.uint64(40) | word[end])
            held += len(key)
            if held >= _SORTED:
                yield from rows(keys, ends)
                keys, ends, held = [], [], 0
        if held:
            yield from rows(keys, ends)

    def rows(keys: list[np.ndarray], ends: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for parts, is_end in ((keys, False), (ends, True)):
            found = np.concatenate(parts)
            found.sort()
            first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))[: len(found)]
            n = np.diff(first, append=len(found))
            found = found[first]
            symbol = np.full(len(found), END) if is_end else (found >> np.uint64(32) & np.uint64(255)).astype(np.int64)
            columns = [found >> np.uint64(40), found & np.uint64(0xFFFFFFFF), symbol, n]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["few", "word", "symbol", "n"])

    counted = docs.mapInArrow(count, "few long, word long, symbol long, n long")
    return counted.groupBy("few", "word", "symbol").agg(F.sum("n").alias("n"))


def _counted_decisions(batches: Iterator[pa.RecordBatch], code: Code) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Slots and bits of the decisions of rows ``(few, word, symbol, n)``, and how often each was taken."""
    for batch in batches:
        few, word, symbol, n = (c.to_numpy() for c in batch.columns)
        hashes = [(few & 255).astype(np.uint32), _spread(few.astype(np.uint64)), word.astype(np.uint32)]
        slots, bits, length = decisions(symbol, hashes, code)
        yield slots, bits, np.repeat(n, length)


def _slot_counts(symbols: DataFrame, code: Code) -> DataFrame:
    """``(slot, n0, n1)`` over the tables of all contexts, one after the other."""
    sizes = table_sizes()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(2 * n, np.int64) for n in sizes]
        for slots, bits, n in _counted_decisions(batches, code):
            for table, slot in zip(counts, slots, strict=True):
                np.add.at(table, slot.astype(np.int64) << 1 | bits, n)
        yield from rows(counts)

    def rows(counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        base = 0
        for n, table in zip(sizes, counts, strict=True):
            pairs = table.reshape(n, 2)
            used = np.flatnonzero(pairs.any(1))
            columns = [pa.array((used + base).astype(np.int32)), *(pa.array(pairs[used, b]) for b in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", "n0", "n1"])
            base += n

    found = symbols.mapInArrow(count, "slot int, n0 long, n1 long")
    return found.groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


@dataclass
class Start:
    """What is known before a text is read: per context and gate the weight, and per bucket of the map the chance of a 1."""

    weights: np.ndarray = field(default_factory=lambda: np.full((N_CONTEXTS, _GATES), 1 / N_CONTEXTS, np.float32))
    chances: np.ndarray = field(default_factory=lambda: _CENTRES.copy())


@dataclass
class Model:
    """Per context the slots' log odds as small whole numbers, the low two bits telling how sure they are."""

    code: Code
    tables: list[np.ndarray]
    start: Start = field(default_factory=Start)


def _log_odds(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Counts as log odds and how sure these are."""
    odds = np.log((n1 + 0.4) / (n0 + 0.4))
    sure = np.searchsorted([1, 4, 32], n0 + n1, "right")
    return (np.round(np.clip(odds, -7.9, 7.9) * _SCALE).astype(np.int16) & ~np.int16(3)) | sure.astype(np.int16)


def _gated(packed: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The log odds of each context, and the gate."""
    gate = np.zeros(len(packed[0]), np.int16)
    odds = []
    for k, values in enumerate(packed):
        gate |= (values & np.int16(3)) << np.int16(2 * k)
        odds.append(values.astype(np.float32))
        odds[-1] *= np.float32(1 / _SCALE)
    return odds, gate.astype(np.intp)


def _model(code: Code, counted: DataFrame, symbols: DataFrame) -> Model:
    # At most one row per slot, however large the corpus.
    rows = counted.toArrow()
    slot, n0, n1 = (rows.column(i).to_numpy() for i in range(3))
    whole = np.zeros(sum(table_sizes()), np.int16)
    whole[slot] = _log_odds(n0, n1)
    # The same without one decision that was 0, and one that was 1.
    without = np.zeros((len(whole), 2), np.int16)
    for bit in (0, 1):
        without[slot, bit] = _log_odds(np.maximum(n0 - (1 - bit), 0), np.maximum(n1 - bit, 0))
    cuts = np.cumsum(table_sizes())[:-1]
    return Model(code, np.split(whole, cuts), _learnt(symbols, code, np.split(without, cuts)))


def _learnt(symbols: DataFrame, code: Code, without: list[np.ndarray]) -> Start:
    """Weights that make the training texts likeliest, by Newton's method per gate from equal ones, and the map under them.

    A pass sums up slopes and curvatures of every decision, left out of its own counts; the driver sees some hundred sums.
    """
    start = Start()
    upper = [(k, m) for k in range(N_CONTEXTS) for m in range(k, N_CONTEXTS)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slopes = np.zeros((N_CONTEXTS + len(upper), _GATES))
        seen = np.zeros(2 * _BUCKETS)
        for slots, bits, n in _counted_decisions(batches, code):
            odds, gate = _gated([table[slot, bits] for table, slot in zip(without, slots, strict=True)])
            z = sum(w.take(gate) * r for w, r in zip(start.weights.astype(float), odds, strict=True))
            p = 0.5 + 0.5 * np.tanh(0.5 * z)
            error, curve = n * (bits - p), n * p * (1 - p)
            terms = [error * r for r in odds] + [curve * odds[k] * odds[m] for k, m in upper]
            slopes += [np.bincount(gate, term, _GATES) for term in terms]
            seen += np.bincount(2 * _bucket(z) + bits, n, 2 * _BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate((slopes.ravel(), seen)).tolist()])], names=["sums"])

    for _ in range(_ROUNDS):
        found = sorted(r.sums for r in symbols.mapInArrow(sums, "sums array<double>").collect())
        if not found:
            break
        total = np.sum(found, axis=0)
        slopes, seen = total[: -2 * _BUCKETS].reshape(-1, _GATES), total[-2 * _BUCKETS :].reshape(_BUCKETS, 2)
        # The map has the weight of a Reader's own start.
        start.chances = (seen[:, 1] + 64 * _CENTRES) / (seen.sum(1) + 64)
        moved = start.weights.astype(float)
        for gate in range(_GATES):
            curve = np.zeros((N_CONTEXTS, N_CONTEXTS))
            for (k, m), value in zip(upper, slopes[N_CONTEXTS:, gate], strict=True):
                curve[k, m] = curve[m, k] = value
            # One more decision's worth for equal weights, which also stand where a gate was never seen.
            pull = slopes[:N_CONTEXTS, gate] + (1 / N_CONTEXTS - moved[:, gate])
            moved[:, gate] += np.clip(np.linalg.solve(curve + np.eye(N_CONTEXTS), pull), -1, 1)
        # Rounded, so that the order in which tasks are summed up does not show.
        start.weights = (np.round(moved * 4096) / 4096).astype(np.float32)
    return start


# Scoring


def _bucket(z: np.ndarray) -> np.ndarray:
    """The bucket of the map that mixed log odds fall into."""
    return np.clip(2 * z + (_BUCKETS // 2 + 0.5), 0, _BUCKETS - 1).astype(np.intp)


_CENTRES = 1 / (1 + np.exp(-(np.arange(_BUCKETS) - _BUCKETS // 2) / 2.0))
_EVEN = Start()


class Reader:
    """The state that learns while one text is read."""

    def __init__(self, start: Start = _EVEN) -> None:
        self.weights = start.weights.copy()
        self.ones = start.chances * 64
        self.seen = np.full(_BUCKETS, 64.0)
        self.log = 0.0

    def read(self, odds: list[np.ndarray], gate: np.ndarray, bits: np.ndarray) -> None:
        for begin in range(0, len(bits), STRETCH):
            s = slice(begin, begin + STRETCH)
            g, bit = gate[s], bits[s]
            rows = [o[s] for o in odds]
            z = self.weights[0].take(g, mode="clip")
            z *= rows[0]
            for w, r in zip(self.weights[1:], rows[1:], strict=True):
                term = w.take(g, mode="clip")
                term *= r
                z += term
            p = np.tanh(z * np.float32(0.5))
            p += 1
            p *= np.float32(0.5)
            z *= 2
            z += np.float32(_BUCKETS // 2 + 0.5)
            bucket = np.minimum(np.maximum(z, 0, out=z), _BUCKETS - 1, out=z).astype(np.intp)
            refined = (0.5 * self.ones / self.seen).astype(np.float32).take(bucket, mode="clip")
            refined += np.float32(0.5) * p
            refined += bit
            refined -= 1
            chance = np.maximum(np.abs(refined, out=refined), 1e-6, out=refined)
            # One logarithm for four chances, whose product a float still holds.
            q = len(chance) // 4
            fours = chance[:q] * chance[q : 2 * q]
            fours *= chance[2 * q : 3 * q]
            fours *= chance[3 * q : 4 * q]
            self.log += float(np.log(fours).sum(dtype=np.float64)) + float(np.log(chance[4 * q :]).sum(dtype=np.float64))
            error = bit - p
            n = np.bincount(g, minlength=_GATES) + 200.0
            for w, r in zip(self.weights, rows, strict=True):
                w += (0.3 * np.bincount(g, error * r, _GATES) / n).astype(np.float32)
            bucket *= 2
            bucket += bit.astype(np.intp)
            both = np.bincount(bucket, minlength=2 * _BUCKETS).reshape(_BUCKETS, 2)
            self.ones += both[:, 1]
            self.seen += both.sum(1)


def log10_chances(texts: list[bytes], model: Model) -> list[float]:
    """The model's log10 probability of every text, with its end."""
    readers: dict[int, Reader] = {}
    done = [0.0] * len(texts)
    for group in pieces(texts):
        slots, bits, ends = laid_out(group, model.code)
        odds, gate = _gated([table.take(slot, mode="clip") for table, slot in zip(model.tables, slots, strict=True)])
        bits_ = bits.astype(np.float32)
        begin = 0
        for (i, _, _, last), end in zip(group, ends.tolist(), strict=True):
            reader = readers.pop(i, None) or Reader(model.start)
            reader.read([o[begin:end] for o in odds], gate[begin:end], bits_[begin:end])
            if last:
                done[i] = reader.log / math.log(10)
            else:
                readers[i] = reader
            begin = end
    return done


def _head(words: DataFrame) -> dict[bytes, int]:
    """The most frequent words and their counts, at most ``HEAD``: whole steps of the count, from the largest down."""
    step = F.floor(F.log2("n") * 8).cast("int")
    left, least = HEAD, None
    for s, n in sorted(words.groupBy(step.alias("step")).agg(F.count("*")).collect(), reverse=True):
        left -= n
        if left < 0:
            break
        least = s
    if least is None:
        return {}
    return {bytes(k): n for k, n in words.filter(step >= least).select("key", "n").collect()}


_SCORED = "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, rare array<struct<key:binary,times:bigint>>"


def scores(docs: DataFrame, folds: int = 7, held_fold: int = 2) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens``, the unigram ``base_score`` and the model's ``score``.

    Trained on rows whose ``crc32(doc_id as text) mod folds`` is not ``held_fold``; a row without an id counts as
    remainder 0. Null and empty texts have the end as their only token. Repeated rows count and are scored each for
    itself. Without training rows all counts are zero. An empty table gives an empty one.
    """
    held = crc_remainder(F.col("doc_id"), folds) == held_fold
    training = docs.filter(~held).select("text")
    counted = materialise(_training_counts(training))
    symbols, n_texts = np.zeros(256 * (END + 1), np.int64), 0
    # A row for each pair of a byte and a symbol at most.
    for kind, key, n in counted.filter("kind > 0").collect():
        if kind == 1:
            symbols[int.from_bytes(key, "big")] = n
        else:
            n_texts = n
    words = counted.filter("kind = 0").select("key", "n")
    total, distinct = words.agg(F.sum("n"), F.count("*")).first()
    total, distinct = (total or 0) + n_texts, distinct + (n_texts > 0)
    code = huffman(symbols)
    counts = materialise(_symbol_counts(training))
    model = _model(code, _slot_counts(counts, code), counts)
    # Terms are small where a word is most of the corpus, so they are summed as such and not as a difference of sums.
    size = total + distinct + 1
    head = {w: math.log10((n + 1) / size) for w, n in _head(words).items()}
    end_log, unseen = math.log10((n_texts + 1) / size), -math.log10(size)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in parts(batch, 3)):
            row, which, keys = words_of(part.column(3))
            logs = np.array([head.get(w, 1.0) for w in keys], float).take(which)
            n, common = part.num_rows, logs <= 0
            rare, times = np.unique(row[~common] * len(keys) + which[~common], return_counts=True)
            owner, key = np.divmod(rare, max(1, len(keys)))
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n))))
            pairs = [pa.array(keys, pa.binary()).take(pa.array(key)), pa.array(times, pa.int64())]
            left = pa.StructArray.from_arrays(pairs, names=["key", "times"])
            columns = [
                *part.columns[:3],
                pa.array(np.bincount(row, minlength=n) + 1, pa.int64()),
                pa.array(np.bincount(row[common], minlength=n) + (n_texts > 0), pa.int64()),
                pa.array(end_log + np.bincount(row, np.where(common, logs, unseen), n), pa.float64()),
                pa.array(log10_chances(utf8(part.column(3)), model), pa.float64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), left),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _SCORED.split(", ")])

    # The number of a row is written with it and read again, never made anew.
    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long"), held.alias("held_out"), "text")
    scored = materialise(numbered.mapInArrow(score, _SCORED))
    rare = scored.select("uid", F.inline("rare"))
    seen = rare.join(words, "key").groupBy("uid").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs"), F.sum("times").alias("more_known")
    )
    joined = scored.drop("rare").join(seen, "uid", "left")
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
