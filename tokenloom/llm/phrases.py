"""Phrase collocations by SON partitioning: mine shards on their own, then count what they found over everything.

A shard is what one task gathers, up to ``MINED_WORDS`` words, kept as numbers. A phrase with ``support`` occurrences in all shards reaches, in
at least one shard, the share of the support that the shard has of all words; so every shard is mined completely, level
by level, at its share, rounded down. What a shard leaves out occurs less often there than its share, which bounds the count of a phrase
from above; the union of the shards' phrases keeps those whose bound reaches the support. Where there are more shards
than the support, shares fall to one occurrence, shards leave nothing out and the bound is the count itself.

The union travels as a Bloom filter of bounded size over 64-bit hashes, first of frequent words, then of phrases. A filter lets
a few others pass, never drops one; the last pass counts every phrase that passes by its words, over all texts, and those
below the support go. There a task adds up its counts over many shards before they travel. So hashes and filters change the work, not the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.session import fits, materialise

SUPPORT = 100
MAX_WORDS = 5
TOP = 2000
#: A phrase goes where a longer one around it has at least this share, in per cent, of its occurrences.
COVER_PERCENT = 100
UNKNOWN = "und"
SHARD_WORDS = 6_000_000
#: Words of the shards in which candidates are counted, and of all the texts whose counts one task adds up.
COUNT_WORDS = 2_000_000
TASK_WORDS = 50_000_000
#: Words of the shards that are mined.
MINED_WORDS = 32_000_000
#: Places of a shard that are hashed at a time.
_PLACES = 1 << 20
#: Counts of phrases that a task holds before it hands them on.
_HELD_COUNTS = 1 << 20
#: Bytes of text that are split into words at a time.
_SLICE_BYTES = 8 << 20
#: Counters of places by hash, to pass over rare phrases: two to this many.
_COUNTER_BITS = 22
#: A Bloom filter has at most two to this many words of 64 bits (16 MB).
_FILTER_BITS = 21
#: Languages up to which their totals are broadcast.
_BROADCAST_ROWS = 10_000
_SEED = 42

_WORD, _BLANK, _END = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x09, 0x20]] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Shard:
    """The words of one language in a shard, in order; words of one piece have the same ``piece``."""

    lang: str
    words: pa.Array
    ids: np.ndarray
    pieces: np.ndarray
    hashes: np.ndarray


def _offsets(texts: pa.LargeStringArray) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]


def _split(texts: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray]:
    """All words of non-null texts, lower-cased, and the piece each stands in."""
    offsets = _offsets(texts)
    begin = int(offsets[0])
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begin : int(offsets[-1])]
    kinds = _KIND[data]
    starts_text = np.zeros(len(data) + 1, bool)
    starts_text[offsets - begin] = True
    inside = kinds == _WORD
    before = np.concatenate(([False], inside[:-1])) & ~starts_text[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate((inside[1:], [False])) & ~starts_text[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    pieces = np.cumsum((kinds == _END) | starts_text[:-1], dtype=np.int32)[starts]
    letters = _LOWER[data[inside]]
    bounds = np.concatenate(([0], np.cumsum(ends - starts)))
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(letters)), pieces


def _slices(texts: pa.LargeStringArray) -> Iterator[pa.LargeStringArray]:
    """Runs of texts of a bounded size; a longer text is a run of its own."""
    ends = _offsets(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _SLICE_BYTES, "right")) - 1)
        yield texts.slice(at, to - at)
        at = to


def _flush(held: dict[str, list[tuple[pa.Array, np.ndarray]]]) -> list[Shard]:
    shards = []
    for lang, parts in held.items():
        coded = pa.concat_arrays([words for words, _ in parts]).dictionary_encode()
        last = np.cumsum([0] + [int(p[-1]) + 1 if len(p) else 0 for _, p in parts])
        pieces = np.concatenate([p + base for (_, p), base in zip(parts, last, strict=False)])
        seed = xxhash.xxh64_intdigest(lang.encode(), _SEED)
        words = coded.dictionary
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(w, seed) for w in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))
        shards.append(Shard(lang, words, coded.indices.to_numpy(), pieces, hashes))
    return shards


def _shards(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[list[Shard]]:
    """The rows ``(lang, text)`` of a task as shards of ``most`` words, each a list with one entry per language."""
    most = SHARD_WORDS if most is None else most
    held: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}
    n = 0
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            rows = pa.array(np.flatnonzero(langs.indices.to_numpy() == code))
            for texts in _slices(batch.column(1).take(rows).cast(pa.large_string())):
                words, pieces = _split(texts)
                if len(words):
                    held.setdefault(lang, []).append((words, pieces))
                    n += len(words)
                if n >= most:
                    shards = _flush(held)
                    held, n = {}, 0
                    yield shards
                    del shards
    if held:
        shards = _flush(held)
        del held
        yield shards


def _mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase and one more word."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + word
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Bloom:
    """Four bits of one 64-bit word per hash; ``bits`` is the number of leading bits that choose the word."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def holds(self, h: np.ndarray) -> np.ndarray:
        mask = np.zeros(len(h), np.uint64)
        for i in range(4):
            mask |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
        return (self.words[(h >> np.uint64(64 - self.bits)).astype(np.int64)] & mask) == mask


def bloom(hashes: DataFrame, column: str) -> Bloom:
    """A filter of the hashes in a written table, built by Spark; 16 bits a hash, up to the size bound."""
    n = hashes.count()
    bits = min(_FILTER_BITS, max(4, (n // 4).bit_length()))
    mask = F.expr(" | ".join(f"shiftleft(1L, CAST(shiftright({column}, {6 * i}) & 63 AS INT))" for i in range(4)))
    words = hashes.groupBy(F.shiftrightunsigned(column, 64 - bits).alias("word")).agg(F.bit_or(mask).alias("mask"))
    # At most 2 ** _FILTER_BITS rows of two longs.
    found = words.toArrow()
    out = np.zeros(1 << bits, np.uint64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return Bloom(out, bits)


@dataclass
class Line:
    """The frequent words of one language in a shard, in order, as places in ``hashes``; -1 stands where no phrase goes on."""

    codes: np.ndarray
    hashes: np.ndarray


def _lines(batches: Iterator[pa.RecordBatch], words: Bloom) -> Iterator[tuple[int, list[Line]]]:
    """The words of a task, up to ``MINED_WORDS`` at a time: how many, and the line of each language. It holds four bytes a word."""
    places: dict[str, dict[int, int]] = {}
    held: dict[str, list[np.ndarray]] = {}
    n = 0

    def flush() -> tuple[int, list[Line]]:
        # Language by language, so that little is held twice.
        return n, [Line(np.concatenate(held.pop(lang)), np.fromiter(places[lang], np.uint64, len(places[lang]))) for lang in [*held]]

    for shards in _shards(batches, min(COUNT_WORDS, SHARD_WORDS)):
        for s in shards:
            known = places.setdefault(s.lang, {})
            frequent = words.holds(s.hashes)
            coded = np.full(len(s.hashes), -1, np.int32)
            coded[frequent] = [known.setdefault(h, len(known)) for h in s.hashes[frequent].tolist()]
            cuts = np.flatnonzero(s.pieces[1:] != s.pieces[:-1]) + 1
            codes = np.concatenate((np.insert(coded[s.ids], cuts, np.int32(-1)), np.full(1, -1, np.int32)))
            # A word alone makes no phrase, and one -1 is enough.
            inside = codes >= 0
            joined = np.concatenate(([False], inside[:-1])) | np.concatenate((inside[1:], [False]))
            codes = np.where(inside & joined, codes, np.int32(-1))
            codes = codes[(codes >= 0) | np.concatenate(([False], codes[:-1] >= 0))]
            held.setdefault(s.lang, []).append(codes)
            n += len(s.ids)
        if n >= MINED_WORDS:
            yield flush()
            places, held, n = {}, {}, 0
    if n:
        yield flush()


def _mined(line: Line, max_words: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes and counts of the phrases of 2 words and more that occur ``least`` times, by their hashes, level by level.

    A place is looked at only where both parts of one word less may be frequent, by counters that several hashes can share.
    """
    n = len(line.codes)
    bits = min(_COUNTER_BITS, max(4, n.bit_length()))
    alive = line.codes >= 0

    def hashed(k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for begin in range(0, n - 1, _PLACES):
            part = alive[begin : begin + _PLACES + 1]
            at = np.flatnonzero(part[:-1] & part[1:]) + begin
            h = line.hashes[line.codes[at]]
            for i in range(1, k):
                h = _mixed(h, line.hashes[line.codes[at + i]])
            yield at, h, (h >> np.uint64(64 - bits)).astype(np.int64)

    for k in range(2, max_words + 1):
        counters = np.zeros(1 << bits, np.int64)
        for _, _, counter in hashed(k):
            counters += np.bincount(counter, minlength=1 << bits)
        likely = counters >= least
        after = np.zeros(n, bool)
        found = []
        for at, h, counter in hashed(k):
            passing = likely[counter]
            after[at[passing]] = True
            found.append(np.unique(h[passing], return_counts=True))
        if not after.any():
            return
        hashes, which = np.unique(np.concatenate([h for h, _ in found]), return_inverse=True)
        counts = np.bincount(which, np.concatenate([c for _, c in found]), len(hashes)).astype(np.int64)
        keep = counts >= least
        yield hashes[keep], counts[keep]
        alive = after


def _levels(
    shard: Shard, words: Bloom, max_words: int, least: int, likely: Callable[[np.ndarray], np.ndarray]
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Phrases of 2 words and more that occur ``least`` times: ``(words, first places, hashes, counts)`` of the distinct ones.

    A phrase is looked at only where both its parts of one word less were, and where ``likely(hashes)`` lets its hash pass; so
    few, mostly frequent, phrases are told apart by their words.
    """
    n = len(shard.ids)
    alive = words.holds(shard.hashes)[shard.ids]
    prefix, hashed = shard.ids, shard.hashes[shard.ids]
    for k in range(2, max_words + 1):
        if n < k:
            return
        together = alive[: n - k + 1] & alive[1 : n - k + 2] & (shard.pieces[: n - k + 1] == shard.pieces[k - 1 :])
        places = np.flatnonzero(together)
        # Of phrases of two words and more, only the hashes at places that are looked at are held.
        at = hashed[places] if k == 2 else hashed[np.searchsorted(held, places)]
        at = _mixed(at, shard.hashes[shard.ids[places + k - 1]])
        passing = likely(at)
        places, at = places[passing], at[passing]
        if not places.size:
            return
        before = prefix[places] if k == 2 else prefix[np.searchsorted(held, places)]
        codes, uniques = pd.factorize((before.astype(np.int64) << 32) | shard.ids[places + k - 1])
        counts = np.bincount(codes, minlength=len(uniques))
        first = np.empty(len(uniques), np.int64)
        first[codes[::-1]] = np.arange(len(places) - 1, -1, -1)
        keep = counts >= least
        yield k, places[first[keep]], at[first[keep]], counts[keep]
        chosen = keep[codes]
        held, hashed, prefix = places[chosen], at[chosen], codes[chosen]
        alive = np.zeros(n - k + 1, bool)
        alive[held] = True


def _rows(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def _word_counts(texts: DataFrame) -> DataFrame:
    """``(lang, word, a)``; the row without a word has the number of words of the language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shards in _shards(batches):
            for s in shards:
                words = pa.concat_arrays([s.words.cast(pa.string()), pa.array([None], pa.string())])
                counts = np.append(np.bincount(s.ids, minlength=len(s.words)), len(s.ids))
                yield _rows(["lang", "word", "a"], [pa.array([s.lang] * len(words)), words, counts])

    return texts.mapInArrow(count, "lang string, word string, a long").groupBy("lang", "word").agg(F.sum("a").alias("a"))


def _local_phrases(texts: DataFrame, words: Bloom, total: int, support: int, max_words: int) -> DataFrame:
    """What shards find at their share of the support: ``(hash, above, missed)``.

    The larger a shard, the larger its share and the fewer phrases reach it by chance; so a task reads as many words as it can hold.

    ``above`` is the count less what a shard may leave out (``missed``), which stands in a row without a hash for each shard.
    """

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["hash", "above", "missed"]
        for n, lines in _lines(batches, words):
            share = max(1, support * n // max(1, total))
            yield _rows(names, [pa.array([None], pa.int64()), [0], [share - 1]])
            for line in lines:
                for hashes, counts in _mined(line, max_words, share):
                    yield _rows(names, [hashes.view(np.int64), counts - (share - 1), np.zeros(len(counts), np.int64)])

    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, -(-total // MINED_WORDS))
    found = texts.coalesce(tasks).mapInArrow(mine, "hash long, above long, missed long")
    return found.groupBy("hash").agg(F.sum("above").alias("above"), F.sum("missed").alias("missed"))


_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("a", pa.int64())])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts ``(lang, phrase, size, a)`` with those of one phrase added up, as far as ``_HELD_COUNTS`` distinct ones are held."""
    held, n, full = [], 0, _HELD_COUNTS

    def together() -> pa.Table:
        found = pa.Table.from_batches(held, _COUNTS).group_by(["lang", "phrase", "size"], use_threads=False).aggregate([("a", "sum")])
        return found.rename_columns(["lang", "phrase", "size", "a"])

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= full:
            found = together()
            held, n = found.to_batches(), found.num_rows
            if n >= _HELD_COUNTS:
                yield from held
                held, n = [], 0
            full = n + _HELD_COUNTS
    if held:
        yield from together().to_batches()


def _global_counts(texts: DataFrame, words: Bloom, phrases: Bloom, total: int, max_words: int) -> DataFrame:
    """``(lang, phrase, size, a)`` of every phrase that the filter lets pass, over all texts.

    Most candidates stand in most tasks, so what is sent grows with the number of tasks. A task therefore reads up to
    ``TASK_WORDS`` words, as long as every core has one, and adds up its counts before they travel.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shards in _shards(batches, min(COUNT_WORDS, SHARD_WORDS)):
            for s in shards:
                for k, first, _, counts in _levels(s, words, max_words, 1, phrases.holds):
                    parts = [s.words.take(pa.array(s.ids[first + i])) for i in range(k)]
                    phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())).cast(pa.string())
                    columns = [pa.array([s.lang] * len(counts), pa.string()), phrase, pa.array(np.full(len(counts), k, np.int32))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], schema=_COUNTS)

    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_WORDS))
    found = texts.coalesce(tasks).mapInArrow(lambda batches: _added(count(batches)), "lang string, phrase string, size int, a long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, max_words: int = MAX_WORDS) -> DataFrame:
    """``(lang, phrase, size, a)`` of all phrases of 1 to ``max_words`` words with ``a >= support`` occurrences in a language.

    The row without a phrase, of size 0, has the number of words of the language. Texts of ``docs(lang, text)`` are
    lower-cased in A-Z and cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and tabs; a phrase lies
    within a piece, occurrences may overlap. A null text is empty, a null language is ``und``. Written to the shared folder.
    """
    if support < 1 or max_words < 1:
        raise ValueError("support and max_words must be at least 1")
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = materialise(_word_counts(texts).filter(F.col("word").isNull() | (F.col("a") >= support)))
    total = counted.filter("word IS NULL").agg(F.sum("a")).first()[0] or 0
    hashes = counted.filter("word IS NOT NULL").select(F.xxhash64("lang", "word").alias("hash"))
    words = bloom(hashes, "hash")
    ones = counted.select("lang", F.col("word").alias("phrase"), F.when(F.col("word").isNull(), 0).otherwise(1).alias("size"), "a")
    local = _local_phrases(texts, words, total, support, max_words)
    # The slack of a phrase is what all shards may leave out; ``above`` has been lowered by the shards that found it.
    union = materialise(local.filter(F.col("hash").isNull() | (F.col("above") >= 1)))
    slack = union.filter("hash IS NULL").agg(F.sum("missed")).first()[0] or 0
    phrases = bloom(union.filter(F.col("hash").isNotNull() & (F.col("above") + slack >= support)), "hash")
    more = _global_counts(texts, words, phrases, total, max_words).filter(F.col("a") >= support)
    return materialise(ones.unionByName(more))


def _part(first: int | Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, n), " ")


def collocations(
    docs: DataFrame, support: int = SUPPORT, max_words: int = MAX_WORDS, top: int = TOP, cover_percent: int = COVER_PERCENT
) -> DataFrame:
    """The best phrases of each language: ``(lang, rank, phrase, a, l, r, n, score)``.

    A phrase of 2 to ``max_words`` words with ``a >= support`` occurrences is cut after its first words into parts with ``l``
    and ``r`` occurrences; with ``n`` words in the language the score is ``floor(1000 a n / (l r))``, the least over all cuts, ties
    to the earliest. A phrase goes if a longer one with at least ``cover_percent`` per cent of its occurrences holds its words
    in a row. The ``top`` of a language come by score, then ``a``, both descending, then phrase in byte order.

    See :func:`frequent_phrases` for words, pieces, nulls. Repeated rows count as often as they stand, ids are not read. Texts
    without words and an empty table give no rows.
    """
    found = frequent_phrases(docs, support, max_words)
    phrases = found.filter("size >= 2").select("lang", "phrase", "size", "a")
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("first", _part(1, F.col("cut"))).withColumn("rest", _part(F.col("cut") + 1, F.col("size")))
    parts = found.filter(F.col("size").between(1, max_words - 1))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    totals = found.filter("size = 0").select("lang", F.col("a").alias("n"))
    # A language can hold most phrases, so its number of words goes to them; very many languages are joined.
    cuts = cuts.join(F.broadcast(totals) if fits(totals, _BROADCAST_ROWS) else totals, "lang")
    # Products of two counts may pass 64 bits; these are whole numbers of 38 digits.
    whole = "CAST({} AS DECIMAL(19, 0))".format
    score = F.expr(f"CAST(1000 AS DECIMAL(4, 0)) * ({whole('a')} * {whole('n')}) DIV ({whole('l')} * {whole('r')})")
    scored = cuts.withColumn("score", score.cast("long"))
    best = F.min(F.struct("score", "cut", "l", "r", "n"))
    scored = scored.groupBy("lang", "phrase", "a").agg(best.alias("best"))
    # Around a phrase, a frequent one of one word more has at least the occurrences of any longer one.
    inner = F.explode(F.array(_part(1, F.col("size") - 1), _part(2, F.col("size") - 1)))
    around = phrases.filter("size >= 3").select("lang", inner.alias("phrase"), F.col("a").alias("around"))
    around = around.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    open_ = scored.join(around, ["lang", "phrase"], "left")
    open_ = open_.filter(F.col("around").isNull() | (100 * F.col("around") < cover_percent * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = open_.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "best.n", "best.score"
    )


SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces
), starts AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split
), grams AS (
  SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase
  FROM starts, (SELECT unnest(range(1, {MAX_WORDS + 1})) AS size) WHERE i + size - 1 <= len(words)
), counted AS (
  SELECT lang, phrase, size, count(*) AS a FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang
), frequent AS (
  SELECT * FROM counted WHERE a >= {SUPPORT}
), cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(string_split(phrase, ' ')[1 : cut], ' ') AS first,
    array_to_string(string_split(phrase, ' ')[cut + 1 :], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM frequent WHERE size >= 2)
), scored AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, (1000::HUGEINT * c.a * n // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = first JOIN frequent y ON y.lang = c.lang AND y.phrase = rest
  JOIN totals t ON t.lang = c.lang
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1
), covered AS (
  SELECT lang, phrase, max(a) AS around FROM (
    SELECT lang, a, unnest(list_concat(
      list_transform(range(1, size), lambda i: array_to_string(string_split(phrase, ' ')[i : size - 1], ' ')),
      list_transform(range(2, size + 1), lambda i: array_to_string(string_split(phrase, ' ')[i : size], ' ')),
      list_transform(range(2, size - 1), lambda i: array_to_string(string_split(phrase, ' ')[i : size - 1], ' ')),
      list_transform(range(1, size), lambda i: array_to_string(string_split(phrase, ' ')[1 : i], ' ')))) AS phrase
    FROM frequent WHERE size >= 3) GROUP BY ALL
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, l, r, n, score
FROM scored s LEFT JOIN covered v ON v.lang = s.lang AND v.phrase = s.phrase
WHERE around IS NULL OR 100 * around < {COVER_PERCENT} * s.a
QUALIFY rank <= {TOP}
"""
