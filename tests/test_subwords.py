import random
from collections import Counter

import pyarrow as pa
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.operators import counts, subwords
from tokenloom.plans.catalogue import FIXED_MERGES, WIDE_MERGES


def plain_training(frequencies, n):
    """One merge at a time, most frequent pair first, ties by the pair."""
    words = {w: list(w) for w in frequencies}
    merges = []
    while len(merges) < n:
        pairs = Counter()
        for word, parts in words.items():
            for pair in zip(parts, parts[1:]):
                pairs[pair] += frequencies[word]
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        merges.append(best)
        words = {w: plain_merge(parts, best) for w, parts in words.items()}
    return merges, words


def plain_merge(parts, pair):
    out, i = [], 0
    while i < len(parts):
        if tuple(parts[i : i + 2]) == pair:
            out.append(parts[i] + parts[i + 1])
            i += 2
        else:
            out.append(parts[i])
            i += 1
    return out


TEXTS = ["low lower lowest newer new wide wider aaaa aaa aa abab ababab", "banana bandana cabana abcabc 123456 1234", "the then them"]


@pytest.mark.parametrize("n, tried, rewritten", [(1, 32, 256), (10, 3, 4), (25, 32, 256), (500, 7, 9), (20, 1, 1)])
def test_training_equals_one_merge_at_a_time(docs, n, tried, rewritten, monkeypatch):
    monkeypatch.setattr(subwords, "_REWRITTEN", rewritten)
    frame = docs(*TEXTS)
    frequencies = {r.piece: r.frequency for r in counts.pretoken_frequency(frame).collect()}
    expected, words = plain_training(frequencies, n)
    merges = subwords.train_merges(frame, n, tried=tried)
    assert merges == expected
    ranks = subwords.rank_table(merges)
    assert {w: subwords.merge_word(w, ranks) for w in words} == words


def test_training_on_the_small_corpus(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    frequencies = {r.piece: r.frequency for r in counts.pretoken_frequency(frame).collect()}
    assert subwords.train_merges(frame, 80) == plain_training(frequencies, 80)[0]


def test_training_without_pairs(docs):
    assert subwords.train_merges(docs("a b c", ""), 5) == []


def plain_encoding(word, merges):
    parts = list(word)
    for pair in merges:
        parts = plain_merge(parts, pair)
    return parts


def test_words_are_merged_in_rank_order():
    """Random tables, in which pairs come up again at later ranks, and words with long runs."""
    draw = random.Random(5)
    for _ in range(300):
        letters, pieces, merges = "abc"[: draw.randint(1, 3)], set("abc"), []
        for _ in range(draw.randint(1, 12)):
            pair = (draw.choice(sorted(pieces)), draw.choice(sorted(pieces)))
            merges.append(pair)
            pieces.add("".join(pair))
        ranks = subwords.rank_table(merges)
        for _ in range(5):
            word = "".join(draw.choices(letters, k=draw.randint(0, 30)))
            assert subwords.merge_word(word, ranks) == plain_encoding(word, merges)


def test_a_very_long_word_is_merged_quickly():
    merges = [("a", "b")] + [("ab" * 2**i, "ab" * 2**i) for i in range(12)]
    assert subwords.merge_word("ab" * 2**15, subwords.rank_table(merges)) == ["ab" * 2**12] * 8


def test_pieces_of_the_small_corpus(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    pieces = counts.pretoken_frequency(frame).select("piece")
    for merges in (FIXED_MERGES, WIDE_MERGES):
        rows = pieces.select("piece", subwords.encode_pieces(F.col("piece"), merges).alias("p")).collect()
        assert all(r.p == plain_encoding(r.piece, merges) for r in rows[:: 1 if merges is FIXED_MERGES else 25])


def test_document_encodings_agree(docs):
    frame = docs("The thin thing, and then 12345!", "", None, "one", "?")
    for merges in (FIXED_MERGES, WIDE_MERGES, []):
        ids = {r.doc_id: r.tokens for r in subwords.encode_documents(frame, merges).collect()}
        named = {r.doc_id: r.tokens for r in subwords.document_pieces(frame, merges).collect()}
        pieces = subwords.vocabulary(merges)
        expected = [p for w in "the thin thing and then 123 45".split() for p in plain_encoding(w, merges)]
        assert [pieces[i] for i in ids[0]] == expected == named[0]
        assert ids[1] == [] == ids[4] == named[1]


def test_a_truncated_pair_table_is_counted_anew(spark, monkeypatch):
    """With few pairs held, others come up: the merges stay those of one at a time."""
    counted = subwords._counted_pairs
    limits = []

    def few(split, done, limit, pieces):
        limits.append(limit)
        return counted(split, done, 4, pieces)

    monkeypatch.setattr(subwords, "_counted_pairs", few)
    draw = random.Random(3)
    words = {"".join(draw.choices("abcde", k=draw.randint(2, 7))): draw.randint(1, 30) for _ in range(40)}
    frame = spark.createDataFrame(list(words.items()), "piece string, frequency long")
    assert subwords.merges_of_pieces(frame, 25) == plain_training(words, 25)[0]
    assert len(limits) > 2


def test_frequency_matches_document_tokens(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    by_vocabulary = subwords.subword_frequency(frame, FIXED_MERGES).select("token", "frequency")
    by_document = counts.count_items(subwords.encode_documents(frame, FIXED_MERGES), F.col("tokens"), "token")
    assert by_vocabulary.exceptAll(by_document).count() == 0
    assert by_document.exceptAll(by_vocabulary).count() == 0


def test_vocabulary_decodes_every_token(spark):
    decode = {r.token: r.word for r in subwords.vocabulary_frame(spark, FIXED_MERGES).collect()}
    assert decode[0] == "a" and decode[35] == "9" and decode[36] == "th" and len(set(decode.values())) == len(decode)


def test_pretokens_of_whole_text_equal_those_of_words(spark, docs):
    frame = docs("abc-12 34x é5 6", "a\n1")
    whole = frame.select(tx.pretokens(F.col("text")).alias("p")).collect()
    assert [r.p for r in whole] == [["abc", "12", "34", "x", "5", "6"], ["a", "1"]]


def test_merge_table_round_trip(spark):
    table = subwords.merges_frame(spark, FIXED_MERGES).repartition(4)
    assert subwords.merges_from_frame(table) == FIXED_MERGES
    with pytest.raises(ValueError, match="more than 3"):
        subwords.merges_from_frame(table, limit=3)


def test_pairs_of_a_symbol_with_itself_are_trained_one_at_a_time(spark):
    cases = [{"000": 1000, "12": 500, "xy": 300}]
    draw = random.Random(11)
    for _ in range(3):
        cases.append({"".join(draw.choices("ab0", k=draw.randint(2, 6))): draw.randint(1, 40) for _ in range(12)})
    for words in cases:
        frame = spark.createDataFrame(list(words.items()), "piece string, frequency long")
        assert subwords.merges_of_pieces(frame, 6) == plain_training(words, 6)[0]


def test_long_batches_are_laid_out_in_runs(monkeypatch):
    """A batch of any size comes back in runs of a bounded number of pre-tokens, with the same tokens."""
    batch = pa.array([["the", "then"], None, [], ["other"] * 7, ["in"], ["the", "rest"]], pa.list_(pa.string()))
    merges = [("t", "h"), ("th", "e")]
    whole = [x for run in subwords._laid_out(merges, pieces=True)(iter([batch])) for x in run.to_pylist()]
    assert whole[0] == ["the", "the", "n"] and whole[1:3] == [[], []] and len(whole) == 6
    monkeypatch.setattr(subwords, "_UNITS", 3)
    runs = [run.to_pylist() for run in subwords._laid_out(merges, pieces=True)(iter([batch]))]
    assert len(runs) > 2 and [x for run in runs for x in run] == whole


def test_training_passes_carry_out_few_merges_and_count_pairs_once(spark, monkeypatch):
    letters = np.random.default_rng(3)
    words = ["".join(letters.choice(list("abcdefgh"), p=[0.3, 0.2, 0.15, 0.1, 0.1, 0.05, 0.05, 0.05], size=6)) for _ in range(300)]
    counted = spark.createDataFrame([(w, 1 + i % 7) for i, w in enumerate(sorted(set(words)))], "piece string, frequency long")
    passes = []
    changes = subwords._changes

    def recorded(split, done, tried):
        passes.append((len(done), len(tried)))
        return changes(split, done, tried)

    monkeypatch.setattr(subwords, "_changes", recorded)
    monkeypatch.setattr(subwords, "_REWRITTEN", 8)
    merges = subwords.merges_of_pieces(counted, 40)
    assert len(merges) == 40
    assert [done for done, tried in passes if not tried] == [0]
    assert max(done for done, _ in passes) < 8
    assert min(tried for _, tried in passes[2:4]) < 32
    monkeypatch.setattr(subwords, "_changes", changes)
    assert merges == subwords.merges_of_pieces(counted, 40, tried=1)
