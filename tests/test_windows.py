import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.operators import counts, grams, ordering, windows


def sliding(items, w):
    return [items[i : i + w] for i in range(len(items) - w + 1)]


def corpus(docs, *texts):
    return windows.corpus_segments(docs(*texts), tx.words(F.col("text")))


TEXTS = ["t1 t2 t3 t4 t5", "a b", "", "a b c d", "p q r s t u v w x", "z z z z z z z"]


def test_five_tokens_give_one_window(docs):
    rows = windows.context_windows(corpus(docs, "token1 token2 token3 token4 token5"), 4).collect()
    assert [(r.pos, r.input, r.label, r.is_last) for r in rows] == [
        (0, ["token1", "token2", "token3", "token4"], "token5", True)
    ]


def test_short_sequences_give_nothing(docs):
    assert windows.context_windows(corpus(docs, "a b", "a b c d", ""), 4).count() == 0


@pytest.mark.parametrize("w", [1, 2, 4])
def test_windows_match_plain_sliding(docs, w):
    got = {}
    for r in windows.context_windows(corpus(docs, *TEXTS), w).orderBy("seq", "pos").collect():
        got.setdefault(r.seq, []).append((r.input, r.label))
    for i, text in enumerate(TEXTS):
        assert got.get(i, []) == [(x[:-1], x[-1]) for x in sliding(text.split(), w + 1)]


@pytest.mark.parametrize("w", [1, 2, 4])
def test_second_level_windows_match_plain_sliding(docs, w):
    found = windows.context_windows(corpus(docs, *TEXTS), w)
    flat, labels = {}, {}
    for r in windows.flattened_windows(found, w).orderBy("seq", "idx").collect():
        flat.setdefault(r.seq, []).append((r.idx, r.tokens))
    for r in windows.label_windows(found, w).orderBy("seq", "idx").collect():
        labels.setdefault(r.seq, []).append((r.idx, r.tokens))
    both = []
    for i, text in enumerate(TEXTS):
        grams = sliding(text.split(), w + 1)
        inputs, outputs = [t for g in grams for t in g[:-1]], [g[-1] for g in grams]
        assert flat.get(i, []) == list(enumerate(sliding(inputs, w)))
        assert labels.get(i, []) == list(enumerate(sliding(outputs, w)))
        both += [tuple(x) for x in sliding(inputs, w) + sliding(outputs, w)]
    weighted = {tuple(r.tokens): r.weight for r in windows.training_windows(found, w).collect()}
    assert weighted == {x: both.count(x) for x in both}


def test_flattened_windows_take_tokens_one_by_one(spark):
    """No window is sliced and joined again for each of its places."""
    found = spark.createDataFrame([(0, 0, list("abc"), False), (0, 1, list("bcd"), True)], "seq int, pos long, input array<string>, is_last boolean")
    flat = windows.flattened_windows(found, 3)
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" not in plan and "concat(" not in plan
    assert sorted((r.idx, "".join(r.tokens)) for r in flat.collect()) == [(0, "abc"), (1, "bcb"), (2, "cbc"), (3, "bcd")]


@pytest.mark.parametrize("n", [0, 1, 5, 6, 12, 13, 14, 15, 16, 17, 18, 36])
def test_listing_windows_cross_segment_borders(spark, n):
    w, block = 4, 6
    indexed = spark.range(n).select(F.col("id").alias("idx"), F.concat(F.lit("t"), "id").alias("token"))
    segments = windows.listing_segments(indexed, "token", w, block=block)
    assert all(len(r.tokens) <= block + w + 1 for r in segments.collect())
    found = windows.context_windows(segments, w)
    rows = sorted((r.pos, r.input, r.label, r.is_last) for r in found.collect())
    plain = sliding([f"t{i}" for i in range(n)], w + 1)
    assert rows == [(i, g[:-1], g[-1], i == len(plain) - 1) for i, g in enumerate(plain)]
    pairs = sorted(map(tuple, windows.forward_pairs(segments, w).collect()))
    assert pairs == sorted((f"t{i}", f"t{j}") for i in range(n) for j in range(i + 1, min(n, i + w + 1)))


def test_global_index_is_dense_and_ordered(spark):
    rows = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("word"))
    got = ordering.global_index(rows.repartition(7), "word").collect()
    assert [r.word for r in sorted(got, key=lambda r: r.idx)] == sorted(r.word for r in rows.collect())
    assert sorted(r.idx for r in got) == list(range(1000))


def test_global_index_of_nothing(spark):
    assert ordering.global_index(spark.range(0), "id").collect() == []


def test_role_and_position_counts(docs):
    found = windows.context_windows(corpus(docs, "a b a c d e"), 4)
    roles = {(r.role, r.token): r.n for r in counts.role_token_counts(found).collect()}
    assert roles[("input", "a")] == 3 and roles[("label", "d")] == 1 and roles[("label", "e")] == 1
    places = {(r.token, r.position): r.n for r in counts.window_positions(found).collect()}
    assert places[("a", 0)] == 1 and places[("a", 1)] == 1 and places[("a", 2)] == 1


@pytest.mark.parametrize("w", [1, 2, 3, 4, 5])
def test_training_windows_count_rotations_and_windows_that_end_as_they_begin(docs, w):
    rng = random.Random(w)
    texts = [" ".join(rng.choice("abc"[: 1 + i % 3]) for _ in range(i)) for i in range(40)]
    want = Counter()
    for text in texts:
        grams = sliding(text.split(), w + 1)
        inputs, outputs = [t for g in grams for t in g[:-1]], [g[-1] for g in grams]
        want.update(map(tuple, sliding(inputs, w) + sliding(outputs, w)))
    found = windows.training_windows(windows.context_windows(corpus(docs, *texts), w), w).collect()
    assert {tuple(r.tokens): r.weight for r in found} == want and len(found) == len(want)


def test_training_windows_of_numbers_travel_in_one_shuffle(spark):
    indexed = spark.range(30).select(F.col("id").alias("idx"), (F.col("id") % 4).alias("token"))
    found = windows.training_windows(windows.context_windows(windows.listing_segments(indexed, "token", 4), 4), 4)
    grams = sliding([i % 4 for i in range(30)], 5)
    inputs, outputs = [t for g in grams for t in g[:-1]], [g[-1] for g in grams]
    assert {tuple(r.tokens): r.weight for r in found.collect()} == Counter(map(tuple, sliding(inputs, 4) + sliding(outputs, 4)))
    plain = spark.range(9).select(F.lit(0).alias("pos"), F.lit(True).alias("is_last"), F.array(*[F.lit(x) for x in "abcd"]).alias("input"), F.lit("e").alias("label"))
    plan = windows.training_windows(plain, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_training_windows_leave_a_run_as_one_packed_table_for_each_bucket(docs):
    """What travels are tables of a run's windows by bucket, not rows of joined tokens."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(60)) for _ in range(40)]
    found = windows.training_windows(windows.context_windows(corpus(docs, *texts).coalesce(1), 4), 4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(bucket" in plan
    want = Counter()
    for text in texts:
        g = sliding(text.split(), 5)
        want.update(map(tuple, sliding([t for x in g for t in x[:-1]], 4) + sliding([x[-1] for x in g], 4)))
    assert {tuple(r.tokens): r.weight for r in found.collect()} == want


@pytest.mark.parametrize("at_a_time", [3, 1 << 22])
def test_tables_of_many_runs_are_put_together_in_passes(monkeypatch, at_a_time):
    monkeypatch.setattr(grams, "_PASS", at_a_time)
    rng, want, tables = random.Random(1), Counter(), []

    def homes(hashes, ids):
        return grams.mixed(hashes[ids].sum(0))

    for _ in range(6):
        rows = Counter(tuple(rng.choice(["a", "b", None, "ü"]) for _ in range(3)) for _ in range(30))
        want.update(rows)
        words, ids = grams.coded(pa.array([t for row in rows for t in row], pa.string()))
        ids, n = ids.reshape(-1, 3).T, np.array(list(rows.values())) << 20
        for batch in grams.deal([words], ids, n, homes(grams.token_hashes(words), ids), 2):
            tables.append(batch)
    got = []
    for packed in grams.by_bucket(sorted(tables, key=lambda t: t.column(0)[0].as_py())):
        for words, ids, n in grams.whole(packed, 2, homes):
            got += zip(zip(*(words.take(pa.array(row)).to_pylist() for row in ids)), n.tolist())
    assert dict(got) == {row: n << 20 for row, n in want.items()} and len(got) == len(want)
