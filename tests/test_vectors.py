import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tokenloom.functions import vectors as vec
from tokenloom.functions import text as tx
from tokenloom.operators import embeddings, grams, similarity, windows


def cosine(spark, a, b):
    row = spark.createDataFrame([(a, b)], "a array<float>, b array<float>")
    return row.select(vec.cosine(F.col("a"), F.col("b"))).first()[0]


def test_cosine(spark):
    assert cosine(spark, [2.0, -1.0, 4.0], [1.0, 3.0, 0.5]) == pytest.approx(1 / math.sqrt(21 * 10.25), abs=1e-12)
    assert math.isnan(cosine(spark, [0.0, 0.0], [1.0, 2.0]))
    with pytest.raises(Exception, match="same length"):
        cosine(spark, [1.0, 2.0], [1.0, 2.0, 3.0])


def test_features(spark):
    row = spark.createDataFrame([([1, 2, 4],)], "w array<int>")
    raw, scaled = row.select(vec.scaled_features(F.col("w")), vec.scaled_features(F.col("w"), 4)).first()
    assert raw == [1.0, 2.0, 4.0] and scaled == [0.25, 0.5, 1.0]


def test_mean_vectors(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [0.0, 1.0])], "k int, v array<double>")
    got = {r.k: r.vector for r in vec.mean_vectors(rows, "k", "v").collect()}
    assert got == {1: [2.0, 3.0], 2: [0.0, 1.0]}


def test_dedup_prefers_input(spark):
    rows = [(1, "label", [1.0]), (1, "input", [2.0]), (2, "label", [3.0]), (3, "input", [5.0]), (3, "input", [4.0])]
    frame = spark.createDataFrame(rows, "token int, role string, vector array<double>")
    got = {r.token: (r.role, r.vector) for r in embeddings.dedup_vectors(frame).collect()}
    assert got == {1: ("input", [2.0]), 2: ("label", [3.0]), 3: ("input", [4.0])}


def test_dedup_of_nulls_ties_and_repeats(spark):
    rows = [(1, "input", None), (1, "input", []), (1, "input", [9.0]), (2, "input", None), (2, "label", [1.0])]
    rows += [(3, "label", [2.0, 3.0]), (3, "label", [2.0, 1.0]), (3, "zero", [0.0]), (None, "input", [1.0]), (None, None, [0.0])]
    rows += [(4, "input", [5.0, float(i % 3)]) for i in range(40)] + [(5, None, [7.0]), (5, "label", [1.0])]
    frame = spark.createDataFrame(rows, "token int, role string, vector array<double>")
    found = embeddings.dedup_vectors(frame)
    got = {r.token: (r.role, r.vector) for r in found.collect()}
    assert got == {
        1: ("input", [9.0]), 2: ("input", None), 3: ("label", [2.0, 1.0]), None: ("input", [1.0]), 4: ("input", [5.0, 0.0]), 5: (None, [7.0]),
    }
    assert "HashAggregate(keys=[t" in found._jdf.queryExecution().executedPlan().toString()
    assert embeddings.dedup_vectors(frame.limit(0)).count() == 0


def plain_top(vectors, k):
    out = []
    for a, va in vectors:
        scored = []
        for b, vb in vectors:
            if a == b:
                continue
            scale = math.sqrt(sum(x * x for x in va)) * math.sqrt(sum(x * x for x in vb))
            score = sum(x * y for x, y in zip(va, vb)) / scale if scale else math.nan
            scored.append((math.isnan(score), 0 if math.isnan(score) else -round(score, 10), b, score))
        out += [(a, rank, s[2], s[3]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return out


def check_top(spark, vectors, kind, k=5, chunk_bytes=1 << 20):
    frame = spark.createDataFrame(vectors, f"id {kind}, v array<double>").repartition(5)
    got = sorted(map(tuple, similarity.top_similar(frame, "id", "v", k, chunk_bytes).collect()))
    want = sorted(plain_top(vectors, k))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want):
        assert (math.isnan(g[3]) and math.isnan(w[3])) or g[3] == pytest.approx(w[3], abs=1e-9)


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 16 * 48, 3 * 48])
@pytest.mark.parametrize("tile", [4096, 10])
def test_top_similar_matches_all_pairs(spark, chunk_bytes, tile, monkeypatch):
    """In one stretch and in many, some shorter than a list; packed in one row and in several."""
    monkeypatch.setattr(similarity, "_PACK", tile)
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    check_top(spark, vectors, "long", chunk_bytes=chunk_bytes)


@pytest.mark.parametrize("rows,columns,dense", [(512, 2048, 1 / 16), (7, 5, 1 / 16), (16, 64, 0.0), (16, 64, 1.0)])
def test_similarity_kernel_over_tiles(rows, columns, dense, monkeypatch):
    """Very many ties: two stretches, their own pairs and those between them, against a plain sort."""
    for name, value in (("_ROWS", rows), ("_COLUMNS", columns), ("_DENSE", dense)):
        monkeypatch.setattr(similarity, name, value)
    rng = np.random.default_rng(4)
    units = rng.integers(-2, 3, size=(300, 4)).astype(float)
    units = units[np.abs(units).sum(1) > 0]
    units /= np.linalg.norm(units, axis=1)[:, None]
    n, cut = 6, 120
    keys = np.round(units @ units.T, 10)
    found = {}
    for a, b in ((slice(0, cut), None), (slice(cut, None), None), (slice(0, cut), slice(cut, None))):
        second = (None, 0) if b is None else (units[b], b.start)
        for low, best in similarity._compare(units[a], a.start, *second, n):
            for i, (others, scores) in enumerate(zip(best.others, best.scores)):
                found.setdefault(low + i, []).extend(zip(-np.round(scores, 10), others))
    for i, row in enumerate(keys):
        assert [other for _, other in sorted(found[i])[:n]] == np.lexsort((np.arange(len(units)), -row))[:n].tolist()


@pytest.mark.parametrize("size", [1, 3, 50, 768])
def test_single_precision_stays_within_its_bound(size):
    rng = np.random.default_rng(size)
    units = np.concatenate((rng.normal(size=(200, size)), np.exp(rng.normal(scale=9, size=(200, size)))))
    units /= np.linalg.norm(units, axis=1)[:, None]
    single = units.astype(np.float32) @ units.astype(np.float32).T
    assert np.abs(single - units @ units.T).max() <= similarity._rounding(size)


def test_returned_products_are_chains_of_fused_additions():
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(60, 50)), rng.normal(size=(60, 50)) * np.exp(rng.normal(scale=4, size=(60, 50)))
    want = []
    for x, y in zip(a.tolist(), b.tolist()):
        total = 0.0
        for p, q in zip(x, y):
            total = float(Fraction(p) * Fraction(q) + Fraction(total))
        want.append(total)
    rows = np.arange(60)
    assert similarity._chained(a, rows, b, rows).tolist() == want


def test_top_similar_sends_vectors_and_short_lists_only(spark):
    """What travels is every stretch once per stretch, then k + 1 entries per vector and stretch."""
    rng = np.random.default_rng(5)
    units = rng.normal(size=(50, 6))
    units /= np.linalg.norm(units, axis=1)[:, None]
    rows = [(i, unit.tolist(), [float(i), 1.0]) for i, unit in enumerate(units)]
    classes = spark.createDataFrame(rows, "place long, unit array<double>, v array<double>")
    classes = classes.select("*", F.col("place").alias("rep"), F.array("place").alias("ids"))
    best = similarity._nearest_classes(classes, 50, 5, 6, 20 * 48)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert all(len(r.best) == 6 and r.best[0].other == r.place for r in best.collect())


def test_vectors_travel_once_per_group_of_stretches(spark, monkeypatch):
    """Eight stretches to a group, and integers in doubles travel compressed; what they come to is still exact."""
    groups, in_group, in_stretch = similarity._layout(3_000_000, 50, 12, 16 << 20)
    assert groups <= 10 and groups * in_group >= 3_000_000
    assert in_stretch * 400 <= 16 << 20 and in_group * 400 <= similarity._GROUP * (16 << 20)
    rng = np.random.default_rng(6)
    whole = rng.integers(-3, 4, size=(500, 50)).astype(float)
    parts = [pa.record_batch([pa.array([0] * len(p)), pa.array(p.tolist()), pa.array([2.0] * len(p))], names=["low", "v", "norm"]) for p in np.split(whole, 4)]
    (pack,) = similarity._pack(iter(parts))
    vectors, norms = (pack.column(c)[0].as_py() for c in ("vectors", "norms"))
    assert len(vectors) * 4 < whole.nbytes
    assert np.array_equal(similarity._unpacked([(vectors, norms)], 50), whole / 2.0)
    for name, value in (("_GROUP", 3), ("_PACK", 4), ("_TOGETHER", 2), ("_COLUMNS", 1 << 20)):
        monkeypatch.setattr(similarity, name, value)
    many = [(i, v) for i, v in enumerate(rng.normal(size=(150, 6)).tolist())]
    check_top(spark, [*many, (500, [0.0] * 6), (-1, [0.0] * 6)], "long", chunk_bytes=10 * 48)


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 10 * 32])
def test_top_similar_with_copies_zeros_and_scaled_copies(spark, chunk_bytes):
    rng = np.random.default_rng(2)
    base = [rng.integers(-3, 4, size=4).astype(float).tolist() for _ in range(60)]
    vectors = [(f"w{i:03d}", v) for i, v in enumerate(base)]
    # A third of all rows are copies of one vector; others are its multiples, and some are zero.
    vectors += [(f"c{i:03d}", [1.0, 2.0, 0.0, 1.0]) for i in range(40)]
    vectors += [(f"m{i:03d}", [2.0 + i, 4.0 + 2 * i, 0.0, 2.0 + i]) for i in range(5)]
    vectors += [(f"z{i:03d}", [0.0] * 4) for i in range(8)]
    check_top(spark, vectors, "string", k=3, chunk_bytes=chunk_bytes)


def test_top_similar_edge_cases(spark):
    check_top(spark, [(1, [1.0, 0.0])], "long")
    check_top(spark, [(1, [0.0, 0.0]), (2, [0.0, 0.0])], "long")
    check_top(spark, [(3, [5.0, -1.0, 0.5]), (1, [0.25, 4.0, 4.0]), (2, [-2.0, 1.0, 7.0])], "long")
    uneven = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id long, v array<double>")
    with pytest.raises(ValueError, match="same length"):
        similarity.top_similar(uneven, "id", "v", 5)


def plain_cooccurrence(texts, distance, keep):
    out = {}
    for text in texts:
        items = text.split()
        for i, a in enumerate(items):
            for j, b in enumerate(items):
                if i != j and abs(i - j) <= distance and a in keep and b in keep:
                    out[(a, b)] = out.get((a, b), 0) + 1
    return out


def test_cooccurrence_with_and_without_vocabulary(spark, docs):
    texts = ["a b a c d e a a", "b a", "f", "c c c c c c c"]
    segments = windows.corpus_segments(docs(*texts), tx.words(F.col("text")))
    rows = embeddings.cooccurrence_counts(segments, 4).collect()
    assert {(r.word, r.context): r.n for r in rows} == plain_cooccurrence(texts, 4, set("abcdef"))
    ids = {"a": 10, "c": 11, "e": 12}
    known = spark.createDataFrame(list(ids.items()), "word string, token long")
    words = embeddings.cooccurrence_counts(segments, 4, known.select("word")).collect()
    expected = plain_cooccurrence(texts, 4, set(ids))
    assert {(r.word, r.context): r.n for r in words} == expected
    tokens = embeddings.cooccurrence_counts(segments, 4, known).collect()
    assert {(r.word, r.context): r.n for r in tokens} == {(ids[a], ids[b]): n for (a, b), n in expected.items()}


def travels_before_sums(frame):
    """Whether all aggregates of a plan with one shuffle come after it."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange") == 1 and plan.rindex("Aggregate(") < plan.index("Exchange")


def test_pairs_are_counted_in_runs_and_not_again_before_the_shuffle(spark, docs, monkeypatch):
    texts = ["a b a c d e a a", "", "b a", "f", "c c c c c c c", "d c b a " * 9]
    segments = windows.corpus_segments(docs(*texts), tx.words(F.col("text")), block=6, ahead=5)
    monkeypatch.setattr(embeddings, "_SLICE_PAIRS", 16)
    counts = embeddings.cooccurrence_counts(segments, 4)
    assert travels_before_sums(counts)
    assert {(r.word, r.context): r.n for r in counts.collect()} == plain_cooccurrence(texts, 4, set("abcdef"))


def test_counted_pairs_of_nulls_and_numbers():
    def counted(owned, rows, kind):
        found = embeddings._counted_pairs(np.array(owned), pa.array(rows, pa.list_(kind)), 2)
        return set(zip(*(x.to_pylist() for x in found)))

    assert counted([2], [["b", None, "a"]], pa.string()) == {("b", "b", 1), ("a", "b", 1), ("a", "a", 1)}
    assert counted([2, 2], [[None, None], [9, 10]], pa.int32()) == {(None, None, 1), (9, 10, 1)}
    assert counted([0, 1], [[], ["x"]], pa.string()) == set()
    assert list(embeddings._runs(iter([]), 5)) == []


def test_random_index_sums_where_a_word_is_whole(spark):
    pairs = spark.createDataFrame([("w", "x", 2), (None, "x", 1)], "word string, context string, n long")
    found = embeddings.random_index(pairs, 60)
    assert travels_before_sums(found) and {r.word for r in found.collect()} == {"w", None}


def test_random_index_is_linear_and_wide(spark):
    pairs = spark.createDataFrame([("w", "x", 2), ("w", "y", 3), ("u", "x", 1)], "word string, context string, n long")
    got = {r.word: np.array(r.vector) for r in embeddings.random_index(pairs, 120).collect()}
    assert set(got["u"]) == {-1, 1} and len(got["u"]) == 120
    assert set(np.unique(got["w"] - 2 * got["u"])) <= {-3, 3}
    assert abs(int(got["u"].sum())) < 60


@pytest.mark.parametrize("block", [4096, 6])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_context_vectors_equal_those_of_pair_counts(spark, docs, block, threshold):
    """Over whole documents and cut ones, with every word and with some, by broadcast and by plain joins."""
    texts = ["a b a c d e a a", "b a", "f", "", "c c c c c c c", "d c b a " * 9]
    segments = windows.corpus_segments(docs(*texts), tx.words(F.col("text")), block=block, ahead=5)
    assert max(len(r.tokens) for r in segments.collect()) <= block + 5
    known = spark.createDataFrame([("a",), ("c",), ("e",), ("b",), ("z",)], "word string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for vocabulary, words in ((None, "abcde"), (known, "abce")):
            counts = embeddings.cooccurrence_counts(segments, 4, vocabulary)
            assert {(r.word, r.context): r.n for r in counts.collect()} == plain_cooccurrence(texts, 4, set(words))
            got = {r.word: r.vector for r in embeddings.context_vectors(segments, 4, 60, vocabulary).collect()}
            assert got == {r.word: r.vector for r in embeddings.random_index(counts, 60).collect()}
            assert set(got) == set(words) and all(len(v) == 60 for v in got.values())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_vectors_that_cannot_be_compared(spark):
    odd = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [0.0, 0.0])]
    frame = spark.createDataFrame(odd, "id long, v array<double>")
    got = {(r.id, r["rank"]): (r.similar, r.score) for r in similarity.top_similar(frame, "id", "v", 4).collect()}
    assert len(got) == 20 and got[1, 1][0] == 2 and got[2, 1][0] == 1
    assert [got[3, i][0] for i in range(1, 5)] == [1, 2, 4, 5] and got[1, 2][0] == 3
    assert all(math.isnan(score) for (i, rank), (_, score) in got.items() if i > 2 or rank > 1)
    for bad in ([1.0, None], None, [1.0]):
        broken = spark.createDataFrame([(1, [1.0, 0.0]), (2, bad)], "id long, v array<double>")
        with pytest.raises(ValueError):
            similarity.top_similar(broken, "id", "v", 1)
        with pytest.raises((PySparkException, ValueError)):
            vec.mean_vectors(broken, "id", "v").collect()


def test_pairs_travel_as_packed_tables_of_a_run(docs):
    segments = windows.corpus_segments(docs("a b a c d e a a", "b a"), tx.words(F.col("text")))
    plan = embeddings.cooccurrence_counts(segments, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(bucket" in plan and "MapInArrow add" in plan


def test_random_index_of_packed_pairs_adds_up_the_signs_of_contexts(spark):
    """Keys and contexts may be null or repeat; numbers of both kinds of key are the sums of md5 bits."""
    rows = [(i % 7 if i % 5 else None, f"c{i % 11}" if i % 3 else None, i) for i in range(200)]

    def sign(context, d):
        text = f"{d // 52}" if context is None else f"{context}:{d // 52}"
        return (int(hashlib.md5(text.encode()).hexdigest()[:13], 16) >> d % 52 & 1) * 2 - 1

    want = {}
    for key, context, n in rows:
        want[key] = want.get(key, 0) + n * np.array([sign(context, d) for d in range(60)])
    for kind, made in (("long", lambda k: k), ("string", lambda k: None if k is None else f"k{k}")):
        pairs = spark.createDataFrame([(made(k), c, n) for k, c, n in rows], f"word {kind}, context string, n long")
        found = embeddings.random_index(pairs, 60)
        assert "Exchange hashpartitioning(bucket" in found._jdf.queryExecution().executedPlan().toString()
        assert {r.word: r.vector for r in found.collect()} == {made(k): v.tolist() for k, v in want.items()}


def test_sums_of_packed_pairs_are_put_together_as_tables_come(monkeypatch):
    monkeypatch.setattr(embeddings, "_SUMMED_PAIRS", 2)
    tables = []
    for keys in (["b", "a"], ["c", "a", "d"], ["a"], ["e", "b", "c", "f", "g"]):
        ids = np.stack((np.arange(len(keys)), np.zeros(len(keys), np.int64)))
        tables.append(grams.pack([pa.array(keys), pa.array(["x"])], ids, np.arange(1, len(keys) + 1)))
    keys, sums = embeddings._signed_sums(iter(tables), 52)
    sign = embeddings._sign_rows(["x"], 52)[0]
    assert {k: (s * sign).tolist() for k, s in zip(keys.to_pylist(), sums)} == {
        k: [n] * 52 for k, n in {"a": 5, "b": 3, "c": 4, "d": 3, "e": 1, "f": 4, "g": 5}.items()
    }
