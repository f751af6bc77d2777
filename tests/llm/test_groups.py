"""Operators 2, 7, 9 and 10 against plain versions."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from conftest import SMALL

from tokenloom.llm import common, mixing, queries, sharding, simhash, topk


def least(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# Components


def test_components_of_chains_stars_and_random_links(spark):
    rng = np.random.default_rng(5)
    names = rng.permutation(np.unique(rng.integers(-(2**62), 2**62, 700))).tolist()
    pairs = list(zip(names[:200], names[1:201])) + [(names[300], n) for n in names[301:400]]
    pairs += [tuple(x) for x in rng.choice(names[400:], (150, 2)).tolist()] + [(names[250], names[250])]
    found = dict(common.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    nodes = {n for p in pairs for n in p if p[0] != p[1]}
    want = least(nodes, [p for p in pairs if p[0] != p[1]])
    groups = defaultdict(set)
    for n in nodes:
        groups[found[n]].add(want[n])
    assert set(found) == nodes and all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# SimHash


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    to, out = least(range(len(rows)), pairs), []
    ids = defaultdict(list)
    for i, r in to.items():
        ids[r].append(rows[i][0])
    for i, (d, _) in enumerate(rows):
        known = [x for x in ids[to[i]] if x is not None]
        out.append((d, f"{prints[i]:016x}", min(known) if known else None))
    return sorted(out, key=repr)


def test_simhash_query_is_the_plain_grouping(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op2_simhash"](spark, SMALL)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_groups(rows)


def test_spark_hash_is_the_named_one(spark):
    from pyspark.sql import functions as F

    texts = ["", "a", "hello world abc def", "é😀 x", "y" * 1000]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t"))
    assert [r[0] % 2**64 for r in frame.collect()] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


@pytest.fixture
def odd_rows():
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(1, None), (2, ""), (None, " \n "), (3, "one"), (4, "ONE"), (None, "one"), (5, "one two three"), (6, base)]
    rows += [(7, base + " tail"), (7, base + " tail"), (8, base.replace("w5 ", "v5 ")), (9, "word " * 30000), (10, "Word " * 30000)]
    return rows


def test_simhash_edges(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, "doc_id long, text string")
    assert sorted(map(tuple, simhash.simhash_groups(docs).collect()), key=repr) == plain_groups(odd_rows)
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark, odd_rows):
    rows = [(d, t, i, "x") for i, (d, t) in enumerate(odd_rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id int, fp string")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted(r.doc_id for r in kept.collect())
    assert got == sorted({c for _, _, c in plain_groups(odd_rows)})
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_large_buckets_are_tiled_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(9)
    values = [int(x) for x in np.unique(rng.integers(0, 2**63, 40))]
    for v in values[:8]:
        for _ in range(60):
            for b in rng.choice(64, rng.integers(0, 4), replace=False).tolist():
                v ^= 1 << b
            values.append(v)
    values = sorted(set(values))
    signed = [v - 2**64 if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    pairs = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 4]
    want = least(values, pairs)
    for tile in (simhash.TILE, 16):
        monkeypatch.setattr(simhash, "TILE", tile)
        found = [(a % 2**64, b % 2**64) for a, b in simhash.links(frame).collect()]
        assert all((a, b) for a, b in found) and least(values, found) == want


def test_carry_save_counters_count_bits():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 2**63, 300).astype(np.uint64)
    values[1::2] = values[::2] ^ np.uint64(0b1011)
    planes = simhash._planes(values)
    for lag in (1, 2, 63, 64, 65, 200):
        active = np.zeros(planes.shape[1] * 64, bool)
        active[: len(values) - lag] = True
        for radius in (0, 2, 3, 4, 7):
            want = [i for i in range(len(values) - lag) if int(values[i] ^ values[i + lag]).bit_count() <= radius]
            assert simhash.lanes_within(planes, lag, active, radius).tolist() == want


# Top-k


def plain_top(rows, k=5, every=50):
    usable = [(i, [float(x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in usable]
    asked = {}
    for i, v in sorted(usable):
        if i % every == 0:
            asked.setdefault(i, [int(np.floor(256 * x)) for x in v])
    out = []
    for q, v in asked.items():
        scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_top_k_query_is_the_plain_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.QUERIES["op7_topk"](spark, SMALL)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain_top(rows)


def test_top_k_edges(spark, monkeypatch):
    rows = [(0, [1.0, -2.0]), (50, [0.5, 0.25]), (50, [0.5, 0.25]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [1.0, None])]
    rows += [(5, [float("nan"), 1.0]), (6, [1.0, float("inf")]), (None, [9.0, 9.0]), (7, [1.0]), (100, [2.0]), (150, []), (8, [0.0, 0.0])]
    rows += [(2, [1.0, 1.0]), (200, [1.0, 2.0, 3.0]), (9, [5e6, 5e6]), (-50, [5e6, -2e6])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = plain_top(rows)
    assert sorted(map(tuple, topk.top_products(frame).collect())) == want
    monkeypatch.setattr(topk, "PASS_BYTES", 40)
    assert sorted(map(tuple, topk.top_products(frame).collect())) == want
    assert topk.top_products(frame.limit(0)).count() == 0


def test_segment_bounds_hold():
    rng = np.random.default_rng(4)
    q, x = rng.normal(size=(20, 64)), rng.normal(size=(30, 64))
    for s in topk.SEGMENTS:
        assert (topk.statistics(q, s) @ topk.statistics(x, s).T >= q @ x.T - 1e-9).all()


# Mixing


def make_mix(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, mix int")


def test_mixing_without_a_budget_uses_all_and_repeats_small_sources(spark):
    rng = np.random.default_rng(6)
    rows, sizes = [], {"a": 900, "b": 100, "c": 30, None: 10}
    for source, n in sizes.items():
        rows += [(len(rows) + i, "w " * int(rng.integers(1, 40)), source, 1) for i in range(n)]
    docs = make_mix(spark, rows)
    tokens = defaultdict(int)
    for _, t, s, _ in rows:
        tokens[s] += len(t.split())
    for limit in (1.0, 2.0, 3.5):
        used = mixing.mix(docs, max_epochs=limit, epoch="epoch", order="place")
        assert used.columns == [*docs.columns, "epoch", "place"]
        times, got = defaultdict(int), defaultdict(int)
        for r in used.collect():
            times[r.doc_id] += 1
            got[r.source] += len(r.text.split())
            assert 0 <= r.place < 1
        assert set(times) == set(range(len(rows))) and max(times.values()) <= np.ceil(limit)
        assert got["a"] == tokens["a"]
        assert limit * tokens[None] - 40 <= got[None] <= limit * tokens[None]
        # One exponent for all sources.
        share = {s: tokens[s] / sum(tokens.values()) for s in sizes}
        e = 1 - np.log(limit) / np.log(share["a"] / share[None])
        for s in sizes:
            want = tokens[s] * (share[s] / share["a"]) ** (e - 1)
            assert want - 45 <= got[s] <= want + 1


def test_mixing_meets_a_target_entropy_within_the_budget(spark):
    rows = [(i, "w " * (1 + i % 9), "abcdefgh"[min(7, int(np.log2(i + 1)))], 0) for i in range(3000)]
    docs = make_mix(spark, rows)
    plan = mixing.mixing_plan(docs, budget=9000, target_entropy=0.9, max_epochs=None).collect()
    w = np.array([r.weight for r in plan])
    assert abs(w.sum() - 1) < 1e-9 and abs(-(w * np.log(w)).sum() / np.log(len(w)) - 0.9) < 1e-5
    got = defaultdict(int)
    for r in mixing.mix(docs, budget=9000, target_entropy=0.9, max_epochs=None).collect():
        got[r.source] += len(r.text.split())
    assert all(r.weight * 9000 - 10 <= got[r.source] <= r.weight * 9000 for r in plan)


def test_mixing_edges(spark):
    rows = [(1, None, "a", 0), (2, "", None, 0), (None, "x y", "b", 0), (3, "x y", "b", 0), (3, "x y", "b", 0), (4, "long " * 50000, "c", 0)]
    docs = make_mix(spark, rows)
    used = mixing.mix(docs, max_epochs=2.0)
    assert used.columns == docs.columns
    assert {(r.doc_id, r.source) for r in used.collect()} == {(r[0], r[2]) for r in rows}
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs.filter("doc_id < 3")).count() == 2


# Sharding


def test_shards_are_balanced_contiguous_and_gapless(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    texts = {r.doc_id: r.text or "" for r in table}
    rows = queries.QUERIES["op10_sharding"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    places, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        places[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    target, largest = sum(sizes.values()) / 24, max(r.size for r in rows)
    assert all(abs(sizes[s] - target) <= largest + 2 * sharding.SLACK * target for s in range(24))


def test_equal_texts_stay_together_where_they_fit(spark):
    rows = [(i, f"text {i % 500} " * 3) for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shards = defaultdict(set)
    for r in sharding.shard_by_bytes(docs, 8).collect():
        shards[r.text].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_shard_edges(spark):
    rows = [(1, None, 1), (None, "", 2), (2, "x" * 100000, 3), (3, "y", 4), (3, "y", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    got = sharding.shard_by_bytes(docs, 4)
    assert got.columns == [*docs.columns, "size", "shard", "slot"]
    places = defaultdict(list)
    for r in got.collect():
        places[r.shard].append(r.slot)
    assert sum(map(len, places.values())) == 5 and all(sorted(p) == list(range(len(p))) for p in places.values())
    assert sharding.shard_by_bytes(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_by_bytes(docs.withColumn("Shard", docs.part))
