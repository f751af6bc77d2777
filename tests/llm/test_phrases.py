"""Operator 13 against a plain version, and its edges."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tokenloom.llm import phrases, queries

SCHEMA = "lang string, text string"


def plain(rows, support, max_words=5, top=2000, percent=100):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang or "und" if lang is None else lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang, tuple(words[i : i + k])] += 1
    frequent = {p: a for p, a in counts.items() if a >= support}
    best = defaultdict(list)
    for (lang, words), a in frequent.items():
        if len(words) < 2:
            continue
        inside = [
            f
            for (other, longer), f in frequent.items()
            if other == lang and len(longer) > len(words) and 100 * f >= percent * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
        ]
        if inside:
            continue
        n = totals[lang]
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((1000 * a * n // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        best[lang].append((-score, -a, " ".join(words).encode(), left, right, n))
    out = []
    for lang, found in best.items():
        for rank, (score, a, phrase, left, right, n) in enumerate(sorted(found)[:top]):
            out.append((lang, rank + 1, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def mined(spark, rows, partitions=3, **options):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("x")).withColumn("n", F.lit(None).cast("int"))
    found = phrases.collocations(frame.repartition(partitions), **options)
    return sorted(map(tuple, found.collect()))


def made(seed, n):
    rng = np.random.default_rng(seed)
    words = np.array(["the", "The", "of", "new", "york", "city", "a", "ß", "x" * 300, "e.g", "don't", "日本", "und"])
    joints = np.array([" ", "  ", "\t", ", ", ".", "\n", " ", " ", " "])
    chance = 1 / np.arange(1, len(words) + 1)
    rows = []
    for _ in range(n):
        size = int(rng.integers(0, 40))
        picked = rng.choice(words, size, p=chance / chance.sum())
        rows.append((rng.choice(["en", "de", "und", None]), "".join(w + rng.choice(joints) for w in picked)))
    return rows


@pytest.mark.parametrize("support,partitions", [(2, 1), (5, 4), (9, 40)])
def test_equals_the_plain_version(spark, support, partitions):
    rows = made(support, 300)
    want = plain(rows, support)
    assert want and mined(spark, rows, partitions, support=support) == want


def test_small_shards_and_other_settings(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_SLICE_BYTES", 50)
    rows = made(1, 120)
    assert mined(spark, rows, support=4, max_words=3, top=7, cover_percent=60) == plain(rows, 4, 3, 7, 60)


def test_shards_cut_at_the_word_limit(monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_WORDS", 30)
    monkeypatch.setattr(phrases, "_SLICE_BYTES", 64)
    rows = made(6, 80)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] or "und" for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])
    shards = list(phrases._shards(iter([batch.slice(0, 33), batch.slice(33)])))
    assert len(shards) > 5
    words = Counter((s.lang, w) for shard in shards for s in shard for w in s.words.take(pa.array(s.ids)).to_pylist())
    want = Counter()
    for lang, text in rows:
        split = re.split(r"[.,;:!?\s]+", text.replace("The", "the"))
        want.update((lang or "und", w) for w in split if w)
    assert words == want


def test_edges(spark):
    long_text = "alpha beta gamma " * 20000
    rows = [("en", None), (None, None), ("en", ""), ("en", " \t\n.,"), ("fr", long_text), ("fr", "Alpha\tBETA"), ("fr", "alpha, beta")]
    rows += [("es", "uno dos"), ("es", "uno dos"), ("", "uno dos"), ("es", "dos uno dos"), (None, "uno dos uno dos")]
    for support in (2, 3):
        assert mined(spark, rows, support=support) == plain(rows, support)
    assert mined(spark, []) == [] == mined(spark, [("en", None), (None, "")])


def test_scores_beyond_64_bits(spark):
    # One line repeated: 1000 * a * n and l * r stay whole numbers however large; here they are checked as Spark works them out.
    cell = "CAST({} AS DECIMAL(19, 0))".format
    row = spark.sql("SELECT 4000000000000 AS a, 9000000000000000 AS n, 5000000000000 AS l, 7000000000001 AS r")
    found = row.selectExpr(f"CAST(1000 AS DECIMAL(4, 0)) * ({cell('a')} * {cell('n')}) DIV ({cell('l')} * {cell('r')}) AS score")
    assert found.first().score == 1000 * 4000000000000 * 9000000000000000 // (5000000000000 * 7000000000001)


def test_bloom_filters_keep_all_and_few_others(spark):
    rng = np.random.default_rng(2)
    held, others = rng.integers(-(2**63), 2**63 - 1, (2, 20000))
    made_ = phrases.bloom(spark.createDataFrame([(int(h),) for h in held], "hash long"), "hash")
    assert made_.holds(held.view(np.uint64)).all() and made_.holds(others.view(np.uint64)).mean() < 0.02
    assert not phrases.bloom(spark.createDataFrame([], "hash long"), "hash").holds(others.view(np.uint64)).any()


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = duck.sql(queries.ORACLES["op13_collocations"])
    got = queries.QUERIES["op13_collocations"](spark, SMALL)
    assert got.columns == want.columns
    rows = sorted(map(tuple, got.collect()))
    assert rows and rows == sorted(want.fetchall())


def test_a_task_sends_one_count_of_a_phrase_however_many_partitions_it_reads(spark, monkeypatch):
    rows = made(3, 400)
    texts = spark.createDataFrame([("en", text) for _, text in rows], SCHEMA)
    every = phrases.Bloom(np.full(16, 2**64 - 1, np.uint64), 4)
    want = Counter()
    for _, text in rows:
        for piece in re.split(r"[.,;:!?\n]", text.lower()):
            words = piece.split()
            want.update(" ".join(words[i : i + k]) for k in (2, 3) for i in range(len(words) - k + 1))
    sent = {}
    for partitions in (8, 96):
        counted = phrases._global_counts(texts.repartition(partitions), every, every, 8000, 3)
        assert {r.phrase: r.a for r in counted.collect()} == want
        local = texts.repartition(partitions)
        monkeypatch.setattr(type(local), "groupBy", lambda self, *by: self)
        monkeypatch.setattr(type(local), "agg", lambda self, *by: self)
        sent[partitions] = phrases._global_counts(local, every, every, 8000, 3).count()
        monkeypatch.undo()
    assert sent[96] < 1.2 * sent[8]


@pytest.mark.parametrize("held", [1, 7, 1000])
def test_counts_are_added_up_within_bounds(monkeypatch, held):
    monkeypatch.setattr(phrases, "_HELD_COUNTS", held)
    rng = np.random.default_rng(5)
    keys, counts = rng.integers(0, 40, 500), rng.integers(1, 9, 500)

    def batch(i):
        part = slice(i, i + 9)
        columns = [["en"] * len(keys[part]), [f"p {k}" for k in keys[part]], [2] * len(keys[part]), counts[part]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, phrases._COUNTS)], schema=phrases._COUNTS)

    got, want, rows = Counter(), Counter(), 0
    for part in phrases._added(map(batch, range(0, 500, 9))):
        rows += part.num_rows
        for p, a in zip(part.column(1).to_pylist(), part.column(3).to_pylist()):
            got[p] += a
    for k, c in zip(keys.tolist(), counts.tolist()):
        want[f"p {k}"] += c
    assert got == want and (rows == len(want) if held == 1000 else rows > len(want))


def test_a_task_mines_all_its_partitions_as_one_shard(spark):
    """One shard of each task takes the task's share; by partition the shares fall to one and nearly every phrase is sent."""
    rng = np.random.default_rng(8)
    rows = [("en", " ".join(f"w{x}" for x in rng.integers(0, 40, 60)) + " new york") for _ in range(960)]
    cores = spark.sparkContext.defaultParallelism
    every = phrases.Bloom(np.full(16, 2**64 - 1, np.uint64), 4)
    texts = spark.createDataFrame(rows, SCHEMA).repartition(96)
    local = phrases._local_phrases(texts, every, 960 * 62, 100, 5)
    assert local.filter("hash IS NULL").first().missed >= 100 - 3 * cores
    # The one frequent phrase, and those that chance brings to a share of about twelve: few of 1,600 pairs and more triples.
    found = local.filter("hash IS NOT NULL")
    assert 1 <= found.count() < 500 and found.agg(F.max("above")).first()[0] >= 960 - 100


@pytest.mark.parametrize("least,places,words", [(1, 1 << 21, 10**7), (2, 7, 10**7), (4, 50, 90)])
def test_mined_phrases_are_those_that_occur_often_enough_in_a_shard(monkeypatch, least, places, words):
    monkeypatch.setattr(phrases, "_PLACES", places)
    monkeypatch.setattr(phrases, "MINED_WORDS", words)
    monkeypatch.setattr(phrases, "COUNT_WORDS", 40)
    monkeypatch.setattr(phrases, "_SLICE_BYTES", 64)
    rows = made(9, 80)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] or "und" for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])
    every = phrases.Bloom(np.full(16, 2**64 - 1, np.uint64), 4)
    total, got = 0, Counter()
    for n, lines in phrases._lines(iter([batch]), every):
        total += n
        for line in lines:
            for hashes, counts in phrases._mined(line, 4, least):
                assert (counts >= least).all() and len(set(hashes.tolist())) == len(hashes)
                got.update(dict(zip(hashes.tolist(), counts.tolist())))
    want, n_words = Counter(), 0
    for shards in phrases._shards(iter([batch])):
        for s in shards:
            n_words += len(s.ids)
            for _, _, hashes, counts in phrases._levels(s, every, 4, 1, lambda h: np.ones(len(h), bool)):
                want.update(dict(zip(hashes.tolist(), counts.tolist())))
    assert total == n_words
    if words == 10**7:
        assert got == {h: a for h, a in want.items() if a >= least}
    else:
        assert got and all(a <= want[h] for h, a in got.items())
