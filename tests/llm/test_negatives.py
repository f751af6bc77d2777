"""Operator 12 against a plain version, its intervals, and its edges."""

import duckdb
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tokenloom.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<double>, label int"
NAN, INF = float("nan"), float("inf")


def plain(rows, k=5, every=100, percent=80):
    usable = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, label, [int(np.floor(256.0 * x)) for x in v]))
    out = []
    for anchor in {i for i, _, _ in usable if i % every == 0}:
        _, label, q = min((r for r in usable if r[0] == anchor), key=lambda r: (r[1], r[2]))
        scored = [
            (min(max(-sum(a * b for a, b in zip(q, v)), -(2**63 - 1)), 2**63), i, other == label)
            for i, other, v in usable
            if i != anchor and len(v) == len(q)
        ]
        scored = sorted((-s, i, same) for s, i, same in scored)
        scored.sort(key=lambda r: (-r[0], r[1]))
        for ps, p, _ in [r for r in scored if r[2]][:k]:
            near = [r for r in scored if not r[2] and percent * ps <= 100 * r[0] <= 100 * ps][:k]
            out += [(anchor, p, n + 1, i, ps, s) for n, (s, i, _) in enumerate(near)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("x")).withColumn("score", F.lit(None).cast("int"))
    return sorted(map(tuple, negatives.hard_negatives(frame.repartition(3), **options).collect()))


def made(rng, n, size, labels=3, scale=1.0):
    return [(int(i), (scale * rng.normal(size=size)).tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("size,scale", [(8, 1.0), (64, 0.125), (100, 1.0), (64, 1e8), (5, 1e140)])
def test_equals_the_plain_version(spark, size, scale):
    rows = made(np.random.default_rng(size), 400, size, scale=scale)
    assert mined(spark, rows, every=20) == plain(rows, every=20)


def test_passes_do_not_change_the_result(spark):
    rows = made(np.random.default_rng(3), 300, 16)
    assert mined(spark, rows, every=10, pass_bytes=1500) == plain(rows, every=10)


def test_edges(spark):
    rows = made(np.random.default_rng(9), 250, 6, labels=2)
    rows += [(300, None, 1), (None, [1.0] * 6, 1), (400, [1.0] * 6, None), (500, [1.0, NAN] + [0.0] * 4, 1)]
    rows += [(600, [1.0, INF] + [0.0] * 4, 1), (700, [1.0, None] + [0.0] * 4, 0), (800, [], 1), (801, [], 1), (802, [], 0)]
    rows += [(900, [0.0] * 6, 0), (901, [0.5] * 3, 0), (1000, [0.5] * 3, 0), (902, [0.5] * 3, 1), (903, [0.4] * 3, 1)]
    # Ties, copies of a vector, and repeated rows, of an anchor too.
    rows += [(2000 + i, rows[1][1], i % 2) for i in range(30)] + [rows[5], rows[5], rows[100], (100, rows[3][1], 1)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == [] == mined(spark, [(100, [1.0], 1)])


def test_one_label_for_all_and_few_rows(spark):
    rows = [(i, [float(i % 7), 1.0], 4) for i in range(0, 300, 50)]
    assert mined(spark, rows) == [] == plain(rows)


def test_intervals_hold_the_products_and_leave_few_rows():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(4000, 64)) / 8)
    codes, aligned = negatives.encoded(x)
    scored = 0
    for q in x[:40]:
        query, truth = negatives.Query(q), x @ q

        def holds(low, high):
            # No row is closed here, so all stand at their places.
            assert ((low <= truth) & (truth <= high)).all()
            return np.ones(len(low), bool)

        assert len(query.intervals(codes, aligned, holds)) == len(x)
        lists = negatives.Lists([(-(2**63), 2**63 - 1)], 5)
        at = query.intervals(codes, aligned, lists.open)
        lists.add(at, query.scores(x[at], aligned[at, 0]))
        assert lists.ids[0].tolist() == sorted(range(len(x)), key=lambda i: (-truth[i], i))[:5]
        scored += len(at)
    # Vectors without any structure: under one in fifty is multiplied out.
    assert scored / (40 * len(x)) < 0.02


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    want = duck.sql(queries.ORACLES["op12_hard_negatives"])
    got = queries.QUERIES["op12_hard_negatives"](spark, SMALL)
    assert got.columns == want.columns
    rows = sorted(map(tuple, got.collect()))
    assert rows and rows == sorted(want.fetchall())
