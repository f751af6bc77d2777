"""Operator 11 against a plain version, and its edges."""

import hashlib
import re

import duckdb
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tokenloom.llm import merkle, queries

SECTION, PARAGRAPH = (re.compile(p.replace("\\x{80}-\\x{10FFFF}", "\x80-\U0010ffff")) for p in (merkle.SECTION, merkle.PARAGRAPH))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(text):
    sections = [[sha(p) for p in PARAGRAPH.findall(s)] for s in SECTION.findall(text or "")]
    root = sha("".join(sha("".join(s)) for s in sections))
    return "|".join([root] + [sha("".join(s))[:16] + ":" + ",".join(p[:8] for p in s) for s in sections])


def near(a, b):
    if a == b:
        return 1.0
    a, b = (dict.fromkeys(t.split("|")[1:]) for t in (a, b))
    leaves = [set(x for s in t if s not in other for x in s.split(":")[1].split(",")) for t, other in ((a, b), (b, a))]
    same = sum(len(s.split(",")) for s in a if s in b)
    total = 2 * same + len(leaves[0]) + len(leaves[1])
    return min(2.0 * (same + len(leaves[0] & leaves[1])) / total, 1 - 1.0 / total)


def plain(rows):
    rows = [(i, text or "") for i, text in rows]
    known = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1].encode()))
    pairs = [(r, known[(at + 1) % len(known)][1]) for at, r in enumerate(known)] + [(r, None) for r in rows if r[0] is None]
    out = []
    for (i, text), after in pairs:
        n = len(text)
        edited = text[: n - n // 4] + (after or "")[: n // 4]
        a, b = tree(text), tree(edited)
        out.append((i, n, sha(edited), a, b, near(a, b), 0.0 if after is None else near(a, tree(after))))
    return sorted(out, key=repr)


def report(df):
    return sorted((tuple(r) for r in merkle.edited_report(df).collect()), key=repr)


LONG = "".join(f"Section {i} says that word{i % 7} follows {i * i}.\n" for i in range(4000))
EDGES = [
    (1, "One line.\nAnother line ends here.\n"),
    (2, None),
    (3, ""),
    (5, LONG),
    (5, LONG),
    (5, "The least text of this id"),
    (-4, "a negative id"),
    (None, "a text without an id, long enough to lose its last quarter"),
    (None, None),
    (9, "日本語の文章。" * 40 + "\n" + "ß𝄞é " * 60),
    (12, "\n\n\n\n"),
    (2**62, LONG.replace("Section 40 ", "Section forty ")),
]


def test_whole_table_and_edges(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert report(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)
    # Columns with the names of the result do not matter.
    clash = spark.createDataFrame(EDGES, "doc_id long, text string").withColumn("fingerprint", F.lit(1)).withColumn("n_chars", F.lit("x"))
    assert report(clash.repartition(3)) == plain(EDGES)


@pytest.mark.parametrize("rows", [[], [(7, "alone and next to itself, which is all there is to it")], [(None, None)]])
def test_few_rows(spark, rows):
    assert report(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_equal_texts_have_equal_fingerprints_and_others_differ(spark):
    texts = ["", "a", "a\n", "a\na\n", LONG, LONG + " "]
    found = spark.createDataFrame([(t,) for t in texts * 2], "text string").select("text", merkle.fingerprint("text").alias("f")).collect()
    assert len({r.f for r in found}) == len(texts) and len({(r.text, r.f) for r in found}) == len(texts)


def test_edits_are_located(spark):
    changed = LONG.replace("Section 2000 says", "Section 2000 denies")
    pairs = spark.createDataFrame([(1, LONG, changed), (2, LONG, LONG), (3, None, "new"), (4, "old", None)], "id long, a string, b string")
    rows = merkle.edits(pairs, "a", "b").collect()
    assert {r.id for r in rows} == {1, 3}
    pieces = [r.piece for r in rows if r.id == 1]
    assert 1 <= len(pieces) <= 4 and "denies" in "".join(pieces)
    assert [(r.section, r.paragraph, r.piece) for r in rows if r.id == 3] == [(0, 0, "new")]
    near_ = spark.range(1).select(merkle.likeness(merkle.fingerprint(F.lit(LONG)), merkle.fingerprint(F.lit(changed)))).first()[0]
    assert 0.99 < near_ < 1
    assert merkle.edits(pairs.limit(0), "a", "b").count() == 0


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = duck.sql(queries.ORACLES["op11_merkle"])
    got = queries.QUERIES["op11_merkle"](spark, SMALL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
