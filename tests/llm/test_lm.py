"""Operator 8 against plain counts, and the model against what a probability must satisfy."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL

from tokenloom.llm import lm, queries


def plain_base(rows):
    def tokens(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            low = low.replace(c, " ")
        return [w for w in low.split(" ") if w] + [None]

    def held(d):
        return d is not None and zlib.crc32(str(d).encode()) % 7 == 2

    counts = Counter(t for d, text in rows if not held(d) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for d, text in rows:
        own = tokens(text)
        base = math.fsum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        out.append((d, held(d), len(own), sum(counts[t] > 0 for t in own), total, base))
    return out


def compare(got, want):
    got = sorted(map(tuple, got), key=repr)
    want = sorted(want, key=lambda r: repr(r[:5]))
    got = sorted(got, key=lambda r: (repr(r[:5]), r[5]))
    want = sorted(want, key=lambda r: (repr(r[:5]), r[5]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)


def test_query_has_the_plain_unigram_scores_and_learns_contexts(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op8_lm"](spark, SMALL).collect()
    compare(got, plain_base(rows))
    texts = dict(rows)
    seen = Counter(b for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2 for b in t.encode())
    total = sum(seen.values()) + 256
    held = [r for r in got if r.held_out]
    by_bytes = sum(math.log10((seen[b] + 1) / total) for r in held for b in texts[r.doc_id].encode())
    assert held and sum(r.score for r in held) > 0.75 * by_bytes


def test_rare_words_are_joined(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 30)
    monkeypatch.setattr(lm, "_FLUSH", 50)
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(i % 13))) for i in range(200)]
    compare(lm.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect(), plain_base(rows))


def test_edges(spark):
    rows = [(1, None), (None, "a B a"), (2, ""), (3, "a b"), (3, "a b"), (4, "word " * 60000), (5, "é😀 \x0b x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm.scores(frame).collect()
    compare(got, plain_base(rows))
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm.scores(frame.limit(0)).count() == 0
    held = [(i, "x y") for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    only = lm.scores(spark.createDataFrame(held, "doc_id long, text string")).collect()
    compare(only, plain_base(held))
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in only)


def model_of(texts):
    code = lm.huffman(lm.pair_counts(texts))
    tables = [np.zeros(n, np.int16) for n in lm.table_sizes()]
    for group in lm.pieces(texts):
        slots, bits, _ = lm.laid_out(group, code)
        for table, slot in zip(tables, slots):
            np.maximum.at(table, slot, 1)
            np.add.at(table, slot, (4 * 90 * (2 * bits.astype(np.int16) - 1)))
    return lm.Model(code, tables)


def test_chances_of_all_texts_of_a_length_add_up():
    """Over every text of at most one byte more: the chance of going on is shared among the next symbols."""
    model = model_of([b"abracadabra", b"banana bread"])
    prefix = b"aban"
    for k in range(3):
        total = 0.0
        for symbol in range(257):
            slots, bits, _ = lm.laid_out([(0, prefix[:k], bytes([symbol]) if symbol < 256 else b"", symbol == 256)], model.code)
            reader = lm.Reader()
            odds = [t.take(s).astype(np.float32) / lm._SCALE for t, s in zip(model.tables, slots)]
            gate = sum((t.take(s) & 3).astype(np.intp) << (2 * i) for i, (t, s) in enumerate(zip(model.tables, slots)))
            reader.read(odds, gate, bits.astype(np.float32))
            total += math.exp(reader.log)
        assert total == pytest.approx(1.0, abs=1e-3)


def test_groups_do_not_change_a_score(monkeypatch):
    texts = [b"abracadabra " * 40, b"", b"banana", b"x" * 700]
    model = model_of(texts)
    alone = [lm.log10_chances([t], model)[0] for t in texts]
    assert lm.log10_chances(texts, model) == pytest.approx(alone)
    monkeypatch.setattr(lm, "STRETCH", 1)
    exact = lm.log10_chances(texts, model)
    monkeypatch.setattr(lm, "GROUP", 64)
    assert lm.log10_chances(texts, model) == pytest.approx(exact)
    assert exact[2] < 0


def test_weights_and_map_are_learnt_from_the_training_texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    texts = [r.text.encode() for r in rows]
    code = lm.huffman(lm.pair_counts(texts[:150]))
    symbols = lm._symbol_counts(spark.createDataFrame([(t.decode(),) for t in texts[:150]], "text string"))
    counted = lm._slot_counts(symbols, code)
    # The counts are those of the decisions one by one.
    plain = Counter()
    bases = np.cumsum([0, *lm.table_sizes()])
    for group in lm.pieces(texts[:150]):
        slots, bits, _ = lm.laid_out(group, code)
        for base, slot in zip(bases, slots):
            plain.update(zip((slot.astype(int) + int(base)).tolist(), bits.tolist()))
    got = {(r.slot, bit): n for r in counted.collect() for bit, n in enumerate((r.n0, r.n1)) if n}
    assert got == plain
    model = lm._model(code, counted, symbols)
    even = lm.Model(code, model.tables)
    assert not np.allclose(model.start.weights, even.start.weights) and not np.allclose(model.start.chances, even.start.chances)
    assert sum(lm.log10_chances(texts[150:], model)) > sum(lm.log10_chances(texts[150:], even))
