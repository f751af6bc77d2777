import os
from collections import Counter

import numpy as np
import pytest
import yaml
from conftest import SMALL
from pyspark.sql import functions as F

from tokenloom.operators import autoencoder, windows
from tokenloom.params import Params
from tokenloom.plans import chain
from tokenloom.plans.catalogue import FIXED_MERGES
from tokenloom.sources import lines

TEXT = "the thin thing and then the other thing\nin the end the sand\n\none two three four five six seven\n" * 3


def records(frame):
    return sorted((r.word, str(r.token), r.frequency, tuple(r.similar or ())) for r in frame.collect())


def test_text_to_report(spark, tmp_path):
    source, base = tmp_path / "in.txt", str(tmp_path / "out")
    source.write_text(TEXT)
    params = Params(n_merges=10, output_partitions=1)
    for _ in range(2):  # the second run replaces the first
        results = chain.run(spark, str(source), params, base)
    assert list(results) == [*params.stages, params.final_stage]
    written = {stage: spark.read.text(f"{base}/{stage}") for stage in results}

    tokens = lines.parse_frequencies(written["tokenization"])
    assert tokens.agg(F.sum(F.col("frequency") * F.length("word"))).first()[0] == sum(c.isalnum() for c in TEXT)
    paired = lines.pair_windows(lines.parse_windows(written["sliding_window"]))
    assert paired.count() == results["sliding_window"].count() > 0
    assert lines.parse_vectors(written["embedding"]).filter(F.size("vector") != 50).count() == 0
    similar = {r.token: r.similar for r in lines.parse_similar(written["semantic_similarity"]).collect()}
    assert all(t not in s and len(s) == 5 for t, s in similar.items())

    part = [f for f in os.listdir(f"{base}/statistics_collated") if f.startswith("part")]
    with open(f"{base}/statistics_collated/{part[0]}") as f:
        report = [yaml.safe_load(block) for block in f.read().split("\n\n") if block.strip()]
    assert [r["intToken"] for r in report] == sorted(r["intToken"] for r in report)
    assert {r["intToken"]: r["frequency"] for r in report} == {r.token: r.frequency for r in tokens.collect()}
    assert {r["intToken"]: r["semanticallySimilarTokens"] for r in report} == {
        r["intToken"]: similar.get(r["intToken"], "N/A") for r in report
    }


def test_results_do_not_depend_on_partitioning(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    params = Params(tokeniser="word", min_count=20)
    several = records(chain.run(spark, docs.repartition(13), params)["statistics_collated"])
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        single = records(chain.run(spark, docs.coalesce(1), params)["statistics_collated"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert several == single


@pytest.mark.parametrize("order", ["corpus", "listing"])
@pytest.mark.parametrize("tokeniser", ["word", "subword"])
@pytest.mark.parametrize("embedding", ["cooccurrence", "autoencoder"])
def test_every_combination_runs(spark, docs, order, tokeniser, embedding):
    params = Params(order=order, tokeniser=tokeniser, embedding=embedding, epochs=2, embedding_size=8)
    frame = docs(*TEXT.split("\n"))
    results = chain.run(spark, frame, params, merges=FIXED_MERGES)
    vocabulary = {str(r.token) for r in results["tokenization"].collect()}
    collated = results["statistics_collated"].collect()
    assert {r.token for r in collated} == vocabulary
    assert any(r.similar for r in collated)
    assert all(set(r.similar or ()) <= vocabulary - {r.token} for r in collated)


def test_too_little_text_gives_counts_only(spark, docs):
    results = chain.run(spark, docs("a", ""), Params(tokeniser="word"))
    assert records(results["statistics_collated"]) == [("a", "0", 1, ())]


def test_unknown_names_raise(spark, docs):
    for params in (Params(stages=("tokenization", "nothing")), Params(tokeniser="x"), Params(embedding="x")):
        with pytest.raises(ValueError, match="unknown"):
            chain.run(spark, docs("a b c d e f"), params)


def training(spark, parts):
    ids = [[(i * 7 + j * j) % 11 for j in range(9)] for i in range(40)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ids)], "doc_id long, tokens array<int>").repartition(parts)
    return windows.corpus_segments(rows, F.col("tokens"))


def test_training_windows_of_segments(spark):
    """Cut in blocks and whole, the examples are those of the windows one by one."""
    rows = spark.createDataFrame([(1, list(range(30))), (2, [7, 7, 8, 9, 9]), (3, [1, 2]), (4, [3, 1, 4, 1, 5, 9])], "doc_id long, tokens array<int>")
    for block in (5, 4096):
        segments = windows.corpus_segments(rows, F.col("tokens"), block=block, ahead=5)
        want = {tuple(r.tokens): r.weight for r in windows.training_windows(windows.context_windows(segments, 4), 4).collect()}
        parts = segments.orderBy("seq", "start").collect()
        got = autoencoder.examples(
            np.concatenate([p.tokens for p in parts]), np.array([len(p.tokens) for p in parts]),
            np.array([p.owned for p in parts]), np.array([p.start for p in parts]), 4,
        )
        assert Counter(map(tuple, got.tolist())) == want


def plain_fit(fitted, hidden, epochs, rate, batch, rounds):
    """The same training as a loop over the written units: weights, losses, and the read-outs token by token."""
    rng = np.random.default_rng(42)
    limit = np.sqrt(6.0 / (4 + hidden))
    model = autoencoder.Autoencoder(
        rng.uniform(-limit, limit, (4, hidden)), np.zeros(hidden), rng.uniform(-limit, limit, (hidden, 4)), np.zeros(4), 10.0
    )
    flat = model.parameters()
    adam = [flat, np.zeros_like(flat), np.zeros_like(flat), 0]
    cells = [
        (r["round"], r.unit, autoencoder.examples(np.frombuffer(r.tokens, np.int32), *(np.frombuffer(x, np.int64) for x in (r.sizes, r.owned, r.starts)), 4))
        for r in fitted.units.collect()
    ]
    losses, columns = [], {}
    for i in [i for _ in range(epochs) for i in range(rounds)]:
        ends, weights, loss, steps = [], [], 0.0, 0
        for _, _, ids in sorted((c for c in cells if c[0] == i), key=lambda c: c[1]):
            weight, first, second, step = adam
            for at in range(0, len(ids), batch):
                part = ids[at : at + batch]
                model.with_parameters(weight)
                gradient, error = model.gradient(part / 10.0, np.full(len(part), 1 / len(part)))
                step += 1
                first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
                weight = weight - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
                loss += error * len(part)
                model.with_parameters(weight)
                for row in part.tolist():
                    for p, token in enumerate(row):
                        columns.setdefault(token, []).append(model.encode[:, p].copy())
            ends.append((weight, first, second))
            weights.append(len(ids))
            steps = max(steps, step)
        if ends:
            adam = [sum(e[j] * n for e, n in zip(ends, weights)) / sum(weights) for j in range(3)] + [steps]
            losses.append(loss / sum(weights))
    model.with_parameters(adam[0])
    everything = np.concatenate([ids for _, _, ids in cells])
    active = model.hidden(everything / 10.0)
    hidden_means = {t: np.concatenate([active[everything[:, p] == t] for p in range(4)]).mean(0) for t in range(11)}
    return model, losses, hidden_means, {t: np.mean(c, axis=0) for t, c in columns.items()}


@pytest.mark.parametrize("epochs,batch,steps,rounds", [(1, 256, 64, 4), (2, 16, 3, 2), (3, 7, 5, 1)])
def test_online_training_equals_a_plain_loop(spark, epochs, batch, steps, rounds):
    options = dict(hidden=12, epochs=epochs, learning_rate=0.01, batch=batch, local_steps=steps, rounds=rounds)
    first = autoencoder.fit(training(spark, 1), 4, **options)
    second = autoencoder.fit(training(spark, 6), 4, **options)
    assert (first.model.parameters() == second.model.parameters()).all()
    model, losses, hidden, columns = plain_fit(first, 12, epochs, 0.01, batch, rounds)
    assert np.allclose(first.model.parameters(), model.parameters(), atol=1e-9) and np.allclose(first.model.losses, losses)
    for got, want, size in ((autoencoder.hidden_vectors(first), hidden, 12), (autoencoder.weight_vectors(first), columns, 4)):
        rows = {r.token: r.vector for r in got.collect()}
        assert set(rows) == set(want) == set(range(11))
        assert all(len(v) == size and np.allclose(v, want[t], atol=1e-5) for t, v in rows.items())


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_columns_are_added_by_token(few, monkeypatch):
    monkeypatch.setattr(autoencoder, "_FEW_COUNTS", few)
    rng = np.random.default_rng(1)
    place, after = rng.integers(0, 7, (53, 3)), rng.integers(-(1 << 40), 1 << 40, (6, 3, 3))
    want = np.zeros((7, 3), np.int64)
    for row, window in enumerate(place):
        for p, token in enumerate(window):
            want[token] += after[row // 10][:, p]
    assert (autoencoder._placed(place, 7, after, 10) == want).all()


@pytest.mark.parametrize("largest,held", [(5, 1 << 20), (5, 100), (1 << 20, 100)])
def test_windows_of_many_units_are_read_out_once(largest, held, monkeypatch):
    """Equal windows of different units are gathered before they are read out; the number held is bounded."""
    monkeypatch.setattr(autoencoder, "_HELD_WINDOWS", held)
    rng = np.random.default_rng(2)
    units = [rng.integers(0, largest + 1, (60, 2)).astype(np.int32) for _ in range(20)] + [np.zeros((0, 2), np.int32)]
    found = list(autoencoder._gathered(iter(units)))
    counted = Counter()
    for ids, times in found:
        assert len(ids) == len(times) <= held + 60
        counted.update({tuple(row): 0 for row in ids.tolist()})
        for row, n in zip(ids.tolist(), times.tolist()):
            counted[tuple(row)] += n
    assert counted == Counter(tuple(row) for unit in units for row in unit.tolist())
    if largest == 5:
        assert sum(len(ids) for ids, _ in found) == 36


def test_many_steps_learn_more_than_one(spark):
    """After one epoch of local steps the loss is below that of one step per round over everything."""
    def after(**options):
        fitted = autoencoder.fit(training(spark, 3), 4, hidden=12, learning_rate=0.01, epochs=1, **options)
        ids = np.concatenate(list(autoencoder._unpacked(iter(fitted.units.toArrow().to_batches()), 4)))
        return fitted.model.gradient(ids / 10.0, np.full(len(ids), 1 / len(ids)))[1]

    assert after(batch=16, local_steps=8, rounds=4) < 0.5 * after(batch=1 << 20, local_steps=1, rounds=1)


def test_training_without_windows_raises(spark, docs):
    rows = spark.createDataFrame([(1, [1, 2])], "doc_id long, tokens array<int>")
    with pytest.raises(ValueError, match="no windows"):
        autoencoder.fit(windows.corpus_segments(rows, F.col("tokens")), 4)


def test_autoencoder_gradient_is_the_slope_of_its_loss():
    rng = np.random.default_rng(0)
    model = autoencoder.Autoencoder(rng.normal(size=(4, 5)), rng.normal(size=5), rng.normal(size=(5, 4)), rng.normal(size=4), 1.0)
    x, weight = rng.uniform(size=(7, 4)), rng.uniform(size=7)
    gradient, _ = model.gradient(x, weight)
    flat = model.parameters()
    for i in range(len(flat)):
        losses = []
        for step in (1e-6, -1e-6):
            moved = flat.copy()
            moved[i] += step
            model.with_parameters(moved)
            losses.append(model.gradient(x, weight)[1])
        assert gradient[i] == pytest.approx((losses[0] - losses[1]) / 2e-6, abs=1e-6)


def test_stage_counts_are_observed_while_writing(spark, docs, tmp_path):
    for order in ("corpus", "listing"):
        counted = {}
        frame = docs("a b c d e f a", "b b c")
        results = chain.run(spark, frame, Params(tokeniser="word", order=order, output_partitions=2), str(tmp_path / order), counts_of=counted)
        assert counted == {r.stage: r.n for r in chain.stage_counts(results).collect()}


def test_stage_counts(spark, docs):
    results = chain.run(spark, docs("a b c d e f"), Params(tokeniser="word"))
    got = {r.stage: r.n for r in chain.stage_counts(results).collect()}
    assert got == {"tokenization": 6, "sliding_window": 2, "embedding": 6, "semantic_similarity": 30, "statistics_collated": 6}
