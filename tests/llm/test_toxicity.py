"""Operator 5 on made labels, with rows that must not break it."""

from tokenloom.llm import common, toxicity


def test_held_out_rows_are_told_apart_and_edges_hold(spark):
    rows = [(i, f"word{i % 17} and some text here " + ("you stupid moron " if i % 3 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)] + [(None, 1)], "doc_id long, toxic int")
    odd = [(1000, None), (None, ""), (1001, "word " * 50000), (1002, "a moron"), (1002, "a moron")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    got = toxicity.toxicity_report(docs, labels).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert held and all(r.predicted == int(r.doc_id % 3 == 0) for r in held)
    none = toxicity.toxicity_report(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0} and toxicity.toxicity_report(docs.limit(0), labels).count() == 0
    assert common.fresh(docs, "TEXT") == "TEXT_"


def test_rows_are_dropped_only_where_labels_train_a_classifier(spark):
    schema = "doc_id long, text string, toxicity string, Score double"
    rows = [(i, f"word{i % 17} and some text here " + ("you stupid moron " if i % 3 == 0 else ""), "x", 0.5) for i in range(600)]
    odd = [(1000, None, None, None), (None, "", "y", 1.0), (1001, "word " * 50000, "x", 0.0)]
    odd += [(1002, "you stupid moron and some text here", "x", 0.0)] * 2 + [(1003, "word1 and some text here", "x", 0.0)] * 2
    docs = spark.createDataFrame(rows + odd, schema)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [i for i in range(600) if i % 3] + [1000, 1001, 1003, 1003, None]
    assert toxicity.drop_toxic(docs.limit(0), labels).count() == 0
    # Labels that are missing or all alike tell nothing: every row stays.
    for few in (labels.limit(0), labels.filter("toxic = 1").limit(3), labels.filter("toxic = 0")):
        assert toxicity.drop_toxic(docs, few).count() == docs.count()
