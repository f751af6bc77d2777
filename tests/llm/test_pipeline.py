"""The stages on a whole small table, and the contract's view of these queries."""

import duckdb
from conftest import SMALL

import __spark_entry__ as contract
import corpus_pipeline
from check import _rows
from tokenloom.llm import common, decontam, simhash


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
        assert docs.columns[: len(columns)] == columns
        assert (docs.columns == columns) == (name != "sharding")
    groups = simhash.simhash_groups(kept["toxicity"])
    assert kept["near_duplicates"].count() == groups.select("component_id").distinct().count()
    benchmark = common.table(spark, SMALL, "benchmark", "item_id", "text")
    leaks = decontam.contamination_report(kept["near_duplicates"], benchmark).filter("contaminated")
    gone = {r.doc_id for r in leaks.collect()}
    before = {r.doc_id for r in kept["near_duplicates"].collect()}
    assert {r.doc_id for r in kept["decontamination"].collect()} == before - gone
    assert {r.doc_id for r in kept["mixing"].collect()} == before - gone
    assert kept["mixing"].count() == kept["sharding"].count()


def test_stages_hold_on_odd_rows_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, Shard string, use int"
    passage = " ".join(f"item{i}" for i in range(12))
    rows = [(i, f"text{i} of number{i * 7} with some own{i} words", "en", "web" if i % 3 else "news", 9, i, "s", 1) for i in range(60)]
    rows += [(100, None, None, None, None, None, None, None), (101, "", "en", "web", 0, 0, "", 0), (None, None, "de", "web", 1, 1, "t", 2)]
    rows += [(102, "very long text of words " * 20000, "en", "web", 1, 1, "t", 2), (103, f"before {passage} after", "en", "web", 1, 1, "t", 2)]
    rows += [(5, rows[5][1], "en", rows[5][3], 9, 5, "s", 1), (104, rows[6][1], "fr", "news", 9, 6, "s", 1)]
    tables = {
        "labels": spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, toxic int"),
        "benchmark": spark.createDataFrame([("a", passage), ("b", None), ("c", "")], "item_id string, text string"),
    }
    for empty in (False, True):
        folder = str(tmp_path / str(empty))
        for name, frame in tables.items():
            (frame.limit(0) if empty else frame).write.parquet(f"{folder}/{name}.parquet")
        docs = spark.createDataFrame(rows, schema).limit(0 if empty else 1000)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            assert docs.columns[: len(columns)] == columns
        ids = {r.doc_id for r in docs.collect()}
        # The repeat, the equal text and one of the texts without words (the fingerprint is zero) are gone, and the leak is.
        assert ids == (set() if empty else set(range(60)) | {100, 102})
        assert empty or docs.filter("doc_id = 5").count() == docs.filter("doc_id = 8").count()


def test_licence_query_is_its_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    frame = contract.queries()["op6_licenses"](spark, SMALL)
    answer = duck.sql(contract.oracle_sql()["op6_licenses"])
    assert sorted(frame.columns) == sorted(answer.columns)
    assert _rows(frame.collect(), frame.columns) == _rows(answer.fetchall(), answer.columns)


def test_all_operators_are_registered():
    names = contract.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
