"""Every query against its SQL form at the smallest scale."""

import glob
import os

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as contract
from check import _rows
from tokenloom.plans import catalogue

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    frame = contract.queries()[name](spark, SMALL)
    rows = frame.collect()
    assert rows
    if name in ORACLES:
        answer = duck.sql(ORACLES[name])
        assert sorted(frame.columns) == sorted(answer.columns)
        assert _rows(rows, frame.columns) == _rows(answer.fetchall(), answer.columns)


def test_only_training_queries_lack_sql():
    without = set(catalogue.QUERIES) - set(ORACLES)
    assert without == {
        "token_embeddings_autoencoder",
        "token_embeddings_autoencoder_weights",
    }


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["word", "intToken", "frequency", "similar_tokens"]
