import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tokenloom.functions import text as tx
from tokenloom.operators import counts


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "text string").select(column).first()[0]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Hello, World! 123", "hello world 123"),
        ("", ""),
        ("?!…", ""),
        ("well-known don't", "wellknown dont"),
        ("Straße café", "strae caf"),
        ("  two  leading", " two leading"),
        ("trailing \t\n", "trailing"),
        (None, None),
    ],
)
def test_normalise(spark, raw, expected):
    assert one(spark, tx.normalise(F.col("text")), raw) == expected


def test_words_split_on_any_ascii_space(spark):
    assert one(spark, tx.words(F.col("text")), "\ta\x0bb  c\r\nd ") == ["a", "b", "c", "d"]
    assert one(spark, tx.words(F.col("text")), "?! ") == []


def test_other_pattern_is_applied_as_written(spark):
    assert one(spark, tx.words(F.col("text"), "[aeiou]"), "Some words") == ["sm", "wrds"]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00İKſ"), max_size=40), min_size=30, max_size=60))
def test_stripping_equals_plain_replacement(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = rows.select(tx.strip_characters(F.col("text")), F.lower("text")).collect()
    for stripped, lowered in got:
        assert stripped == re.sub(r"[^a-z0-9 \t\n\x0b\f\r]", "", lowered)


def test_pretokens_split_letters_and_digit_groups(spark):
    assert one(spark, tx.pretokens(F.col("text")), "abc12345 d-e") == ["abc", "123", "45", "de"]


def test_word_frequency(spark, docs):
    rows = counts.word_frequency(docs("a b a", "A, b!", "", None)).collect()
    assert {r.word: r.frequency for r in rows} == {"a": 3, "b": 2}


def test_word_occurrences_keep_order(spark, docs):
    rows = counts.word_occurrences(docs("x y", "z")).collect()
    assert sorted(map(tuple, rows)) == [(0, 0, "x"), (0, 1, "y"), (1, 0, "z")]
