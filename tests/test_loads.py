"""Batches that hold a key twice."""

import pytest

from tidemill.operators.learning import smote
from tidemill.operators.loads import insert_ignore, upsert


def test_insert_ignore_keeps_one_row_of_a_key(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    rows = spark.createDataFrame([(1, "x"), (2, "z"), (2, "y"), (None, "n"), (None, "n")], "k long, v string")
    got = sorted(map(tuple, insert_ignore(target, rows, "k").collect()), key=str)
    assert got == sorted([(1, "a"), (2, "y"), (None, "n"), (None, "n")], key=str)


def test_upsert_refuses_a_key_staged_twice(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    with pytest.raises(ValueError):
        upsert(target, spark.createDataFrame([(1, "x"), (1, "y")], "k long, v string"), "k")
    assert upsert(target, spark.createDataFrame([(1, "x")], "k long, v string"), "k").collect()[0]["v"] == "x"


def test_smote_needs_a_neighbour(spark):
    with pytest.raises(ValueError):
        smote(spark.createDataFrame([(1, [1.0, 2.0])], "id long, vec array<double>"), 3, "s")
