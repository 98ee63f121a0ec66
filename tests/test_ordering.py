"""Whole-table ranks and running sums agree with single windows, also when one key holds most rows."""

import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators import ordering as O
from tidemill.operators.joins import not_in, product_of_dimensions, salted_lookup


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 < 2, F.lit(0)).otherwise(F.col("id") % 11)
    return spark.range(3000).select("id", key.alias("k"), F.pmod(F.hash("id"), F.lit(50)).cast("long").alias("v"))


def test_global_row_number(skewed):
    rows = O.global_row_number(skewed, ["v", "id"]).collect()
    ranked = sorted(rows, key=lambda r: (r["v"], r["id"]))
    assert [r["row_number"] for r in ranked] == list(range(1, 3001))


def test_global_running_sum(skewed):
    rows = sorted(O.global_running_sum(skewed, ["id"], "v").collect(), key=lambda r: r["id"])
    total = 0
    for r in rows:
        total += r["v"]
        assert r["running_sum"] == total


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_keyed_running_sum(spark, skewed, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    window = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    expected = skewed.withColumn("running_sum", F.sum("v").over(window)).collect()
    got = O.keyed_running_sum(skewed, ["k"], ["id"], "v").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    columns = ["id", "k", "v", "running_sum"]
    assert rows_of(columns, got) == rows_of(columns, expected)


def test_exact_percentiles(skewed):
    probs = [0.0, 0.05, 0.5, 0.9, 1.0]
    expected = skewed.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("m")).collect()
    got = {r["k"]: r["marks"] for r in O.exact_percentiles(skewed, ["k"], "v", probs).collect()}
    for r in expected:
        assert got[r["k"]] == pytest.approx(r["m"])


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    with_null = spark.createDataFrame([(1,), (None,)], "b int")
    empty = spark.createDataFrame([], "b int")
    assert not_in(left, "a", with_null).count() == 0
    assert not_in(left, "a", empty).count() == 3
    assert [r["a"] for r in not_in(left, "a", with_null.na.drop()).collect()] == [2]


def test_salted_lookup_equals_join(spark, skewed):
    table = skewed.select(F.col("k").cast("string").alias("token")).distinct().withColumn("n", F.length("token"))
    facts = skewed.withColumn("token", F.col("k").cast("string"))
    salted = salted_lookup(facts, table, "token", "id", salts=4, small_rows=0)
    assert rows_of(["id", "n"], salted.collect()) == rows_of(["id", "n"], facts.join(table, "token").collect())


def test_product_is_refused_beyond_its_bound(spark):
    with pytest.raises(ValueError):
        product_of_dimensions(spark.range(200), spark.range(200))
