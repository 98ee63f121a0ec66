"""Scratch placement, size checks, and degenerate input."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemill import session
from tidemill.operators import clusters as C
from tidemill.operators import summaries
from tidemill.operators import timeseries as TS
from tidemill.operators.joins import bounded, fits


def fake_session(master, folder=None):
    context = SimpleNamespace(
        master=master, applicationId=f"app-{master}", getConf=lambda: SimpleNamespace(get=lambda key: folder)
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)


def test_scratch_lies_in_the_shared_folder():
    path = session.scratch_path(fake_session("spark://x:7077", "hdfs://shared/tmp/"), "t")
    assert path.startswith("hdfs://shared/tmp/app-spark://x:7077/t-")


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        session.scratch_path(fake_session("spark://x:7077"), "t")


def test_size_checks(spark):
    assert fits(spark.range(10), 10) and not fits(spark.range(11), 10)
    hinted = bounded(spark.range(3)).join(spark.range(3), "id")._jdf.queryExecution().analyzed().toString()
    plain = bounded(spark.range(3), 2).join(spark.range(3), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in plain.lower()


def test_spread_deals_a_single_split(spark):
    one = spark.range(100).coalesce(1)
    assert session.spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 64)
    assert session.spread(wide) is wide


def test_constant_input_gives_nulls_not_errors(spark):
    rows = [("a", dt.date(2000 + i // 12, i % 12 + 1, 1), 0.0) for i in range(30)]
    df = spark.createDataFrame(rows, "series_id string, t date, y double")
    assert TS.acf(df, 3).count() == 0
    assert TS.seasonal_decompose(df).filter("residual IS NOT NULL").count() == 0
    same = spark.createDataFrame([(5.0,)] * 4, "v double")
    assert [r["n"] for r in summaries.histogram(same, "v", 3).orderBy("bin").collect()] == [4, 0, 0]


def test_dedup_prunes_before_the_shuffle(spark, tables):
    kept = summaries.dedup_on_keys(tables.lineitem, ["l_orderkey"], [F.col("l_shipdate"), F.col("l_extendedprice")])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_squared_silhouette_matches_its_definition(spark):
    pts = [(0, [0.0, 0.0], 0), (1, [0.0, 2.0], 0), (2, [5.0, 0.0], 1), (3, [5.0, 1.0], 1), (4, [9.0, 9.0], 2)]
    df = spark.createDataFrame(pts, "id long, vec array<double>, label long")
    total = 0.0
    for i, p, own in pts:
        dist = {}
        for j, q, other in pts:
            if i != j:
                dist.setdefault(other, []).append(sum((a - b) ** 2 for a, b in zip(p, q)))
        if own in dist:
            a = sum(dist[own]) / len(dist[own])
            b = min(sum(v) / len(v) for k, v in dist.items() if k != own)
            total += (b - a) / max(a, b)
    assert C.silhouette_squared(df, 2).first()[0] == pytest.approx(total / len(pts))
