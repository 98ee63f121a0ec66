"""Commit records of streams, versions of marts, the three-file job, SQL functions and odd levels."""

import pytest
from pyspark.sql import functions as F

from tidemill.operators import learning as L
from tidemill.operators import loads
from tidemill.operators.rates import extract_wide, rates_job
from tidemill.session import exists, scratch_path
from tidemill.sources import files
from tidemill.sources.marts import location, publish
from tidemill.streaming import commits, feeds


def write_days(spark, path, days):
    rows = [(f"1/{d}/2024", "click", "site", "1.00", "2.00", "3.00", "0.50", str(d)) for d in days]
    flat = spark.createDataFrame(rows, "date string, alias string, Category string, Open string, Close string, High string, Low string, Volume string")
    flat.write.option("maxRecordsPerFile", 1).mode("append").json(path)


def test_a_failed_batch_is_replayed_into_both_tables_once(spark):
    """The audit write of the second batch fails after its data was written; a restart leaves each row once in both tables."""
    source, root, checkpoint = (scratch_path(spark, n) for n in ("flat", "lake", "progress"))
    write_days(spark, source, [1, 2, 3])
    stream = lambda: feeds.flat_bars(feeds.json_stream(spark, source, feeds.FLAT_SCHEMA, files_per_trigger=2))
    broken = {"left": 1}

    def audit(rows):
        if broken["left"] and rows.filter("Volume = 9").count():
            broken["left"] -= 1
            raise RuntimeError("no room")
        return rows.select(F.concat(F.lit("added "), F.col("Volume").cast("int").cast("string")).alias("message"))

    run = lambda: feeds.run_available_now(stream().writeStream.foreachBatch(commits.append_tables(root, "bars", {"audit": audit})), checkpoint)
    run()
    write_days(spark, source, [9])
    with pytest.raises(Exception, match="no room"):
        run()
    stored = lambda: sorted(int(r["Volume"]) for r in commits.read_committed(spark, root, "bars").collect())
    assert stored() == [1, 2, 3]  # the folder of the failed batch is there, but not published
    assert spark.read.parquet(f"{root}/bars").count() == 4
    run()
    assert stored() == [1, 2, 3, 9]
    assert sorted(r["message"] for r in commits.read_committed(spark, root, "audit").collect()) == ["added 1", "added 2", "added 3", "added 9"]
    numbers = [r["batch_id"] for r in commits.committed(spark, root).collect()]
    assert len(numbers) == len(set(numbers))


def test_a_failed_write_leaves_the_old_mart(spark):
    name = "mart_under_test"
    first = publish(spark.range(3).withColumn("v", F.lit("one")), name)
    assert first.count() == 3
    old = location(spark, name)
    bad = spark.range(5).withColumn("v", F.when(F.col("id") == 4, F.raise_error(F.lit("bad row"))).otherwise(F.lit("two")).cast("string"))
    with pytest.raises(Exception, match="bad row"):
        publish(bad, name)
    assert location(spark, name) == old and spark.table(name).count() == 3
    publish(spark.range(7).withColumn("v", F.lit("three")), name)
    assert location(spark, name) != old
    assert {r["v"] for r in spark.table(name).collect()} == {"three"} and spark.table(name).count() == 7
    assert first.count() == 3  # planned on the version before
    wider = publish(spark.range(2), name)
    assert wider.columns == ["id"] and spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")


def wide(spark, rows, columns):
    path = scratch_path(spark, "wide")
    files.write_csv(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)), path)
    return path


def test_three_files_to_one_ordered_table(spark):
    columns = ["country", "2020-01-01", "2020-01-02", "2020-01-03"]
    paths = {
        "cases": wide(spark, [("b", "10", "20", "40"), ("a", "8", "x", "16")], columns),
        "deaths": wide(spark, [("a", "1", "2", "4"), ("b", "1", "2", "5")], columns),
        "recoveries": wide(spark, [("a", "2", "2", "2"), ("b", "4", "6", "8")], columns),
    }
    long, counts = extract_wide(spark, paths)
    assert long.count() == 6 and {r["n_rows"] for r in counts.collect()} == {2} and counts.first()["all_equal"]
    assert dict(long.dtypes)["cases"] == "string" and dict(long.dtypes)["deaths"] == "int"  # one bad value makes text of its file
    target = scratch_path(spark, "target")
    assert rates_job(spark, paths, target).first().asDict() == {"processed": 6, "failed": 1, "all_equal": True}
    out = files.read_csv_inferred(spark, target).coalesce(1).collect()
    assert [(r["country"], str(r["date"])) for r in out] == sorted((r["country"], str(r["date"])) for r in out)
    assert [(r["country"], str(r["date"])) for r in out] == [("B", "2020-01-02"), ("B", "2020-01-03")]
    assert out[0]["mortality_rate_change"] == pytest.approx(0.0) and out[1]["mortality_rate_change"] == pytest.approx(0.25)


def test_files_of_different_length_are_reported(spark):
    columns = ["country", "2020-01-01"]
    paths = {m: wide(spark, [("a", "1")] + ([("b", "2")] if m == "cases" else []), columns) for m in ("cases", "deaths", "recoveries")}
    with pytest.warns(UserWarning, match="differ in length"):
        long, counts = extract_wide(spark, paths)
    assert [r["country"] for r in long.collect()] == ["a"] and not counts.first()["all_equal"]


def test_one_hot_of_odd_levels(spark):
    rows = [(1, "Ab", 3), (2, "AB", 4), (3, None, None), (4, "ab", 3), (5, "c d", 5)]
    df = spark.createDataFrame(rows, "id long, kind string, size int").withColumn("kind_c d", F.lit(9))
    out = L.one_hot(L.one_hot(df, "kind"), "size").collect()
    names = [c for c in out[0].asDict() if c.startswith("kind_") and c != "kind_c d"]
    assert len(names) == 4 and len({n.lower() for n in names}) == 4
    assert [sum(r[n] for n in names) for r in out] == [1, 1, 0, 1, 1]
    assert [sum(r[n] for r in out) for n in names] == [1, 1, 1, 1]
    assert [(r["size_3"], r["size_4"], r["size_5"]) for r in out] == [(1, 0, 0), (0, 1, 0), (0, 0, 0), (1, 0, 0), (0, 0, 1)]


def test_too_many_levels_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_LEVELS", 3)
    assert L.levels_of(spark.range(3), "id") == [0, 1, 2]
    with pytest.raises(ValueError, match="more than 3 levels"):
        L.levels_of(spark.range(4), "id")


def test_documents_have_no_place_for_a_null_key(spark):
    rows = spark.createDataFrame([("d1", "a", "1"), ("d1", None, "2"), ("d2", None, "3")], "day string, k string, v string")
    keys = spark.createDataFrame([("a", "x"), ("b", "x"), (None, "x")], "k string, Category string")
    nested = {r["Date"]: r["Entries"] for r in loads.nest_by_date(rows, "day", "k", ["v"], keys).collect()}
    assert {d: [e["Stock_Alias"] for e in es] for d, es in nested.items()} == {"d1": ["a", "b"]}


def test_existence_of_paths(spark):
    path = scratch_path(spark, "some")
    assert not exists(spark, path)
    spark.range(1).write.parquet(path)
    assert exists(spark, path)
