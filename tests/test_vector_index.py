"""The stored index of vectors: exact search, calibrated recall, bounds, crowded cells and reopening."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.operators import vector_index as V
from tidemill.operators.neighbors import label_agreement, nearest
from tidemill.session import scratch_path


def items(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in p]) for i, p in zip(ids, x, strict=True)], "iid long, ivec array<double>").repartition(3)


def queries(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "qid long, qvec array<double>")


def brute(x, q, k, skip_same):
    out = {}
    for i in range(len(q)):
        d = np.round(np.sqrt(((x - q[i]) ** 2).sum(1)), 10)
        out[i] = [(int(j), float(d[j])) for j in np.lexsort((np.arange(len(x)), d)) if not (skip_same and j == i)][:k]
    return out


def collected(pairs):
    got = {}
    for r in sorted(pairs.collect(), key=lambda r: (r["qid"], r["rank"])):
        got.setdefault(r["qid"], []).append((r["iid"], r["dist"]))
    return got


def same(got, expected):
    assert set(got) == set(expected)
    for q, rows in expected.items():
        assert [i for i, _ in got[q]] == [i for i, _ in rows]
        assert [d for _, d in got[q]] == pytest.approx([d for _, d in rows])


@pytest.fixture(scope="module")
def clustered():
    """Sixty groups; a third of all rows are copies of one vector."""
    r = np.random.default_rng(11)
    middles = r.normal(0, 10, (60, 5))
    return np.vstack([middles[i % 60] + r.normal(0, 0.3, 5) for i in range(800)] + [np.full(5, 3.0)] * 400)


@pytest.mark.parametrize("tile_rows", [4096, 60])
def test_exact_search(spark, clustered, tile_rows):
    index = V.VectorIndex.build(items(spark, clustered), tile_rows=tile_rows)
    assert len(index.layout.coarse) <= 6 and index.layout.count.sum() == len(clustered)
    asked = clustered[::5]
    same(collected(index.search(queries(spark, asked), 7, block=tile_rows)), brute(clustered, asked, 7, False))


def test_exact_search_without_structure(spark):
    x = np.random.default_rng(2).normal(size=(700, 12))
    index = V.VectorIndex.build(items(spark, x), tile_rows=100)
    same(collected(index.search(queries(spark, x), 5, True)), brute(x, x, 5, True))


def test_more_neighbors_wanted_than_there_are(spark):
    x = np.random.default_rng(3).normal(size=(9, 3))
    index = V.VectorIndex.build(items(spark, x))
    same(collected(index.search(queries(spark, x), 20, True)), brute(x, x, 20, True))


def test_rows_without_vector_and_empty_tables(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (None, [0.0, 0.0]), (4, [1.0, None]), (5, [5.0, 5.0])]
    table = spark.createDataFrame(rows, "iid long, ivec array<double>")
    index = V.VectorIndex.build(table)
    asked = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "qid long, qvec array<double>")
    assert collected(index.search(asked, 3)) == {1: [(1, 0.0), (5, 5.0)]}
    empty = V.VectorIndex.build(table.limit(0))
    assert empty.search(asked, 3).count() == 0 and empty.search_approx(asked, 3).count() == 0


def test_bounds_hold_and_crowded_cells_are_cut(spark, clustered):
    index = V.VectorIndex.build(items(spark, clustered), tile_rows=50)
    layout, q = index.layout, clustered[:40] + 0.7
    filed = index.vectors.toPandas()
    d = V.distances(q, V.matrix(filed["vec"]))
    at = layout.first[filed["coarse"].to_numpy()] + filed["fine"].to_numpy()
    least = layout.least(q)
    assert all((least[:, c] <= d[:, at == c].min(1) + 1e-6).all() for c in np.unique(at))
    crowded = layout.count > 50
    assert crowded.any() and (layout.parts[crowded] == np.ceil(layout.count[crowded] / 50)).all()
    per_tile = pd.Series(layout.count[~crowded]).groupby(layout.tile[~crowded]).sum()
    assert per_tile.max() <= 50
    assert not set(layout.tile[crowded]) & set(layout.tile[~crowded & (layout.count > 0)])


def test_recall_is_measured_and_reached(spark, clustered):
    for x, most in ((clustered, 0.2), (np.random.default_rng(4).normal(size=(900, 16)), 1.0)):
        index = V.VectorIndex.build(items(spark, x))
        probes = index.probes_for(8)
        assert index.probes_for(8) == probes and index.probes_for(5) == probes  # kept in the folder
        found = collected(index.search_approx(queries(spark, x), 8, True))
        expected = brute(x, x, 8, True)
        hits = sum(d <= expected[q][-1][1] + 1e-9 for q, rows in found.items() for _, d in rows)
        assert hits / (8 * len(x)) >= 0.9
        assert probes <= max(1, most * len(index.layout.count))


def test_stored_index_is_opened_again(spark, clustered):
    path = scratch_path(spark, "kept-index")
    built = V.VectorIndex.build(items(spark, clustered, np.arange(len(clustered)) * 3), path)
    again = V.VectorIndex(spark, path)
    chosen = spark.createDataFrame([(0,), (30,), (30,), (299,), (None,)], "id long")
    got = collected(again.neighbors_of(chosen, 4, exact=True))
    assert set(got) == {0, 30}  # 299 is not filed
    assert got == collected(built.neighbors_of(chosen, 4, exact=True))
    expected = brute(clustered, clustered, 4, True)
    assert got[30] == [(3 * i, pytest.approx(d)) for i, d in expected[10]]


def test_cells_grow_with_the_root_of_the_table(spark):
    r = np.random.default_rng(5)
    cells = [len(V.VectorIndex.build(items(spark, r.normal(size=(n, 4)))).layout.count) for n in (100, 1600)]
    assert cells[0] <= 16 and 3 * cells[0] <= cells[1] <= 49


def test_few_cells_are_searched_where_vectors_have_groups(spark, clustered):
    """A query is copied to few tiles: the bounds of both levels leave out most cells."""
    index = V.VectorIndex.build(items(spark, clustered[:800]), tile_rows=20)
    asked = clustered[:800:8]
    least = index.layout.least(asked)
    bound = np.array([rows[-1][1] for rows in brute(clustered[:800], asked, 5, False).values()])
    assert (least <= bound[:, None]).sum(1).mean() < 0.3 * (index.layout.count > 0).sum()


def test_nearest_changes_way_without_changing_rows(spark, clustered):
    q, x = queries(spark, clustered), items(spark, clustered)
    few, many = (nearest(q, x, 5, True, small_rows=n) for n in (100_000, 100))
    assert collected(few) == collected(many)


def test_agreement_of_several_labels(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "qid long, iid long")
    labels = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "x")], "id long, aisle string, department string")
    row = label_agreement(pairs, labels, ["aisle", "department"]).first()
    assert row.asDict() == {"aisle_agreement": pytest.approx(2 / 3), "department_agreement": pytest.approx(1 / 3), "n_pairs": 3}
    assert label_agreement(pairs, labels.withColumn("label", F.col("aisle"))).first()["agreement"] == pytest.approx(2 / 3)


def test_routing_hands_on_bounded_batches(spark, tmp_path, monkeypatch):
    """However many tiles a query is copied to, a batch holds a bounded number of vectors, and the answers stay."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 8))
    vectors = items(spark, x)
    index = V.VectorIndex.build(vectors, str(tmp_path / "index"), tile_rows=4)
    asked = queries(spark, x)
    wanted = sorted(tuple(r) for r in index.search(asked, 3, True).collect())
    sizes = []

    class Frames:
        def mapInPandas(self, run, schema):
            for part in run(iter([asked.toPandas()])):
                sizes.append(len(part))

    monkeypatch.setattr(V, "_CARRIED", 8 * 50)
    monkeypatch.setattr(V, "_ROUTED", 1000)
    every = lambda layout, q, pdf: (*np.nonzero(np.broadcast_to(layout.count > 0, (len(q), len(layout.count)))), np.zeros(len(q)))
    index._route(Frames(), every)
    assert max(sizes) <= 50 and sum(sizes) >= 400 * (index.layout.tile.max() + 1) * 0.9
    assert sorted(tuple(r) for r in index.search(asked, 3, True).collect()) == wanted


def test_vectors_without_groups_are_not_copied(spark, monkeypatch):
    """Where bounds leave most tiles open, neither search writes a copy of a query for each of them; rows stay the same."""
    x = np.random.default_rng(9).normal(size=(600, 10))
    vectors, asked = items(spark, x), queries(spark, x)
    written = []
    real = V.stage
    monkeypatch.setattr(V, "stage", lambda df, label="stage": written.append(label) or real(df, label))
    index = V.VectorIndex.build(vectors, tile_rows=20)
    same(collected(index.search(asked, 5, True)), brute(x, x, 5, True))
    few = collected(index.search_approx(asked, 5, True, probes=20))
    assert "visits" not in written
    monkeypatch.setattr(V, "MOST_COPIES", 10**6)
    assert few == collected(index.search_approx(asked, 5, True, probes=20)) and "visits" in written


@pytest.mark.parametrize("numbers", [262_144, 30])
def test_blocks_pass_in_any_size(spark, clustered, monkeypatch, numbers):
    """Equal vectors, repeated and null ids, numbers that four bytes hold and others, few queries and many."""
    monkeypatch.setattr(V, "BLOCK_NUMBERS", numbers)
    x = np.vstack([clustered[:90], clustered[-60:], np.float32(clustered[:40]).astype(float) * 1e6])
    rows = [(i, 0, [float(v) for v in p]) for i, p in enumerate(x)]
    held = V.packed(spark.createDataFrame([*rows, rows[3]], "id long, cell int, vec array<double>").repartition(2))
    expected = brute(np.vstack([x, x[3]]), x, 4, False)
    for some in (x, x[:2]):
        got = collected(V.passing(queries(spark, some), held, 4, False))
        assert set(got) == set(range(len(some)))
        for q, found in got.items():
            assert found == [(3 if i == len(x) else i, pytest.approx(d)) for i, d in sorted(expected[q], key=lambda r: (r[1], 3 if r[0] == len(x) else r[0]))]
    unnamed = spark.createDataFrame([(None, [float(v) for v in x[0]]), (7, [float(v) for v in x[7]])], "qid long, qvec array<double>")
    got = {r["qid"]: r["iid"] for r in V.passing(unnamed, held, 1, True).collect()}
    assert got == {None: 0, 7: brute(x, x, 1, True)[7][0][0]}


def test_agreement_over_passing_blocks(spark, monkeypatch):
    """The neighbours whose labels are compared come without copies of queries for tiles."""
    x = np.random.default_rng(10).normal(size=(300, 12))
    written = []
    real = V.stage
    monkeypatch.setattr(V, "stage", lambda df, label="stage": written.append(label) or real(df, label))
    pairs = nearest(queries(spark, x), items(spark, x), 10, True, small_rows=100, block=10)
    row = label_agreement(pairs, spark.createDataFrame([(i, i % 3) for i in range(300)], "id long, label int")).first()
    wanted = [i % 3 == j % 3 for i, rows in brute(x, x, 10, True).items() for j, _ in rows]
    assert (row["agreement"], row["n_pairs"]) == (pytest.approx(np.mean(wanted)), 3000)
    assert "visits" not in written
