"""Neighbour and cluster jobs against brute force, with copies and crowded cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import clusters as C
from tidemill.operators import learning as L
from tidemill.operators import neighbors as N


@pytest.fixture(scope="module")
def cloud():
    """Three groups, one third of all rows being copies of a single vector."""
    r = np.random.default_rng(7)
    groups = [r.normal(c, 0.4, (60, 3)) for c in (-3.0, 0.0, 4.0)]
    copies = np.repeat([[4.0, 4.0, 4.0]], 90, axis=0)
    return np.vstack([*groups, copies])


def frame(spark, x, prefix):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, f"{prefix}id long, {prefix}vec array<double>").repartition(4)


def brute(x, k):
    out = {}
    for i in range(len(x)):
        d = np.round(np.sqrt(((x - x[i]) ** 2).sum(1)), 10)
        order = [j for j in np.lexsort((np.arange(len(x)), d)) if j != i][:k]
        out[i] = [(int(j), float(d[j])) for j in order]
    return out


@pytest.mark.parametrize("small_rows,block", [(10_000, 4096), (0, 4096), (0, 25)])
def test_nearest_is_exact(spark, cloud, small_rows, block):
    pairs = N.nearest(frame(spark, cloud, "q"), frame(spark, cloud, "i"), 6, True, small_rows, n_cells=5, block=block)
    got = {}
    for r in sorted(pairs.collect(), key=lambda r: (r["qid"], r["rank"])):
        got.setdefault(r["qid"], []).append((r["iid"], r["dist"]))
    expected = brute(cloud, 6)
    assert set(got) == set(expected)
    for q, rows in expected.items():
        assert [i for i, _ in got[q]] == [i for i, _ in rows]
        assert [d for _, d in got[q]] == pytest.approx([d for _, d in rows])


def test_approximate_neighbours_find_most(spark, cloud):
    pairs = N.nearest_approx(frame(spark, cloud, "q"), frame(spark, cloud, "i"), 5, True, n_cells=6, n_probe=3).collect()
    expected = brute(cloud, 5)
    hits = sum(r["dist"] <= expected[r["qid"]][-1][1] + 1e-9 for r in pairs)
    assert hits / (5 * len(cloud)) > 0.9


def sklearn_like_dbscan(x, eps, min_samples):
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= min_samples
    label = np.full(len(x), -1)
    current = 0
    for i in range(len(x)):
        if not core[i] or label[i] >= 0:
            continue
        stack = [i]
        label[i] = current
        while stack:
            p = stack.pop()
            if core[p]:
                for j in np.nonzero(near[p])[0]:
                    if label[j] < 0:
                        label[j] = current
                        stack.append(j)
        current += 1
    return core, label


@pytest.mark.parametrize("block", [4096, 20])
def test_dbscan(spark, block):
    r = np.random.default_rng(3)
    ring = np.array([[np.cos(a) * 3, np.sin(a) * 3] for a in np.linspace(0, 6.2, 120)])
    x = np.vstack([r.normal(0, 0.3, (150, 2)), ring + r.normal(0, 0.05, ring.shape), r.uniform(-6, 6, (40, 2)), np.repeat([[5.0, 5.0]], 60, axis=0)])
    core, label = sklearn_like_dbscan(x, 0.3, 5)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, x array<double>")
    got = {g["id"]: g for g in C.dbscan(df, 0.3, 5, block=block).collect()}
    assert [got[i]["is_core"] for i in range(len(x))] == core.tolist()
    assert [got[i]["cluster"] for i in range(len(x)) if core[i]] == label[core].tolist()
    assert [got[i]["cluster"] < 0 for i in range(len(x))] == (label < 0).tolist()


def test_silhouette_block_path(spark, cloud):
    labels = np.repeat([0, 1, 2, 2], [60, 60, 60, 90])
    rows = [(i, [float(v) for v in p], int(l)) for i, (p, l) in enumerate(zip(cloud, labels))]
    df = spark.createDataFrame(rows, "id long, vec array<double>, label long")
    small = C.silhouette(df).first()[0]
    blocks = C.silhouette(df, small_rows=0, block=40).first()[0]
    d = np.sqrt(((cloud[:, None] - cloud[None]) ** 2).sum(2))
    scores = []
    for i, own in enumerate(labels):
        a = d[i, labels == own].sum() / ((labels == own).sum() - 1)
        b = min(d[i, labels == o].mean() for o in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    assert small == pytest.approx(np.mean(scores), abs=1e-6)
    assert blocks == pytest.approx(small, abs=1e-9)


def test_components_of_a_long_chain(spark):
    v = spark.createDataFrame([(f"{i:04d}",) for i in range(300)], "v string")
    e = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(299) if i != 150], "a string, b string")
    roots = C.connected_components(v, e).groupBy("component").count().collect()
    assert sorted((r["component"], r["count"]) for r in roots) == [("0000", 151), ("0151", 149)]


def test_oversample_reaches_the_largest_class(spark):
    df = spark.range(107).withColumn("label", F.when(F.col("id") < 100, 0).otherwise(1))
    out = L.oversample(df, "id", "label")
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 100, 1: 100}
    chunked = L.repeat_rows(spark.range(1).withColumn("n", F.lit(1000).cast("long")), "id", "n", chunk=64)
    assert sorted(r["copy"] for r in chunked.collect()) == list(range(1, 1001))


def test_smote_points_lie_between_their_ends(spark, cloud):
    part = cloud[:60]
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(part)], "id long, vec array<double>")
    made = L.smote(df, 100, "s").collect()
    assert len(made) == 100
    for r in made:
        expected = part[r["base_id"]] + r["gap"] * (part[r["neighbor_id"]] - part[r["base_id"]])
        assert r["vec"] == pytest.approx(expected.tolist())
    again = L.smote(df.repartition(7), 100, "s").collect()
    key = lambda r: r["new_id"]
    assert [r["base_id"] for r in sorted(made, key=key)] == [r["base_id"] for r in sorted(again, key=key)]


def brute_davies_bouldin(x, labels):
    names = np.unique(labels)
    c = np.array([x[labels == n].mean(0) for n in names])
    s = np.array([np.sqrt(((x[labels == n] - c[i]) ** 2).sum(1)).mean() for i, n in enumerate(names)])
    worst = []
    for i in range(len(names)):
        d = np.sqrt(((c - c[i]) ** 2).sum(1))
        ok = (np.arange(len(names)) != i) & (d > 0)
        worst.append(((s[i] + s[ok]) / d[ok]).max())
    return np.mean(worst)


@pytest.mark.parametrize("block", [4096, 300])
def test_davies_bouldin_of_two_thousand_clusters(spark, block):
    r = np.random.default_rng(21)
    middles = r.uniform(-50, 50, (2000, 4))
    x = np.vstack([middles + r.normal(0, s, middles.shape) for s in (0.1, 0.5, 1.0)])
    labels = np.tile(np.arange(2000), 3)
    df = spark.createDataFrame([(int(l), [float(v) for v in p]) for l, p in zip(labels, x)], "label long, vec array<double>")
    assert C.davies_bouldin(df, "label", "vec", 4, block).first()[0] == pytest.approx(brute_davies_bouldin(x, labels))


def test_davies_bouldin_of_coinciding_centres_and_of_one_cluster(spark):
    rows = [(0, [1.0]), (0, [3.0]), (1, [2.0]), (2, [7.0]), (2, [9.0])]
    df = spark.createDataFrame(rows, "label long, vec array<double>")
    assert C.davies_bouldin(df, "label", "vec", 1).first()[0] == pytest.approx((2 / 6 + 1 / 6 + 2 / 6) / 3)
    assert C.davies_bouldin(df.filter("label = 0"), "label", "vec", 1).first()[0] is None


def test_silhouette_skips_clusters_that_cannot_be_nearest(spark):
    """Many far clusters: each point visits few of them, and the score is the exact one."""
    r = np.random.default_rng(8)
    middles = r.uniform(-100, 100, (50, 3))
    x = np.vstack([middles[i % 50] + r.normal(0, 0.5, 3) for i in range(600)])
    labels = np.arange(600) % 50
    df = spark.createDataFrame([(i, [float(v) for v in p], int(l)) for i, (p, l) in enumerate(zip(x, labels))], "id long, vec array<double>, label long")
    assert C.silhouette(df, small_rows=0, block=10).first()[0] == pytest.approx(C.silhouette(df).first()[0], abs=1e-9)
    assert C._candidates(df, C._balls(df)).count() < 600 * 6


@pytest.mark.parametrize("block", [4096, 25])
def test_dbscan_with_a_third_of_all_points_in_one_cell(spark, block):
    r = np.random.default_rng(13)
    dense = r.uniform(0, 0.05, (150, 2))
    x = np.vstack([dense, r.uniform(0.0, 3.0, (300, 2))])
    core, label = sklearn_like_dbscan(x, 0.2, 6)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, x array<double>")
    got = {g["id"]: g for g in C.dbscan(df, 0.2, 6, block=block).collect()}
    assert [got[i]["is_core"] for i in range(len(x))] == core.tolist()
    assert [got[i]["cluster"] for i in range(len(x)) if core[i]] == label[core].tolist()
    assert [got[i]["cluster"] < 0 for i in range(len(x))] == (label < 0).tolist()


def test_dbscan_needs_more_points_than_a_block_holds(spark):
    x = np.random.default_rng(14).uniform(0, 0.4, (120, 2))
    core, label = sklearn_like_dbscan(x, 0.3, 60)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, x array<double>")
    got = {g["id"]: g for g in C.dbscan(df, 0.3, 60, block=10).collect()}
    assert [got[i]["is_core"] for i in range(len(x))] == core.tolist()
    assert [got[i]["cluster"] < 0 for i in range(len(x))] == (label < 0).tolist()


def test_silhouette_copies_a_vector_to_few_blocks(spark, monkeypatch):
    """Blocks hold a bounded number of vector components, not 4 096 rows: a visitor meets fewer of them."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, [float(v) for v in p], i % 2) for i, p in enumerate(rng.normal(size=(300, 3)))], "id long, vec array<double>, label long")
    blocks = []
    real = C.blockwise
    monkeypatch.setattr(C, "blockwise", lambda a, b, fn, schema, block: blocks.append(block) or real(a, b, fn, schema, block))
    assert C.silhouette(df, small_rows=0).first()[0] == pytest.approx(C.silhouette(df).first()[0], abs=1e-9)
    assert blocks == [8 * C.BLOCK_ROWS]
