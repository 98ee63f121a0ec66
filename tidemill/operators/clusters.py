"""Cluster scores and density clustering."""

from __future__ import annotations

from functools import reduce
from itertools import product
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.joins import bounded, fits
from tidemill.operators.neighbors import BLOCK_ROWS, SMALL_NUMBERS, SMALL_ROWS, _matrix, _small, blockwise, euclidean, squared_distances
from tidemill.operators.ordering import global_row_number
from tidemill.operators.vector_index import lloyd
from tidemill.session import stage


def centroids(df: DataFrame, label: str, vec: str, dims: int) -> DataFrame:
    mean = F.array(*[F.avg(F.col(vec)[i].cast("double")) for i in range(dims)])
    return df.groupBy(label).agg(mean.alias("center"), F.count(F.lit(1)).alias("n"))


def worst_ratios(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Per cluster of ``a`` the largest ratio of spreads to centre distance with a cluster of ``b``; coinciding centres don't count.

    The clusters of ``b`` fall into groups; a group's ball and largest spread bound its ratios, so most groups are
    skipped once a near one has been seen.
    """
    q, x, sq, sx = _matrix(a["c"]), _matrix(b["c"]), a["s"].to_numpy(), b["s"].to_numpy()
    ids, others = a["id"].to_numpy(), b["id"].to_numpy()
    middle = lloyd(x, max(1, int(sqrt(len(x)))), 2)
    home = squared_distances(x, middle).argmin(1)
    to_middle = np.sqrt(squared_distances(q, middle))
    groups = [np.flatnonzero(home == g) for g in range(len(middle))]
    reach = np.array([np.sqrt(((x[g] - middle[i]) ** 2).sum(1)).max() if len(g) else 0.0 for i, g in enumerate(groups)])
    largest = np.array([sx[g].max() if len(g) else 0.0 for g in groups])
    best = np.full(len(q), -np.inf)
    for turn in np.argsort(to_middle, axis=1).T:
        for g in np.unique(turn).tolist():
            rows = np.flatnonzero(turn == g)
            gap = to_middle[rows, g] - reach[g] - 1e-9
            rows = rows[(gap <= 0) | ((sq[rows] + largest[g]) >= best[rows] * gap)]
            for lo in range(0, len(rows) if len(groups[g]) else 0, 256):
                part = rows[lo:lo + 256]
                d = np.sqrt(((q[part][:, None, :] - x[groups[g]][None, :, :]) ** 2).sum(2))
                counts = (d > 0) & (ids[part][:, None] != others[groups[g]][None, :])
                ratio = np.where(counts, (sq[part][:, None] + sx[groups[g]][None, :]) / np.where(counts, d, 1), -np.inf)
                best[part] = np.maximum(best[part], ratio.max(1))
    met = np.isfinite(best)
    return pd.DataFrame({"id": ids[met], "w": best[met]})


def davies_bouldin(df: DataFrame, label: str, vec: str, dims: int, block: int = BLOCK_ROWS) -> DataFrame:
    """Mean over the clusters of the worst ratio of spreads to centre distance, for any number of clusters.

    Centres meet in blocks; within a pair of blocks groups of centres are left out that cannot hold a worse ratio.
    """
    rows = df.select(label, F.col(vec).cast("array<double>").alias("_v"))
    centers = stage(centroids(rows, label, "_v", dims), "centers")
    spread = rows.join(bounded(centers), label).groupBy(label).agg(
        F.avg(euclidean(F.col("_v"), F.col("center"))).alias("s"), F.first("center").alias("c")
    )
    spread = stage(spread.select("s", "c", F.monotonically_increasing_id().alias("id"), F.lit(0).alias("cell")), "spread")
    worst = blockwise(spread, spread, worst_ratios, "id long, w double", block).groupBy("id").agg(F.max("w").alias("w"))
    return worst.agg(F.avg("w").alias("davies_bouldin"))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labellings from their contingency counts."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("n"))
    choose = lambda c: F.sum(c * (c - 1) / 2)
    both = cells.agg(choose(F.col("n")).alias("ij"), F.sum("n").alias("all"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(choose(F.col("n")).alias("i"))
    cols = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(choose(F.col("n")).alias("j"))
    one = both.join(F.broadcast(rows)).join(F.broadcast(cols))
    expected = F.col("i") * F.col("j") / (F.col("all") * (F.col("all") - 1) / 2)
    return one.select(F.try_divide(F.col("ij") - expected, (F.col("i") + F.col("j")) / 2 - expected).alias("adjusted_rand"))


def _silhouette(sums: DataFrame, sizes: DataFrame) -> DataFrame:
    """Mean silhouette from (id, own, other, total distance); single-member clusters score zero."""
    joined = sums.join(bounded(sizes.select(F.col("label").alias("other"), "n")), "other")
    same = F.col("own") == F.col("other")
    per_point = joined.groupBy("id").agg(
        F.max(F.when(same & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~same, F.col("total") / F.col("n"))).alias("b"),
    )
    score = F.when(F.col("a").isNull(), 0.0).otherwise(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")))
    return per_point.agg(F.avg(F.coalesce(score, F.lit(0.0))).alias("silhouette"))


def _balls(points: DataFrame) -> DataFrame:
    """Per label its size, mean vector and mean squared distance from it."""
    dims = points.agg(F.max(F.size("vec"))).first()[0] or 0
    norm = F.aggregate(F.transform("vec", lambda v: v * v), F.lit(0.0), lambda acc, v: acc + v)
    mean = F.array(*[F.avg(F.col("vec")[i]) for i in range(dims)])
    return points.groupBy("label").agg(F.count(F.lit(1)).alias("n"), mean.alias("center"), F.avg(norm).alias("square"))


def _candidates(points: DataFrame, balls: DataFrame) -> DataFrame:
    """A row for each point and each cluster that may be its own or its nearest by mean distance.

    The mean distance to a cluster lies between the distance to its mean and the root of that distance squared plus
    the cluster's variance, so clusters beyond the least upper bound are left out.
    """
    held = balls.toPandas()
    centers, labels = _matrix(held["center"]), held["label"].to_numpy()
    variance = np.maximum(held["square"].to_numpy() - (centers * centers).sum(1), 0)
    data = points.sparkSession.sparkContext.broadcast((centers, labels, variance))
    step = max(1, 2_000_000 // max(1, len(labels)))

    def run(frames):
        centers, labels, variance = data.value
        for whole in frames:
            for lo in range(0, len(whole), step):
                pdf = whole.iloc[lo:lo + step]
                squares = squared_distances(_matrix(pdf["vec"]), centers)
                own = pdf["label"].to_numpy()[:, None] == labels[None, :]
                upper = np.where(own, np.inf, np.sqrt(squares + variance))
                slack = 1e-6 * (1 + np.sqrt(squares))
                wanted = own | (np.sqrt(squares) - slack <= upper.min(1)[:, None])
                yield pdf.assign(cells=[labels[w] for w in wanted])

    # A vector is written once, with the list of its cells.
    listed = stage(points.mapInPandas(run, "id long, vec array<double>, label long, cells array<long>"), "visits")
    return listed.select("id", "vec", "label", F.explode("cells").alias("cell"))


#: Numbers of the vectors in a block of a silhouette; every block is copied to the blocks that it meets.
BLOCK_NUMBERS = 2_000_000


def silhouette(points: DataFrame, small_rows: int = SMALL_ROWS, block: int | None = None) -> DataFrame:
    """Exact Euclidean silhouette of (id, vec, label).

    Every point needs its distance to all of its own cluster and to the clusters that may be nearest; bounds from the
    clusters' means and variances rule out the others. Clusters meet their visitors block by block and hand on one sum
    per point and cluster, so a cluster with a third of all points is many tasks. ``silhouette_squared`` has linear cost.
    """
    points = points.select(F.col("id").cast("long"), F.col("vec").cast("array<double>"), F.col("label").cast("long"))
    schema = "id long, own long, other long, total double"

    def totals(ids, own, q, x, groups):
        levels, where = np.unique(groups, return_inverse=True)
        member = np.zeros((len(x), len(levels)))
        member[np.arange(len(x)), where] = 1
        step = max(1, 2_000_000 // max(1, len(x)))
        for lo in range(0, len(q), step):
            d = np.sqrt(squared_distances(q[lo:lo + step], x)) @ member
            m = len(d)
            yield pd.DataFrame({
                "id": np.repeat(ids[lo:lo + step], len(levels)), "own": np.repeat(own[lo:lo + step], len(levels)),
                "other": np.tile(levels, m), "total": d.ravel(),
            })

    if _small(points, "vec", small_rows):
        sizes = stage(points.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "sizes")
        held = points.toPandas()
        data = points.sparkSession.sparkContext.broadcast((_matrix(held["vec"]), held["label"].to_numpy()))

        def scan(frames):
            x, groups = data.value
            for pdf in frames:
                if len(pdf):
                    yield from totals(pdf["id"].to_numpy(), pdf["label"].to_numpy(), _matrix(pdf["vec"]), x, groups)

        sums = points.mapInPandas(scan, schema)
    else:
        def meet(a, b):
            return pd.concat(list(totals(a["id"].to_numpy(), a["label"].to_numpy(), _matrix(a["vec"]), _matrix(b["vec"]), b["cell"].to_numpy())))

        sizes = stage(_balls(points), "balls")
        held = points.withColumn("cell", F.col("label"))
        # Beyond so many numbers the bounds are not broadcast, and every point visits every cluster.
        size = sizes.agg(F.sum(F.size("center")).alias("all"), F.max(F.size("center")).alias("dims")).first()
        if (size["all"] or 0) <= SMALL_NUMBERS:
            visits = _candidates(points, sizes)
        else:
            visits = stage(points.join(sizes.select(F.col("label").alias("cell"))), "visits")
        sums = blockwise(visits, held, meet, schema, block or max(BLOCK_ROWS, min(8 * BLOCK_ROWS, BLOCK_NUMBERS // max(1, size["dims"] or 0))))
    summed = sums.groupBy("id", "own", "other").agg(F.sum("total").alias("total"))
    return _silhouette(summed, sizes.select("label", "n"))


CARRIED_CLUSTERS = 10_000


def silhouette_squared(points: DataFrame, dims: int) -> DataFrame:
    """Silhouette under squared Euclidean distance, linear in the table: a cluster's sums give its total distance."""
    rows = points.select("id", F.col("vec").cast("array<double>").alias("vec"), "label")
    norm = F.aggregate(F.transform("vec", lambda v: v * v), F.lit(0.0), lambda acc, v: acc + v)
    clusters = rows.withColumn("_sq", norm).groupBy(F.col("label").alias("other")).agg(
        F.array(*[F.sum(F.col("vec")[i]) for i in range(dims)]).alias("_sum"), F.sum("_sq").alias("_sumsq"), F.count(F.lit(1)).alias("_n")
    )
    clusters = stage(clusters, "clusters")
    if not fits(clusters, CARRIED_CLUSTERS):
        raise ValueError(f"more than {CARRIED_CLUSTERS} clusters: every point would carry a distance to each")
    gathered = clusters.agg(F.collect_list(F.struct("other", "_sum", "_sumsq", "_n")).alias("_clusters"))
    dot = lambda c: F.aggregate(F.zip_with("vec", c["_sum"], lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    total = lambda c: F.struct(c["other"].alias("other"), (c["_n"] * norm - 2 * dot(c) + c["_sumsq"]).alias("total"))
    sums = rows.join(F.broadcast(gathered)).select("id", F.col("label").alias("own"), F.explode(F.transform("_clusters", total)).alias("t"))
    sizes = clusters.select(F.col("other").alias("label"), F.col("_n").alias("n"))
    return _silhouette(sums.select("id", "own", "t.other", "t.total"), sizes)


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest vertex reachable from each vertex: (v, component).

    Each round takes the least label around and then the label of that label, so chains shrink by more than half;
    every round is written out, and rounds go on until no label changes.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stage(vertices.select("v", F.col("v").alias("component")), "labels")
    while True:
        around = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("component").alias("_m"))
        lowered = labels.join(around, F.col("v") == F.col("a"), "left").select(
            "v", F.col("component").alias("_old"), F.least("component", "_m").alias("component")
        )
        jump = lowered.select(F.col("v").alias("_t"), F.col("component").alias("_j"))
        hopped = lowered.join(jump, F.col("component") == F.col("_t"))
        following = stage(hopped.select("v", "_old", F.least("component", "_j").alias("component")), "labels")
        labels = following.drop("_old")
        if following.filter("component <> _old").isEmpty():
            return labels


def _near_offsets(dims: int) -> list[tuple[int, ...]]:
    """Cells, relative to one's own, that may hold a point within eps when the cell diagonal is eps."""
    reach = ceil(sqrt(dims))
    gap = lambda o: sum(max(abs(v) - 1, 0) ** 2 for v in o)
    return [o for o in product(range(-reach, reach + 1), repeat=dims) if gap(o) < dims + 1e-9]


FEW_POINTS = 32


def _by_block(df: DataFrame, crowded: DataFrame, cell: str = "cell") -> DataFrame:
    """Each row once for every block of its cell, as ``_b``; only crowded cells have more than one."""
    named = crowded.select(F.col("cell").alias("_crowded"), F.col("_nb").alias("_blocks"))
    blocks = F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1)
    return df.join(bounded(named, MOST_CROWDED), F.col(cell) == F.col("_crowded"), "left").withColumn("_b", F.explode(blocks)).drop("_crowded", "_blocks")


#: Crowded cells are one in a block of points at most; so many are broadcast.
MOST_CROWDED = 500_000


def _meet(probes: DataFrame, points: DataFrame, crowded: DataFrame, eps: float) -> DataFrame:
    """Probe rows (id, x, cell) joined with the points (id, x, cell, _b) of their cell that lie within eps.

    Points are dealt to the blocks of their cell and probes visit each of them, so no join key gathers a whole cell.
    """
    left = _by_block(probes.select(F.col("id").alias("pid"), F.col("x").alias("px"), "cell"), crowded)
    return left.join(points, ["cell", "_b"]).filter(_squared(F.col("px"), F.col("x")) <= eps * eps)


def _squared(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda acc, v: acc + v)


def _linked_cells(core: DataFrame, crowded: DataFrame, around, eps: float, dims: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Core cells with their first point, and the pairs of them that hold points within eps of each other.

    Cells of few points compare all of them inside one row; crowded ones compare their extreme
    points first, and only pairs left open by that meet point by point, block by block.
    """
    sizes = core.groupBy("cell").agg(
        F.count(F.lit(1)).alias("_n"), F.min("id").alias("first_id"),
        F.array_distinct(F.flatten(F.array(*[
            F.array(F.min_by("x", F.col("x")[i]), F.max_by("x", F.col("x")[i])) for i in range(dims)
        ]))).alias("extremes"),
    )
    few = core.filter("NOT crowded").join(sizes.filter(F.col("_n") <= FEW_POINTS).select("cell"), "cell", "left_semi")
    listed = few.groupBy("cell").agg(F.collect_list("x").alias("every"))
    cells = stage(sizes.join(listed, "cell", "left").select(
        "cell", "first_id", F.coalesce("every", "extremes").alias("shown"), F.col("every").isNotNull().alias("whole")
    ), "cells")
    ahead = cells.select(F.col("cell").alias("a"), F.col("shown").alias("sa"), F.col("whole").alias("wa"), F.explode(around(F.col("cell"))).alias("b"))
    other = cells.select(F.col("cell").alias("b"), F.col("shown").alias("sb"), F.col("whole").alias("wb"))
    linked = F.exists("sa", lambda p: F.exists("sb", lambda q: _squared(p, q) <= eps * eps))
    pairs = ahead.filter("a < b").join(other, "b").select("a", "b", linked.alias("linked"), (F.col("wa") & F.col("wb")).alias("settled"))
    pairs = stage(pairs.filter("linked OR NOT settled"), "pairs")
    unsettled = pairs.filter("NOT linked").select("a", "b", F.concat_ws("|", "a", "b").alias("pair"))

    def touches(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        hit = (squared_by_axis(_matrix(a["x"]), _matrix(b["x"])) <= eps * eps).any()
        return pd.DataFrame({"pair": [a["cell"].iloc[0]]}) if hit else pd.DataFrame()

    edges = pairs.filter("linked").select("a", "b")
    if unsettled.limit(1).count():
        def side(end: str) -> DataFrame:
            wanted = _by_block(unsettled.select(F.col(end).alias("cell"), "pair"), crowded)
            return core.join(wanted, ["cell", "_b"]).select("id", "x", F.col("pair").alias("cell"))

        found = blockwise(side("a"), side("b"), touches, "pair string", block).distinct()
        edges = edges.union(unsettled.join(found, "pair").select("a", "b"))
    return cells.select(F.col("cell").alias("v"), "first_id"), edges


def squared_by_axis(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared distances without the rounding of the dot-product form."""
    return sum((q[:, i][:, None] - x[:, i][None, :]) ** 2 for i in range(q.shape[1]))


def dbscan(points: DataFrame, eps: float, min_samples: int, dims: int = 2, block: int = BLOCK_ROWS) -> DataFrame:
    """Density clusters of (id, x) for a small number of dimensions: (id, is_core, cluster), noise is -1.

    The grid's cell diagonal is eps, so points of one cell are mutual neighbours: crowded cells
    are core without any comparison and components are built over cells. Only the few points
    of thin cells look into the cells around them.
    """
    side = eps / sqrt(dims) * (1 - 1e-12)
    cell = F.concat_ws(",", F.transform("x", lambda v: F.floor(v / side).cast("string")))
    pts = stage(points.select(F.col("id").cast("long"), F.col("x").cast("array<double>"), cell.alias("cell")), "points")
    offsets = F.array(*[F.array(*[F.lit(v) for v in o]) for o in _near_offsets(dims)])

    def around(c: Column) -> Column:
        own = F.split(c, ",").cast("array<bigint>")
        return F.transform(offsets, lambda o: F.concat_ws(",", F.zip_with(own, o, lambda a, b: (a + b).cast("string"))))

    per_cell = stage(pts.groupBy("cell").agg(F.count(F.lit(1)).alias("_n")), "counts")
    crowded = per_cell.filter(F.col("_n") > block).select("cell", F.ceil(F.col("_n") / block).cast("int").alias("_nb"))
    # From here on every point has a block of its cell, and joins go by cell and block.
    mine = F.pmod(F.xxhash64("id"), F.coalesce("_nb", F.lit(1))).cast("int").alias("_b")
    pts = stage(pts.join(bounded(crowded, MOST_CROWDED), "cell", "left").select("id", "x", "cell", mine, F.col("_nb").isNotNull().alias("crowded")), "points")
    sized = pts.join(_by_block(per_cell, crowded), ["cell", "_b"])
    probes = sized.filter(F.col("_n") < min_samples).select("id", "x", F.explode(around(F.col("cell"))).alias("cell"))
    counted = _meet(probes, pts, crowded, eps).groupBy(F.col("pid").alias("id")).agg(F.count(F.lit(1)).alias("_near"))
    flagged = stage(sized.join(counted, "id", "left").select(
        "id", "x", "cell", "_b", "crowded", (F.coalesce("_near", "_n") >= min_samples).alias("is_core")
    ), "cores")
    core = flagged.filter("is_core").select("id", "x", "cell", "_b", "crowded")

    vertices, edges = _linked_cells(core, crowded, around, eps, dims, block)
    named = connected_components(vertices, edges).join(vertices, "v")
    firsts = named.groupBy("component").agg(F.min("first_id").alias("first_id"))
    numbers = global_row_number(firsts, ["first_id"], "cluster", 0).drop("first_id")
    cell_cluster = stage(_by_block(named.join(numbers, "component").select(F.col("v").alias("cell"), "cluster"), crowded), "clusters")

    loose = flagged.filter("NOT is_core").select("id", "x", F.explode(around(F.col("cell"))).alias("cell"))
    border = _meet(loose, core.join(cell_cluster, ["cell", "_b"]), crowded, eps).groupBy(F.col("pid").alias("id")).agg(
        F.min("cluster").alias("_border")
    )
    return (
        flagged.select("id", "cell", "_b", "is_core")
        .join(cell_cluster, ["cell", "_b"], "left")
        .join(border, "id", "left")
        .select("id", "is_core", F.coalesce(F.when(F.col("is_core"), F.col("cluster")), "_border", F.lit(-1).cast("long")).alias("cluster"))
    )


def kmeans_sweep(points: DataFrame, ks: list[int], dims: int, seed: int = 42) -> DataFrame:
    """Inertia, silhouette, Davies-Bouldin and adjusted Rand index of (id, vec, label) for each number of clusters."""
    source = stage(points, "points").withColumn("features", array_to_vector("vec"))
    spread = ClusteringEvaluator(featuresCol="features", predictionCol="prediction")
    rows = []
    for k in ks:
        model = KMeans(k=k, seed=seed).fit(source)
        fitted = stage(model.transform(source).select("id", "vec", "label", "features", "prediction"), "fitted")
        one = davies_bouldin(fitted, "prediction", "vec", dims).join(F.broadcast(adjusted_rand(fitted, "label", "prediction")))
        rows.append(one.select(
            F.lit(k).alias("k"), F.lit(model.summary.trainingCost).alias("inertia"), F.lit(spread.evaluate(fitted)).alias("silhouette"),
            "davies_bouldin", "adjusted_rand",
        ))
    return reduce(lambda a, b: a.unionAll(b), rows)


def dbscan_sweep(points: DataFrame, settings: list[tuple[float, int]], dims: int = 2) -> DataFrame:
    """Scores of the density clusters of (id, x, label) for each (eps, min_samples); noise counts as a cluster."""
    rows = []
    for eps, min_samples in settings:
        found = stage(dbscan(points.select("id", "x"), eps, min_samples, dims).join(points.select("id", "x", "label"), "id"), "found")
        counts = found.agg(
            F.countDistinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"), F.count_if(F.col("cluster") < 0).alias("n_noise")
        )
        scores = [
            silhouette(found.select("id", F.col("x").alias("vec"), F.col("cluster").alias("label"))),
            davies_bouldin(found, "cluster", "x", dims), adjusted_rand(found, "label", "cluster"),
        ]
        one = reduce(lambda a, b: a.join(F.broadcast(b)), scores, counts)
        rows.append(one.select(F.lit(eps).alias("eps"), F.lit(min_samples).alias("min_samples"), "*"))
    return reduce(lambda a, b: a.unionAll(b), rows)


def grid_labels(model, points: DataFrame, features: str) -> DataFrame:
    """Cluster of points that took no part in the fit."""
    return model.transform(points).drop(features)
