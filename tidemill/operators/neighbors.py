"""Nearest neighbours between two vector tables, votes and label agreement.

A table of few vectors is broadcast after its size has been checked. Larger ones are filed in an index of two levels of
centres, whose cells grow in number with the square root of the table (``vector_index``). Where a sample shows that the
index would leave most cells open, an exact search reads all vectors past the queries instead and builds none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.vector_index import MOST_COPIES, PAIRS, TILE_ROWS, VectorIndex, best_k, blockwise, closest, packed, passing, squared_distances  # noqa: F401
from tidemill.operators.vector_index import matrix as _matrix

SMALL_ROWS = 20_000
SMALL_NUMBERS = 5_000_000
BLOCK_ROWS = TILE_ROWS


def euclidean(a, b):
    """Distance of two array columns inside the JVM."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))


def _small(df: DataFrame, vec: str, max_rows: int) -> bool:
    """Whether the vectors may be broadcast: few rows and not too many numbers in them."""
    size = df.select(F.size(vec).alias("d")).limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum("d").alias("v")).first()
    return size["n"] <= max_rows and (size["v"] or 0) <= SMALL_NUMBERS


def _nearest_broadcast(queries: DataFrame, items: DataFrame, k: int, skip_same: bool) -> DataFrame:
    held = items.toPandas()
    data = queries.sparkSession.sparkContext.broadcast((held["iid"].to_numpy(), _matrix(held["ivec"])))

    def scan(frames):
        iids, x = data.value
        for pdf in frames:
            if len(pdf) and len(iids):
                yield closest(pdf["qid"].to_numpy(), _matrix(pdf["qvec"]), iids, x, k, skip_same)

    return queries.mapInPandas(scan, PAIRS)


def nearest(
    queries: DataFrame, items: DataFrame, k: int, skip_same: bool = False,
    small_rows: int = SMALL_ROWS, n_cells: int | None = None, block: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` items nearest to every query: (qid, iid, dist, rank).

    ``queries`` holds (qid, qvec), ``items`` (iid, ivec). Exact for any size.
    """
    queries = queries.select(F.col("qid").cast("long"), F.col("qvec").cast("array<double>"))
    items = items.select(F.col("iid").cast("long"), F.col("ivec").cast("array<double>"))
    if _small(items, "ivec", small_rows):
        return best_k(_nearest_broadcast(queries, items, k, skip_same), k)
    if not _grouped(items, k, small_rows, block):
        named = items.filter("iid IS NOT NULL AND size(ivec) > 0 AND NOT exists(ivec, v -> v IS NULL)")
        return passing(queries, packed(named.select(F.col("iid").alias("id"), F.lit(0).alias("cell"), F.col("ivec").alias("vec"))), k, skip_same)
    return VectorIndex.build(items, cells=n_cells, tile_rows=block).search(queries, k, skip_same, block)


def _grouped(items: DataFrame, k: int, sampled: int, block: int) -> bool:
    """Whether an index of all items would leave few tiles open to a query, by an index of about ``sampled`` of them.

    Its cells are wider and its bounds looser than those of the whole, so this errs towards no index.
    """
    n = items.count()
    tiles = math.ceil(n / block)
    if tiles <= MOST_COPIES:
        return True
    some = items.filter(F.pmod(F.xxhash64("iid"), F.lit(max(1, n // max(1, sampled)))) == 0)
    return VectorIndex.build(some).open_share(k) * tiles <= MOST_COPIES


def nearest_approx(
    queries: DataFrame, items: DataFrame, k: int, skip_same: bool = False, n_cells: int | None = None, n_probe: int | None = None, block: int = BLOCK_ROWS
) -> DataFrame:
    """Neighbours found in the ``n_probe`` cells closest to each query, by default as many as reach a recall of 0.95 on a sample."""
    return VectorIndex.build(items, cells=n_cells, tile_rows=block).search_approx(queries, k, skip_same, n_probe, block)


def vote(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Distance-weighted class of each query; neighbours at distance zero outvote all others."""
    labelled = pairs.join(labels.select(F.col("id").alias("iid"), "label"), "iid")
    exact = F.max(F.col("dist") == 0).over(Window.partitionBy("qid"))
    weight = F.when(exact, (F.col("dist") == 0).cast("double")).otherwise(1 / F.col("dist"))
    scores = labelled.withColumn("_w", weight).groupBy("qid", "label").agg(F.round(F.sum("_w"), 9).alias("_s"))
    return scores.groupBy("qid").agg(F.max_by("label", F.struct(F.col("_s"), -F.col("label"))).alias("prediction"))


def label_agreement(pairs: DataFrame, labels: DataFrame, by: str | list[str] = "label") -> DataFrame:
    """Share of neighbours that carry the label of their query: one column for each of several labels, after its name."""
    names = [by] if isinstance(by, str) else by
    q = labels.select(F.col("id").alias("qid"), F.struct(*names).alias("_q"))
    i = labels.select(F.col("id").alias("iid"), F.struct(*names).alias("_i"))
    matched = pairs.join(q, "qid").join(i, "iid")
    same: list[Column] = [F.avg((F.col(f"_q.{n}") == F.col(f"_i.{n}")).cast("double")).alias("agreement" if isinstance(by, str) else f"{n}_agreement") for n in names]
    return matched.agg(*same, F.count(F.lit(1)).alias("n_pairs"))
