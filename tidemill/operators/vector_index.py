"""Stored index of vectors: two levels of centres with the vectors filed below them, for exact and approximate search.

For n vectors there are about n ** 1/4 coarse centres with as many fine ones each, so sqrt(n) cells of sqrt(n)
vectors; a query is routed with 2 n ** 1/4 distances. Centres are means of a bounded sample (``TRAINING_ROWS`` vectors
for each), every vector is filed. Cells are packed into tiles, the unit that a task searches: small cells of one coarse
centre share a tile, and a cell above ``TILE_ROWS`` is dealt to several, so a cell with a third of all vectors becomes
many tiles. What reaches the driver are the centres and one row of figures for each cell.

Exact search bounds the distance to a cell by the triangle inequality on both levels. It goes in rounds - the nearest
tile, the next few cells, and the rest - and the bound that a round leaves decides which tiles a query is copied to in the
next one; inside a task, cells are taken nearest first and the bound tightens from cell to cell.

Approximate search looks at the ``probes`` nearest cells. How many that must be depends on the data, so it is measured
when the index is built: the exact neighbours of ``CALIBRATION_ROWS`` vectors tell how many cells reach the wanted recall.

Where vectors have no groups, a query would be copied to a large part of all tiles, which grows with the square of the
table. Sampled vectors tell how many copies a search makes. Above ``MOST_COPIES`` nothing is copied: both sides are
packed into blocks, and every task reads all blocks of vectors past the few blocks of queries that it holds
(``passing``). That takes as many distances as there are pairs, and disk in proportion to the two tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.operators.joins import bounded
from tidemill.session import exists, scratch_path, stage

#: Sampled vectors for each centre, and Lloyd steps on them.
TRAINING_ROWS = 64
STEPS = 8
TILE_ROWS = 4_096
#: Cells of the second round of an exact search.
NEAR_CELLS = 4
CALIBRATION_ROWS = 256
RECALL = 0.95
PAIRS = "qid long, iid long, dist double"
_VISITS = "id long, vec array<double>, bound double, cell long, fine array<int>"
#: Block counts of so many cells are broadcast, a few bytes each.
MOST_SIZES = 500_000
_SLACK = 1e-9
_CHUNK = 500_000
#: Distances to centres that a task holds while it routes queries, and numbers of vectors in a batch that it hands on.
_ROUTED = 500_000
_CARRIED = 500_000
#: Tiles that a query may be copied to on average, and filed vectors that tell how many it would be.
MOST_COPIES = 3
PROBED_ROWS = 64
#: Numbers in a block of vectors, blocks of queries that a task holds, and distances that it holds.
BLOCK_NUMBERS = 262_144
TASK_BLOCKS = 4
_HELD = 500_000
_BLOCKS = "block long, dims int, ids array<bigint>, cells array<int>, vecs binary"


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in column]) if len(column) else np.zeros((0, 0))


def squared_distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.maximum((q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * q @ x.T, 0)


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.sqrt(squared_distances(q, x))


def closest(qids, q, iids, x, k: int, skip_same: bool) -> pd.DataFrame:
    """The ``k`` items nearest to each query, ties going to the lower id."""
    frames = []
    step = max(1, _CHUNK // max(1, len(x)))
    for lo in range(0, len(q), step):
        part, ids = q[lo:lo + step], qids[lo:lo + step]
        rough = squared_distances(part, x)
        if skip_same:
            rough[ids[:, None] == iids[None, :]] = np.inf
        kth = np.partition(rough, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
        rows, cols = np.nonzero((rough <= (kth + 1e-9 * (1 + np.where(np.isfinite(kth), kth, 0)))[:, None]) & np.isfinite(rough))
        # Equal vectors may leave nearly every pair open, so their differences are taken a bounded number at a time.
        some = max(1, _CARRIED // max(1, x.shape[1]))
        dist = np.empty(len(rows))
        for at in range(0, len(rows), some):
            dist[at:at + some] = np.round(np.sqrt(((part[rows[at:at + some]] - x[cols[at:at + some]]) ** 2).sum(1)), 10)
        order = np.lexsort((iids[cols], dist, rows))
        rows, cols, dist = rows[order], cols[order], dist[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < k
        frames.append(pd.DataFrame({"qid": ids[rows[keep]], "iid": iids[cols[keep]], "dist": dist[keep]}))
    return pd.concat(frames) if frames else pd.DataFrame({"qid": [], "iid": [], "dist": []})


def lloyd(x: np.ndarray, k: int, steps: int = STEPS) -> np.ndarray:
    """Means of up to ``k`` groups of the rows, from evenly spaced rows on; rows come in hash order."""
    centers = np.unique(x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)], axis=0)
    for _ in range(steps):
        home = squared_distances(x, centers).argmin(1)
        counts = np.bincount(home, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, home, x)
        centers = np.where((counts > 0)[:, None], sums / np.maximum(counts, 1)[:, None], centers)
    return np.unique(centers, axis=0)


def best_k(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy("dist", "iid")
    ranked = candidates.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)


def _hash_order() -> Column:
    return F.md5(F.col("iid").cast("string"))


def blockwise(
    probes: DataFrame, points: DataFrame, fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, block: int = TILE_ROWS
) -> DataFrame:
    """Run ``fn(probe block, point block)`` for the rows that share a ``cell``.

    Both sides of a cell are cut into blocks of about ``block`` rows, and every block of one
    side meets every block of the other, so no group outgrows a task. Rows need an ``id``.
    """
    n_probe = probes.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_np"))
    n_point = points.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_ni"))
    # A row for each cell that both sides have; above the bound adaptive execution splits crowded cells.
    sizes = bounded(stage(n_probe.join(n_point, "cell"), "sizes"), MOST_SIZES)
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = probes.join(sizes, "cell").withColumn("_a", own("_np")).withColumn("_b", every("_ni")).drop("_np", "_ni")
    right = points.join(sizes, "cell").withColumn("_b", own("_ni")).withColumn("_a", every("_np")).drop("_np", "_ni")
    keys = ["cell", "_a", "_b"]
    right = right.select([F.col(c).alias(c) for c in right.columns])  # both sides may stem from one table
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        lambda a, b: fn(a, b) if len(a) and len(b) else pd.DataFrame(), schema
    )


class Layout:
    """Centres and figures of all cells, as arrays; this is what travels to the tasks."""

    def __init__(self, coarse: np.ndarray, cells: pd.DataFrame, tile_rows: int = TILE_ROWS):
        cells = cells.sort_values(["coarse", "fine"])
        self.coarse = coarse
        self.home, self.fine = cells["coarse"].to_numpy(), cells["fine"].to_numpy()
        self.centers = matrix(cells["center"])
        self.count = cells["n"].fillna(0).to_numpy().astype(np.int64)
        # Distances from the fine centre, and from the coarse one.
        self.lo, self.hi, self.lo1, self.hi1 = (cells[c].fillna(f).to_numpy(float) for c, f in (("lo", np.inf), ("hi", -np.inf), ("lo1", np.inf), ("hi1", -np.inf)))
        self.first = np.searchsorted(self.home, np.arange(len(coarse) + 1))
        # Tiles: cells of a coarse centre in a row until they are full; a crowded cell has several of its own.
        tile, parts, now, filled = [], [], 0, 0
        for i, n in enumerate(self.count.tolist()):
            new = i == 0 or self.home[i] != self.home[i - 1] or filled + n > tile_rows
            if new and i:
                now, filled = now + parts[-1], 0
            cut = max(1, math.ceil(n / tile_rows))
            tile.append(now)
            parts.append(cut)
            filled = filled + n if cut == 1 else tile_rows
        self.tile, self.parts = np.array(tile, np.int64), np.array(parts, np.int64)

    def least(self, q: np.ndarray) -> np.ndarray:
        """Lower bound of the distance from each query to anything in each cell, by both levels; infinite for empty cells."""
        d1 = distances(q, self.coarse)[:, self.home]
        d2 = distances(q, self.centers)
        low = np.maximum(np.maximum(d2 - self.hi, self.lo - d2), np.maximum(d1 - self.hi1, self.lo1 - d1))
        return np.where(self.count > 0, np.maximum(low, 0), np.inf)

    def nearest_cells(self, q: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns of the ``probes`` nearest filled cells: coarse centres in order until they hold twice as many, then their cells."""
        filled = self.count > 0
        upto = np.concatenate([[0], np.cumsum(filled)])
        size = upto[self.first[1:]] - upto[self.first[:-1]]
        d1 = np.where(size > 0, distances(q, self.coarse), np.inf)
        order = np.argsort(d1, axis=1, kind="stable")
        before = np.cumsum(size[order], axis=1) - size[order]
        chosen = np.zeros(d1.shape, bool)
        np.put_along_axis(chosen, order, before < 2 * probes, axis=1)
        d2 = np.full((len(q), len(self.centers)), np.inf)
        for c in np.flatnonzero(chosen.any(axis=0)).tolist():
            rows, cells = np.flatnonzero(chosen[:, c]), slice(self.first[c], self.first[c + 1])
            d2[rows, cells] = np.where(filled[cells], distances(q[rows], self.centers[cells]), np.inf)
        take = min(probes, d2.shape[1])
        kth = np.partition(d2, take - 1, axis=1)[:, take - 1]
        return np.nonzero((d2 <= kth[:, None]) & np.isfinite(d2))

    def home_tiles(self, q: np.ndarray) -> np.ndarray:
        """Tile of each query's nearest cell."""
        rows, cells = self.nearest_cells(q, 1)
        out = np.full(len(q), -1, np.int64)
        out[rows[::-1]] = self.tile[cells[::-1]]
        return out

    def tiles_of(self, rows: np.ndarray, cells: np.ndarray) -> pd.DataFrame:
        """Row numbers and cells -> one line for each row and tile, with the tile's wanted cells."""
        times = self.parts[cells]
        firsts = np.cumsum(times) - times
        part = np.arange(int(times.sum())) - np.repeat(firsts, times)
        frame = pd.DataFrame({"row": np.repeat(rows, times), "cell": np.repeat(self.tile[cells], times) + part, "fine": np.repeat(cells, times)})
        return frame.groupby(["row", "cell"], sort=True)["fine"].agg(list).reset_index()


def _packed(most: int, numbers: int | None = None):
    """Rows (id, cell, vec) -> blocks of at most ``most`` vectors, with four bytes a number where that loses nothing."""
    numbers = numbers or BLOCK_NUMBERS

    def run(batches):
        first, made, rest = TaskContext.get().partitionId() << 33, 0, None

        def block(rows: pa.Table) -> pa.RecordBatch:
            nonlocal made
            x = pc.list_flatten(rows.column("vec")).combine_chunks().to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                short = x.astype(np.float32)
            made += 1
            lists = lambda c, kind: pa.array([rows.column(c).combine_chunks().cast(kind)], pa.list_(kind))
            return pa.RecordBatch.from_arrays(
                [pa.array([first + made]), pa.array([len(x) // len(rows)], pa.int32()), lists("id", pa.int64()), lists("cell", pa.int32()),
                 pa.array([(short if (short == x).all() else x).tobytes()], pa.binary())], names=["block", "dims", "ids", "cells", "vecs"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, rows]) if rest is not None and len(rest) else rows
            step = max(1, min(most, numbers // max(1, len(rest.column("vec")[0].as_py())))) if len(rest) else 1
            while len(rest) >= step:
                yield block(rest.slice(0, step))
                rest = rest.slice(step)
        if rest is not None and len(rest):
            yield block(rest)

    return run



class Asked:
    """A block of queries and the ``k`` best that they have met."""

    def __init__(self, ids: pa.Array, q: np.ndarray, k: int, skip_same: bool, wanted: np.ndarray | None):
        self.unnamed = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        self.q, self.k, self.skip_same, self.wanted = q, k, skip_same, wanted
        self.squares = (q * q).sum(1)
        self.longest = math.sqrt(np.nanmax(self.squares, initial=0))
        raised = np.hstack([q, np.ones((len(q), 1))])
        with np.errstate(over="ignore"):
            self.raised = {np.float64: raised, np.float32: raised.astype(np.float32)}
        self.dist, self.iids = np.full((len(q), k), np.inf), np.zeros((len(q), k), np.int64)

    def _open(self, rows: np.ndarray, cols: np.ndarray, held: Held) -> np.ndarray:
        """Whether a query may take an item: not itself, and of a cell that it wants."""
        out = np.ones(len(rows), bool)
        if self.skip_same:
            out = (self.ids[rows] != held.iids[cols]) | self.unnamed[rows]
        if self.wanted is not None:
            out &= self.wanted[rows, held.cells[cols]]
        return out

    def meet(self, held: Held) -> None:
        # Half the bytes do for the first look while their error is far below the distances that are in question.
        error = 6e-8 * (held.x.shape[1] + 4) * (self.longest + held.longest) ** 2
        kth = self.dist[:, -1]
        kind = np.float32 if np.isfinite(kth).all() and error <= 1e-4 * np.median(kth) ** 2 else np.float64
        step = max(1, _HELD // max(1, len(held.x)))
        for lo in range(0, len(self.q), step):
            self._meet(np.arange(lo, min(lo + step, len(self.q))), held, kind)

    def _meet(self, rows: np.ndarray, held: Held, kind: type) -> None:
        # |x|^2 - 2 q x in one product; a query's own square stands on the side of its limit.
        rough = self.raised[kind][rows] @ held.raised(kind).T
        own, kth = self.squares[rows], self.dist[rows, -1]
        error = np.finfo(kind).eps * (held.x.shape[1] + 4) * (np.sqrt(own) + held.longest) ** 2
        limit = (kth + 1e-10) ** 2 * (1 + 1e-9) - own + 1e-9 + error
        if len(new := np.flatnonzero(~np.isfinite(kth))) and len(held.x) > self.k:
            near = rough[new]
            at, cols = np.divmod(np.arange(near.size), near.shape[1])
            near.ravel()[~self._open(rows[new][at], cols, held)] = np.inf
            best = np.partition(near, self.k - 1, axis=1)[:, self.k - 1]
            limit[new] = best + 1e-9 * (1 + np.where(np.isfinite(best), best + own[new], 0)) + 2 * error[new]
        limit = np.nextafter(limit.astype(kind), kind(np.inf))
        at, cols = np.divmod(np.flatnonzero(rough <= limit[:, None]), rough.shape[1])
        keep = self._open(rows[at], cols, held)
        at, cols = at[keep], cols[keep]
        # Equal vectors may leave nearly every pair open, so their differences are taken a bounded number at a time.
        some = max(1, _CARRIED // max(1, held.x.shape[1]))
        dist = np.empty(len(at))
        for i in range(0, len(at), some):
            dist[i:i + some] = np.round(np.sqrt(((self.q[rows[at[i:i + some]]] - held.x[cols[i:i + some]]) ** 2).sum(1)), 10)
        keep = (dist <= kth[at]) & np.isfinite(dist)
        if keep.any():
            self._take(rows[at[keep]], held.iids[cols[keep]], dist[keep])

    def _take(self, rows: np.ndarray, iids: np.ndarray, dist: np.ndarray) -> None:
        """Merge what was found with the best so far, ties going to the lower id."""
        touched, line = np.unique(rows, return_inverse=True)
        had = np.isfinite(self.dist[touched])
        line = np.concatenate([np.nonzero(had)[0], line])
        dist, iids = np.concatenate([self.dist[touched][had], dist]), np.concatenate([self.iids[touched][had], iids])
        order = np.lexsort((iids, dist, line))
        line, dist, iids = line[order], dist[order], iids[order]
        place = np.arange(len(line)) - np.searchsorted(line, line)
        keep = place < self.k
        self.dist[touched] = np.inf
        self.dist[touched[line[keep]], place[keep]] = dist[keep]
        self.iids[touched[line[keep]], place[keep]] = iids[keep]

    def found(self) -> pa.RecordBatch:
        rows, place = np.nonzero(np.isfinite(self.dist))
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[rows], pa.int64(), mask=self.unnamed[rows]), pa.array(self.iids[rows, place], pa.int64()), pa.array(self.dist[rows, place]), pa.array(place + 1, pa.int32())],
            names=["qid", "iid", "dist", "rank"])


def _few_of_each(iids: np.ndarray, x: np.ndarray, cells: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among the ``k`` best: of equal vectors those of the lowest ids, and as many more as one id has rows."""
    whole = np.ascontiguousarray(np.hstack([x, cells[:, None]]))
    group = np.unique(whole.view(np.dtype((np.void, whole.itemsize * whole.shape[1]))).ravel(), return_inverse=True)[1].ravel()
    order = np.lexsort((iids, group))
    kind, named = group[order], iids[order]
    place = np.arange(len(kind)) - np.searchsorted(kind, kind)
    run = np.cumsum(np.concatenate([[False], (kind[1:] != kind[:-1]) | (named[1:] != named[:-1])]))
    most = np.zeros(int(kind[-1]) + 1, np.int64)
    np.maximum.at(most, kind, np.bincount(run)[run])
    return np.sort(order[place < k + most[kind]])


class Held:
    """A block of items that queries meet."""

    def __init__(self, iids: np.ndarray, x: np.ndarray, cells: np.ndarray, k: int):
        squares = (x * x).sum(1)
        if len(np.unique(squares)) < 0.9 * len(squares):
            keep = _few_of_each(iids, x, cells, k)
            iids, x, cells, squares = iids[keep], x[keep], cells[keep], squares[keep]
        self.iids, self.x, self.cells = iids, x, cells
        self._raised, self.longest = {np.float64: np.hstack([-2 * x, squares[:, None]])}, math.sqrt(np.nanmax(squares, initial=0))

    def raised(self, kind: type) -> np.ndarray:
        if kind not in self._raised:
            self._raised[kind] = self._raised[np.float64].astype(kind)
        return self._raised[kind]


def _block_of(batch: pa.RecordBatch, row: int, prefix: str) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Ids, vectors and cells of a packed block."""
    column = lambda name: batch.column(prefix + name)[row]
    ids, dims, raw = column("ids").values, column("dims").as_py(), column("vecs").as_buffer()
    kind = np.float32 if len(raw) == 4 * dims * len(ids) else np.float64
    return ids, np.frombuffer(raw, kind).reshape(-1, dims).astype(float), column("cells").values


def packed(items: DataFrame) -> DataFrame:
    """Rows (id, cell, vec) as written blocks."""
    return stage(items.select("id", "cell", "vec").mapInArrow(_packed(BLOCK_NUMBERS), _BLOCKS), "blocks")


def passing(queries: DataFrame, items: DataFrame, k: int, skip_same: bool, layout: Layout | None = None, probes: int = 0) -> DataFrame:
    """The ``k`` nearest of the packed items for every query (qid, qvec): qid, iid, dist, rank.

    Blocks of queries stay in a task while all blocks of items pass. With a layout a query takes items of its ``probes``
    nearest cells alone. Only the packed queries are shuffled; a few queries share the items between tasks.
    """
    spark = queries.sparkSession
    cores = spark.sparkContext.defaultParallelism
    asked = queries.filter("size(qvec) > 0 AND NOT exists(qvec, v -> v IS NULL)")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("qvec")).alias("dims"), F.countDistinct("qid").alias("ids")).first()
    most = max(1, math.ceil(size["n"] / (4 * cores)))
    blocks = math.ceil(size["n"] / max(1, min(most, BLOCK_NUMBERS // max(1, size["dims"] or 1))))
    tasks = max(1, min(blocks, max(4 * cores, math.ceil(blocks / TASK_BLOCKS))))
    shares = math.ceil(2 * cores / tasks) if tasks < 2 * cores else 1
    held = items.coalesce(shares)
    named = asked.select(F.col("qid").alias("id"), F.lit(0).alias("cell"), F.col("qvec").alias("vec")).mapInArrow(_packed(most), _BLOCKS)
    named = named.repartition(tasks).select([F.col(c).alias(f"q{c}") for c in named.columns])

    def wanted(q: np.ndarray) -> np.ndarray | None:
        if layout is None:
            return None
        out = np.zeros((len(q), len(layout.count)), bool)
        step = max(1, _ROUTED // max(1, len(layout.count)))
        for lo in range(0, len(q), step):
            rows, cells = layout.nearest_cells(q[lo:lo + step], probes)
            out[lo + rows, cells] = True
        return out

    def meet(batches):
        waiting, now, here = {}, None, None
        for batch in batches:
            for row in range(len(batch)):
                number, block = batch.column("qblock")[row].as_py(), batch.column("block")[row].as_py()
                if number not in waiting:
                    ids, q, _ = _block_of(batch, row, "q")
                    waiting[number] = Asked(ids, q, k, skip_same, wanted(q))
                if block != now:
                    iids, x, cells = _block_of(batch, row, "")
                    now, here = block, Held(iids.to_numpy(zero_copy_only=False), x, cells.to_numpy(zero_copy_only=False), k)
                waiting[number].meet(here)
        for one in waiting.values():
            yield one.found()

    # The hint makes Spark read one side past the other in place of broadcasting either.
    pairs = held.hint("shuffle_replicate_nl").crossJoin(named).mapInArrow(meet, f"{PAIRS}, rank int")
    # Parts of the items and rows with one id still have to meet.
    whole = shares == 1 and size["ids"] == size["n"]
    return pairs if whole else best_k(pairs.drop("rank"), k)



class VectorIndex:
    """Vectors (iid, vec) filed under the cells of a layout, in a folder that outlives the session."""

    def __init__(self, spark: SparkSession, path: str, tile_rows: int = TILE_ROWS):
        self.spark, self.path = spark, path
        centers = spark.read.parquet(f"{path}/coarse").orderBy("coarse").toPandas()
        self.layout = Layout(matrix(centers["center"]), spark.read.parquet(f"{path}/cells").toPandas(), tile_rows)
        self.vectors = spark.read.parquet(f"{path}/vectors")
        self._held: DataFrame | None = None

    @classmethod
    def build(cls, items: DataFrame, path: str | None = None, cells: int | None = None, tile_rows: int = TILE_ROWS) -> VectorIndex:
        """File the rows (iid, ivec) of ``items`` below ``path``, by default in the scratch area.

        Rows with a null id, a null or empty vector, or a null component are left out; ids are taken as they are, so
        a repeated id is found as often as it is filed. ``cells`` is the number of centres of each level.
        """
        spark = items.sparkSession
        path = path or scratch_path(spark, "index")
        clean = items.select(F.col("iid").cast("long"), F.col("ivec").cast("array<double>").alias("vec"))
        clean = clean.filter("iid IS NOT NULL AND size(vec) > 0 AND NOT exists(vec, v -> v IS NULL)")
        n = clean.count()
        k = cells or max(1, math.ceil(n ** 0.25))
        sample = clean.orderBy(_hash_order(), "iid").limit(TRAINING_ROWS * k).toPandas()
        coarse = lloyd(matrix(sample["vec"]), k) if len(sample) else np.zeros((0, 0))
        spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(coarse)], "coarse int, center array<double>").write.mode("overwrite").parquet(f"{path}/coarse")

        def to_coarse(frames):
            for pdf in frames:
                if len(pdf):
                    d = distances(matrix(pdf["vec"]), coarse)
                    yield pd.DataFrame({"iid": pdf["iid"], "vec": pdf["vec"], "coarse": d.argmin(1).astype("int32"), "reach1": d.min(1)})

        # Assigned anew by each reader, which takes no second copy of the vectors on disk.
        filed = clean.mapInPandas(to_coarse, "iid long, vec array<double>, coarse int, reach1 double")
        # The lowest hashes of a coarse cell; where they are a small part of it, the rest stays out of the shuffle.
        sizes = {r["coarse"]: r["n"] for r in filed.groupBy("coarse").agg(F.count(F.lit(1)).alias("n")).collect()}
        edges = [f"{min((1 << 32) - 1, int((1 << 32) * 1.5 * TRAINING_ROWS * k / sizes[c])) if c in sizes else 0:08x}~" for c in range(len(coarse))]
        lowest = Window.partitionBy("coarse").orderBy(_hash_order(), "iid")
        low = filed.filter(_hash_order() <= F.element_at(F.array(*[F.lit(e) for e in edges]), F.col("coarse") + 1)) if edges else filed
        drawn = low.withColumn("_rn", F.row_number().over(lowest)).filter(F.col("_rn") <= TRAINING_ROWS * k)

        def split(pdf: pd.DataFrame) -> pd.DataFrame:
            found = lloyd(matrix(pdf.sort_values("_rn")["vec"]), k)
            return pd.DataFrame({"coarse": pdf["coarse"].iloc[0], "fine": np.arange(len(found), dtype="int32"), "center": list(found)})

        fine = stage(drawn.select("coarse", "_rn", "vec").groupBy("coarse").applyInPandas(split, "coarse int, fine int, center array<double>"), "fine")
        held = fine.orderBy("coarse", "fine").toPandas()
        centers, first = matrix(held["center"]), np.searchsorted(held["coarse"].to_numpy(), np.arange(len(coarse) + 1))

        def to_fine(frames):
            for pdf in frames:
                x, home = matrix(pdf["vec"]), pdf["coarse"].to_numpy()
                place, reach = np.zeros(len(pdf), "int32"), np.zeros(len(pdf))
                for c in np.unique(home).tolist():
                    rows = np.flatnonzero(home == c)
                    d = distances(x[rows], centers[first[c]:first[c + 1]])
                    place[rows], reach[rows] = d.argmin(1), d.min(1)
                yield pdf.assign(fine=place, reach=reach)

        vectors = filed.mapInPandas(to_fine, "iid long, vec array<double>, coarse int, reach1 double, fine int, reach double")
        vectors.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/vectors")
        figures = spark.read.parquet(f"{path}/vectors").groupBy("coarse", "fine").agg(
            F.count(F.lit(1)).alias("n"), F.min("reach").alias("lo"), F.max("reach").alias("hi"), F.min("reach1").alias("lo1"), F.max("reach1").alias("hi1")
        )
        fine.join(figures, ["coarse", "fine"], "left").write.mode("overwrite").parquet(f"{path}/cells")
        return cls(spark, path, tile_rows)

    def calibrate(self, k: int, recall: float = RECALL, rows: int = CALIBRATION_ROWS) -> int:
        """Cells to look at for the wanted share of the ``k`` nearest, measured on ``rows`` filed vectors; kept in the folder."""
        layout = self.layout
        chosen = self.vectors.orderBy(_hash_order(), "iid").limit(rows).select(F.col("iid").alias("qid"), F.col("vec").alias("qvec")).dropDuplicates(["qid"])
        asked = stage(chosen, "asked")
        held = asked.toPandas()
        found = passing(asked, self._blocks(), k, True).join(self.vectors.select("iid", "coarse", "fine").distinct(), "iid").select("qid", "coarse", "fine").toPandas()
        probes = len(layout.count)
        if len(found):
            q = matrix(held["qvec"])
            line = pd.Index(held["qid"]).get_indexer(found["qid"])
            at = layout.first[found["coarse"].to_numpy()] + found["fine"].to_numpy()
            probes = 1
            while probes < len(layout.count):
                reached = np.zeros((len(q), len(layout.count)), bool)
                reached[layout.nearest_cells(q, probes)] = True
                if reached[line, at].mean() >= recall:
                    break
                probes = max(probes + 1, probes * 5 // 4)
        probes = min(probes, len(layout.count))
        self.spark.createDataFrame([(k, recall, probes)], "k int, recall double, probes int").write.mode("append").parquet(f"{self.path}/probes")
        return probes

    def probes_for(self, k: int, recall: float = RECALL) -> int:
        """The calibrated number of cells; measured first where the folder does not have it."""
        known = None
        if exists(self.spark, f"{self.path}/probes"):
            known = self.spark.read.parquet(f"{self.path}/probes").filter((F.col("k") >= k) & (F.col("recall") >= recall)).agg(F.min("probes")).first()[0]
        return known or self.calibrate(k, recall)

    def _blocks(self) -> DataFrame:
        """The filed vectors, packed once, with the places of their cells in the layout."""
        if self._held is None:
            first = F.array(*[F.lit(int(i)) for i in self.layout.first])
            place = (F.element_at(first, F.col("coarse") + 1) + F.col("fine")).cast("int")
            self._held = packed(self.vectors.select(F.col("iid").alias("id"), place.alias("cell"), "vec"))
        return self._held

    def open_share(self, k: int) -> float:
        """Share of the filed vectors that the bounds leave to a filed one that looks for its ``k`` nearest; on a sample."""
        if not self.layout.count.sum():
            return 0.0
        chosen = self.vectors.orderBy(_hash_order(), "iid").limit(PROBED_ROWS).select(F.col("iid").alias("qid"), F.col("vec").alias("qvec")).dropDuplicates(["qid"])
        asked = stage(chosen, "asked")
        held, found = asked.toPandas(), passing(asked, self._blocks(), k, True).filter(F.col("rank") == k).toPandas()
        bound = held["qid"].map(found.set_index("qid")["dist"]).fillna(np.inf).to_numpy()
        reached = self.layout.least(matrix(held["qvec"])) <= bound[:, None] + _SLACK
        return float((reached * self.layout.count).sum(1).mean() / self.layout.count.sum())

    def _tiles(self) -> int:
        return int((self.layout.tile + self.layout.parts).max()) if len(self.layout.tile) else 0

    def _copies(self, probes: int) -> float:
        """Tiles that hold the ``probes`` nearest cells of a filed vector; on a sample."""
        held = self.vectors.orderBy(_hash_order(), "iid").limit(PROBED_ROWS).toPandas()
        return len(self.layout.tiles_of(*self.layout.nearest_cells(matrix(held["vec"]), probes))) / max(1, len(held)) if len(held) else 0.0

    def _route(self, queries: DataFrame, pick) -> DataFrame:
        """Queries (qid, qvec, more) -> a row for each tile that ``pick(layout, vectors, frame)`` names, with its wanted cells and the bound."""
        layout = self.layout

        # Beside the distances, a query may be copied to every tile, so both bound the queries that are routed at once.
        step = max(1, _ROUTED // max(1, len(layout.count), int(layout.parts.sum())))
        some = max(1, _CARRIED // max(1, layout.coarse.shape[1] if layout.coarse.ndim == 2 else 1))

        def run(frames):
            for whole in frames:
                for lo in range(0, len(whole) if len(layout.count) else 0, step):
                    pdf = whole.iloc[lo:lo + step]
                    rows, cells, bound = pick(layout, matrix(pdf["qvec"]), pdf)
                    if not len(rows):
                        continue
                    lines = layout.tiles_of(rows, cells)
                    ids, vecs = pdf["qid"].to_numpy(), pdf["qvec"].to_numpy()
                    # A query's vector is copied once for each of its tiles: few copies go into one batch.
                    for first in range(0, len(lines), some):
                        few = lines.iloc[first:first + some]
                        at = few["row"].to_numpy()
                        yield pd.DataFrame({"id": ids[at], "vec": vecs[at], "bound": bound[at], "cell": few["cell"], "fine": few["fine"]})

        return queries.mapInPandas(run, _VISITS)

    def _probe(self, visits: DataFrame, k: int, skip_same: bool, block: int) -> DataFrame:
        layout = self.layout
        named = pd.DataFrame({"coarse": layout.home, "fine": layout.fine, "_tile": layout.tile, "_parts": layout.parts, "_at": np.arange(len(layout.count))})
        tiles = self.spark.createDataFrame(named.astype("int64"), "coarse long, fine long, _tile long, _parts long, _at long")
        tile = F.col("_tile") + F.pmod(F.xxhash64("iid", F.lit(11)), F.col("_parts"))
        placed = self.vectors.join(bounded(tiles, MOST_SIZES), ["coarse", "fine"]).select(F.col("iid").alias("id"), "vec", tile.alias("cell"), F.col("_at").alias("fine"))

        def scan(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            return search_tile(layout, a, b, k, skip_same)

        return blockwise(stage(visits, "visits"), placed, scan, PAIRS, block)

    def search(self, queries: DataFrame, k: int, skip_same: bool = False, block: int = TILE_ROWS) -> DataFrame:
        """The ``k`` nearest filed vectors of every query (qid, qvec), exactly: qid, iid, dist, rank."""
        queries = queries.select(F.col("qid").cast("long"), F.col("qvec").cast("array<double>")).filter("size(qvec) > 0")
        if self._tiles() > MOST_COPIES and self.open_share(k) * self._tiles() > MOST_COPIES:
            return passing(queries, self._blocks(), k, skip_same)

        def home(layout, q, pdf):
            rows, cells = np.nonzero(layout.home_tiles(q)[:, None] == layout.tile[None, :])
            return rows, cells, np.full(len(q), np.inf)

        def left(layout, q, bound):
            least = layout.least(q)
            seen = layout.home_tiles(q)[:, None] == layout.tile[None, :]
            return np.where(~seen & (least <= bound[:, None] + _SLACK), least, np.inf)

        def edge_of(least):
            take = min(NEAR_CELLS, least.shape[1]) - 1
            return np.partition(least, take, axis=1)[:, take][:, None]

        def near(layout, q, pdf):
            bound = pdf["bound"].fillna(np.inf).to_numpy()
            least = left(layout, q, bound)
            rows, cells = np.nonzero((least <= edge_of(least)) & np.isfinite(least))
            return rows, cells, bound

        def rest(layout, q, pdf):
            bound = pdf["tighter"].fillna(np.inf).to_numpy()
            least = left(layout, q, pdf["bound"].fillna(np.inf).to_numpy())
            rows, cells = np.nonzero((least > edge_of(least)) & (least <= bound[:, None] + _SLACK) & np.isfinite(least))
            return rows, cells, bound

        kth = lambda found, out: found.filter(F.col("rank") == k).select("qid", F.col("dist").alias(out))
        first = stage(best_k(self._probe(self._route(queries, home), k, skip_same, block), k), "first")
        asked = queries.join(kth(first, "bound"), "qid", "left")
        second = self._probe(self._route(asked, near), k, skip_same, block)
        second = stage(best_k(first.drop("rank").unionByName(second), k), "second")
        asked = asked.join(kth(second, "tighter"), "qid", "left")
        third = self._probe(self._route(asked, rest), k, skip_same, block)
        return best_k(second.drop("rank").unionByName(third), k)

    def search_approx(self, queries: DataFrame, k: int, skip_same: bool = False, probes: int | None = None, block: int = TILE_ROWS) -> DataFrame:
        """The ``k`` nearest vectors of the ``probes`` nearest cells, by default as many as the wanted recall takes."""
        queries = queries.select(F.col("qid").cast("long"), F.col("qvec").cast("array<double>")).filter("size(qvec) > 0")
        n = probes or self.probes_for(k)
        if self._tiles() > MOST_COPIES and self._copies(n) > MOST_COPIES:
            return passing(queries, self._blocks(), k, skip_same, self.layout, n)

        def pick(layout, q, pdf):
            rows, cells = layout.nearest_cells(q, n)
            return rows, cells, np.full(len(q), np.inf)

        return best_k(self._probe(self._route(queries, pick), k, skip_same, block), k)

    def neighbors_of(self, ids: DataFrame, k: int, exact: bool = False) -> DataFrame:
        """Neighbours of filed vectors that the caller names by id (first column); the vector itself is left out."""
        named = ids.select(F.col(ids.columns[0]).cast("long").alias("iid")).distinct()
        queries = self.vectors.join(named, "iid", "left_semi").select(F.col("iid").alias("qid"), F.col("vec").alias("qvec"))
        return self.search(queries, k, True) if exact else self.search_approx(queries, k, True)


def search_tile(layout: Layout, asked: pd.DataFrame, held: pd.DataFrame, k: int, skip_same: bool) -> pd.DataFrame:
    """Best ``k`` of a tile for each query: its cells in order, a cell only for queries that want it and whose bound reaches it."""
    qids, q = asked["id"].to_numpy(), matrix(asked["vec"])
    kth = asked["bound"].to_numpy(float).copy()
    wanted = [set(np.asarray(f).tolist()) for f in asked["fine"]]
    iids, x, fine = held["id"].to_numpy(), matrix(held["vec"]), held["fine"].to_numpy()
    cells = np.unique(fine)
    d2 = distances(q, layout.centers[cells])
    least = np.maximum(np.maximum(d2 - layout.hi[cells], layout.lo[cells] - d2), 0)
    best = np.full((len(q), k), np.inf)
    frames = []
    for at in np.argsort(least.mean(axis=0)).tolist():
        cell = int(cells[at])
        rows = np.flatnonzero((least[:, at] <= kth + _SLACK) & np.fromiter((cell in w for w in wanted), bool, len(wanted)))
        inside = fine == cell
        if not len(rows):
            continue
        found = closest(qids[rows], q[rows], iids[inside], x[inside], k, skip_same)
        if not len(found):
            continue
        frames.append(found)
        # Distances so far, k for each query in rising order; the last one is the new bound.
        number = np.searchsorted(qids[rows], found["qid"].to_numpy(), sorter=np.argsort(qids[rows], kind="stable"))
        line = rows[np.argsort(qids[rows], kind="stable")[number]]
        place = found.groupby("qid", sort=False).cumcount().to_numpy()
        new = np.full((len(q), k), np.inf)
        new[line, place] = found["dist"].to_numpy()
        best = np.sort(np.concatenate([best, new], axis=1), axis=1)[:, :k]
        kth = np.minimum(kth, best[:, -1])
    if not frames:
        return pd.DataFrame()
    whole = pd.concat(frames).sort_values(["qid", "dist", "iid"])
    return whole[whole.groupby("qid").cumcount() < k]
