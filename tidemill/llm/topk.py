"""Exact top-k inner-product search by distributed histogram selection.

Every query is scored against every row, block of queries by block of rows. The scores are not kept: each
round counts them in the bins of one histogram per query, sums the histograms over all blocks and narrows
each query's range to the bin that holds its k-th highest score. When every range is one score wide, or only
few scores stand at or above its lower end, a last scoring pass keeps the scores from that bound on, at most
k from each block, and ranks them by score and id.

A task adds the histograms of a query up and returns the bins from the top down to the one where its own count
reaches k: the k-th highest of all scores cannot lie lower, so no sum that matters lacks a part. That is at most
k rows a query, however many rows the task has scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import stage

#: Scores beyond it fall into the outermost bins.
LIMIT = 1 << 61
BINS = 256
QUERIES_PER_BLOCK = 512
ROWS_PER_BLOCK = 4096
#: Blocks of rows are dealt to slots, one for so many rows but SLOTS at least; every block of queries visits each slot once.
ROWS_PER_SLOT = 8 * ROWS_PER_BLOCK
SLOTS = 32
#: Histograms of so many blocks of queries are added up at once, 1 MB each.
HELD = 16
#: Rounds end when no more scores than this, times k, stand at or above the bound of any query.
FEW = 8


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Id and floor(scale * x) of the rows whose vectors have finite components only; an empty vector has none to score."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return rows.filter(v.isNotNull() & F.col(id_col).isNotNull() & (F.size(v) > 0) & ~bad).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))


def _dims(vectors: pa.Array) -> np.ndarray:
    return np.diff(vectors.offsets.to_numpy())


def _blocks(size: int):
    """Rows -> binary blocks of at most ``size`` vectors of one length: dim, ids, values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, values = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()), "vectors": pa.array([values.tobytes()], pa.binary())})

        for batch in batches:
            vectors, ids = batch.column("v"), batch.column("id").to_numpy()
            flat, offsets, dims = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy(), _dims(vectors)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                for part in np.split(rows, range(size, len(rows), size)):
                    have = sum(len(x[0]) for x in held.get(dim, []))
                    if have and have + len(part) > size:
                        yield block(dim)
                    held.setdefault(dim, []).append((ids[part], flat[offsets[part][:, None] + np.arange(dim)].ravel()))
        for dim in list(held):
            yield block(dim)

    return run


BLOCK_SCHEMA = "dim int, ids binary, vectors binary"


def _scores(q: bytes, c: bytes, dim: int) -> np.ndarray:
    """Whole-number scores: by float64 while all sums stay below 2^53, else by int64."""
    a, b = np.frombuffer(q, np.int64).reshape(-1, dim), np.frombuffer(c, np.int64).reshape(-1, dim)
    peak = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * dim
    if peak < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: a row carries two blocks."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _top_bins(ids: np.ndarray, counts: np.ndarray, k: int) -> pa.RecordBatch:
    """Id, bin and count of the bins that are not empty, per query from the highest to the one that completes k scores."""
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
    at, which = np.nonzero((counts > 0) & (above < k))
    return pa.RecordBatch.from_pydict({"id": ids[at], "bin": which.astype(np.int32), "n": counts[at, which]})


def _count(k: int):
    """Pairs of blocks -> per query how many scores fall into each bin of its range, and how many above it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        for row in _rows(batches):
            ids, cand = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
            low, width = np.frombuffer(row["low"], np.int64), np.frombuffer(row["width"], np.int64)
            scores = _scores(row["q_vectors"], row["vectors"], row["dim"])
            bins = np.clip((np.clip(scores, -LIMIT, LIMIT) - low[:, None]) // width[:, None], -1, BINS) + 1
            bins[cand[None, :] == ids[:, None]] = 0
            flat = (bins + np.arange(len(ids))[:, None] * (BINS + 2)).ravel()
            counts = np.bincount(flat, minlength=len(ids) * (BINS + 2)).reshape(len(ids), -1)[:, 1:].astype(np.int64)
            if row["q_ids"] in held:
                held[row["q_ids"]] += counts
            else:
                if len(held) == HELD:
                    first = next(iter(held))
                    yield _top_bins(np.frombuffer(first, np.int64), held.pop(first), k)
                held[row["q_ids"]] = counts
        for key, counts in held.items():
            yield _top_bins(np.frombuffer(key, np.int64), counts, k)

    return run


def _best(k: int):
    """Pairs of blocks -> per query the k best scores from its bound on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, cand, low = (np.frombuffer(row[n], np.int64) for n in ("q_ids", "ids", "low"))
            scores = _scores(row["q_vectors"], row["vectors"], row["dim"])
            which, at = np.nonzero((np.clip(scores, -LIMIT, LIMIT) >= low[:, None]) & (cand[None, :] != ids[:, None]))
            if not len(at):
                continue
            order = np.lexsort((cand[at], -scores[which, at], which))
            which, at = which[order], at[order]
            starts = np.flatnonzero(np.diff(which, prepend=-1))
            nth = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
            which, at = which[nth < k], at[nth < k]
            yield pa.RecordBatch.from_pydict({"id": ids[which], "other": cand[at], "score": scores[which, at]})

    return run


def _pairs(queries: DataFrame, state: DataFrame, blocks: DataFrame, slots: int) -> DataFrame:
    """Every block of queries (with the range of each) beside every block of rows of the same vector length."""
    rows = queries.join(state, "id").groupBy("q_block").agg(F.sort_array(F.collect_list(F.struct("id", "v", "low", "width"))).alias("q"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q = row["q"]
                packed = {n: np.array([x[n] for x in q], np.int64).tobytes() for n in ("low", "width")}
                packed |= {"q_ids": np.array([x["id"] for x in q], np.int64).tobytes(), "q_vectors": np.array([x["v"] for x in q], np.int64).tobytes()}
                yield pa.RecordBatch.from_pydict({"dim": pa.array([len(q[0]["v"])], pa.int32())} | {n: pa.array([b], pa.binary()) for n, b in packed.items()})

    packed = rows.mapInArrow(pack, "dim int, low binary, width binary, q_ids binary, q_vectors binary")
    return packed.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).join(blocks, ["dim", "slot"])


def top_k(
    rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256,
    out: tuple[str, str, str, str] = ("query_id", "rank", "vec_id", "score"),
) -> DataFrame:
    """The k highest integer inner products of every query row with all other rows; ties go to the smaller id.

    Rows with a null id, a null or empty vector, or null or non-finite components take no part, and only vectors
    of equal length meet. All rows of the query's own id are left out; of rows that repeat an id with different
    vectors the smallest vector counts. A query with fewer than k others has them all; empty tables give none.
    Scores must fit 64 bits; the ranges of histograms end at 2^61, and what lies beyond counts as their last bin.
    """
    vectors = stage(integer_vectors(rows.select(id_col, vector_col), id_col, vector_col, scale).groupBy("id").agg(F.min("v").alias("v")), "vectors")
    queries = vectors.join(rows.filter(is_query).select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    # Blocks of queries: as many hash slots as the count asks for, per vector length.
    n_queries = queries.count()
    q_blocks = max(1, -(-n_queries // QUERIES_PER_BLOCK))
    q_block = F.struct(F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(q_blocks)).alias("slot"))
    queries = stage(queries.withColumn("q_block", q_block), "queries")
    slots = max(SLOTS, -(-vectors.count() // ROWS_PER_SLOT))
    blocks = vectors.mapInArrow(_blocks(ROWS_PER_BLOCK), BLOCK_SCHEMA)
    blocks = stage(blocks.withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int")), "blocks")

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    peaks = vectors.groupBy(F.size("v").alias("dim")).agg(F.max(norm).alias("peak"))
    reach = F.ceil(F.least(norm * F.col("peak") * 1.0001 + 1, F.lit(float(LIMIT)))).cast("long")
    state = queries.select("id", "v", F.size("v").alias("dim")).join(peaks, "dim").select(
        "id", (-reach).alias("low"), (F.floor(reach / (BINS // 2)) + 1).cast("long").alias("width"), F.lit(0).cast("long").alias("above")
    )
    state = stage(state, "ranges")
    while True:
        counted = _pairs(queries, state, blocks, slots).mapInArrow(_count(k), "id long, bin int, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("id").orderBy(F.desc("bin"))  # at most BINS + 1 rows a query
        upto = counted.withColumn("upto", F.sum("n").over(down))
        hit = upto.filter(F.col("upto") >= k).groupBy("id").agg(F.max(F.struct("bin", "upto", "n")).alias("b"))
        narrowed = state.join(hit, "id", "left").select(
            "id",
            # Fewer than k others: all of them count, so the bound stays at the lower end.
            F.when(F.col("b").isNull(), F.col("low")).otherwise(F.col("low") + F.col("b.bin") * F.col("width")).alias("low"),
            F.when(F.col("b").isNull(), F.lit(1)).otherwise(F.ceil(F.col("width") / BINS)).cast("long").alias("width"),
            F.when(F.col("b").isNull() | (F.col("width") == 1), F.lit(0)).otherwise(F.col("b.upto")).cast("long").alias("above"),
        )
        state = stage(narrowed, "ranges")
        if (state.agg(F.max("above")).first()[0] or 0) <= FEW * k:
            break
    best = _pairs(queries, state, blocks, slots).mapInArrow(_best(k), "id long, other long, score long")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "other"))).filter(F.col("rank") <= k)
    return ranked.select(F.col("id").alias(out[0]), F.col("rank").alias(out[1]), F.col("other").alias(out[2]), F.col("score").alias(out[3]))
