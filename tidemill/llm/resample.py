"""Importance resampling towards a target: hashed n-gram weights held in arrays, and exact ranks by regular sampling.

1. Word runs fall into buckets by CRC-32, worked out for whole arrays of words: the checksum of a longer run follows
   from those of its parts. Bucket counts of corpus and target give one gain for each bucket, and a document's weight
   is the sum of the gains of its runs.
2. Ranks come from parallel sorting by regular sampling. Every partition of the scored table is a locally sorted run.
   Rows at regular distances of all runs give the splitters of segments; segments that can hold a drawn document are
   exchanged and merged by a local sort, and prefix counts of the segments turn places into ranks. The order ends
   with a row number, so rows that tie in everything still fall into different segments.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import textbytes as tb
from tidemill.session import stage

BUCKETS = 10_000
LONGEST_RUN = 3
#: Rows of a segment, until there are as many segments as the driver keeps splitters for.
SEGMENT_ROWS = 50_000
SEGMENTS = 4096
#: Regular samples for each segment.
SAMPLES = 16

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits
_STEP = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _STEP = np.where(_STEP & 1, (_STEP >> 1) ^ np.uint32(0xEDB88320), _STEP >> 1).astype(np.uint32)
_LOOPED = 32


def _zero_bytes() -> np.ndarray:
    """For each length up to _LOOPED and each byte of a checksum: what that many zero bytes make of it."""
    now = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    out = [now]
    for _ in range(_LOOPED):
        now = _STEP[now & 0xFF] ^ (now >> 8)
        out.append(now)
    return np.concatenate(out)


_ZEROS = _zero_bytes()


def _shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out, left = crc, lengths
    while True:
        at = np.minimum(left, _LOOPED) * 1024
        out = _ZEROS[at + (out & 0xFF)] ^ _ZEROS[at + 256 + (out >> 8 & 0xFF)] ^ _ZEROS[at + 512 + (out >> 16 & 0xFF)] ^ _ZEROS[at + 768 + (out >> 24)]
        left = np.maximum(left - _LOOPED, 0)
        if not left.any():
            return out


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data``."""
    lengths = ends - starts
    state = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    on = np.arange(len(starts))
    for place in range(_LOOPED):
        on = on[lengths[on] > place]
        if not len(on):
            break
        state[on] = _STEP[(state[on] ^ data[starts[on] + place]) & 0xFF] ^ (state[on] >> 8)
    out = ~state
    for i in np.flatnonzero(lengths > _LOOPED).tolist():
        out[i] = crc32(data[starts[i] + _LOOPED:ends[i]], int(out[i]))
    return out


def run_buckets(piece: tb.Piece, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> tuple[list[np.ndarray], np.ndarray]:
    """For each length up to ``longest``, the bucket of the run that ends at each word (-1 where a text has no such run); and per text the index of its first word."""
    starts, ends, bounds = tb.word_spans(piece, tb.ALNUM)
    crc = span_crcs(tb.lowered(piece.data), starts, ends)
    lengths = ends - starts
    within = np.arange(len(starts)) - np.repeat(bounds[:-1], np.diff(bounds))
    out, runs = [], crc
    for n in range(1, longest + 1):
        if n > 1:
            spaced = ~(_STEP[(~runs[:-1] ^ np.uint32(0x20)) & 0xFF] ^ (~runs[:-1] >> 8))
            runs = np.concatenate([runs[:1], _shifted(spaced, lengths[1:]) ^ crc[1:]])
        out.append(np.where(within >= n - 1, (runs % np.uint32(buckets)).astype(np.int64), -1))
    return out, bounds


def _count(buckets: int):
    """Texts -> one row for each bucket, with the runs that the task met in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets + 1, np.int64)
        for batch in batches:
            for piece in tb.pieces(batch.column("_text")):
                for found in run_buckets(piece, buckets)[0]:
                    counts += np.bincount(found + 1, minlength=buckets + 1)
        met = np.flatnonzero(counts[1:])
        if len(met):
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(met, pa.int32()), "n": pa.array(counts[1:][met], pa.int64())})

    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Number of word runs in each bucket over all rows: as many numbers as there are buckets reach the driver."""
    rows = texts.select(F.col(f"`{text_col}`").alias("_text")).mapInArrow(_count(buckets), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed target and corpus shares, rounded down."""
    size, k = int(corpus.sum()), len(corpus)
    aim = int(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (size + float(k)) / ((s + 1.0) * (aim + float(k))))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ], np.int64)


def _score(gain, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.concatenate([[0], gain.value])  # bucket -1 gains nothing
        for batch in batches:
            hashes = batch.column("_h").to_pylist()
            for piece in tb.pieces(batch.column("_text")):
                found, bounds = run_buckets(piece, buckets)
                total = np.concatenate([[0], np.cumsum(sum(table[f + 1] for f in found))])
                weight = total[bounds[1:]] - total[bounds[:-1]]
                words = np.diff(bounds)
                features = sum(np.maximum(words - i, 0) for i in range(LONGEST_RUN))
                noise = np.array([math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in hashes[piece.first:piece.first + len(piece)]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(piece.first, len(piece)), *[pa.array(c, pa.int64()) for c in (words, features, weight, weight + noise)]],
                    names=["_id", "n_words", "n_features", "weight", "score"],
                )

    return run


def _place(score: int, ident, row: int) -> tuple:
    return (-score, ident is None, ident, row)


def _segments(splitters: list[tuple]):
    """Rows -> rows with the segment they fall into."""
    scores = np.array([s[0] for s in splitters], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            minus = -batch.column("score").to_numpy()
            segment, upto = np.searchsorted(scores, minus, "left"), np.searchsorted(scores, minus, "right")
            tied = np.flatnonzero(segment < upto)
            if len(tied):
                rows = batch.take(pa.array(tied))
                for i, s, ident, row in zip(tied.tolist(), rows.column("score").to_pylist(), rows.column("_id").to_pylist(), rows.column("_row").to_pylist(), strict=True):
                    segment[i] = bisect_right(splitters, _place(s, ident, row))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment, pa.int32())], names=[*batch.schema.names, "_segment"])

    return run


def ranked_runs(scored: DataFrame, least_words: int, percent: int, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``scored`` (_id, n_words, score and more) with the rank of the drawn rows: the ``percent`` of highest scores among rows of enough words."""
    spark = scored.sparkSession
    order = [F.col("score").desc(), F.col("_id").asc_nulls_last()]
    enough = F.col("n_words") >= least_words
    runs = stage(scored.sortWithinPartitions(enough.desc(), *order).withColumn("_row", F.monotonically_increasing_id()), "runs")
    able = runs.filter(enough)
    total = able.count()
    drawn = total * percent // 100
    none = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return runs.drop("_row").select("*", none)

    wanted = max(1, min(SEGMENTS, total // segment_rows))
    step = max(1, total // (SAMPLES * wanted))
    place = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # Runs start their samples at different places, or the ends of many short runs would never be met.
    phase = F.pmod(F.xxhash64(F.shiftright("_row", _ROW_BITS)), F.lit(step))
    samples = sorted(_place(*r) for r in able.filter(place % step == phase).select("score", "_id", "_row").collect())
    splitters = [samples[len(samples) * i // wanted] for i in range(1, wanted)] if len(samples) >= wanted else samples

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema)
    cut = able.mapInArrow(_segments(splitters), f"{kinds}, _segment int")
    before, counted = 0, []
    for segment, n in sorted(cut.groupBy("_segment").agg(F.count(F.lit(1)).alias("n")).collect()):
        counted.append((segment, before))
        before += n
    near = [(s, b) for s, b in counted if b < drawn]
    table = spark.createDataFrame(near, "_segment int, _before long")
    last = near[-1][0]
    merged = cut.filter(F.col("_segment") <= last).withColumn("_at", F.row_number().over(Window.partitionBy("_segment").orderBy(*order, "_row")))
    rank = F.col("_at") + F.col("_before")
    merged = merged.join(F.broadcast(table), "_segment").withColumn("rank", F.when(rank <= drawn, rank).cast("long"))
    names = [c for c in runs.columns if c != "_row"]
    beyond = cut.filter(F.col("_segment") > last).unionByName(runs.filter(~enough).withColumn("_segment", F.lit(0)))
    return merged.select(*names, "rank").unionAll(beyond.select(*names, none))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    seed: int = 42, percent: int = 5, least_words: int = 20, buckets: int = BUCKETS,
) -> DataFrame:
    """Per document: id, n_words, n_features, weight, score and rank, all long; rank is null where a document is not drawn.

    Features are runs of one to three words (A-Z lower-cased), the weight sums their gains towards the ``target``
    texts, and the score adds noise hashed from seed and id. Of the documents with ``least_words`` or more,
    ``percent`` in a hundred (rounded down) are drawn, highest scores first; ties go to the smaller id, a null id
    last, and rows that repeat an id share their noise and are told apart by an arbitrary but fixed order. Null and
    empty texts have no features, weight 0, and are never drawn while ``least_words`` is positive. A null id is
    hashed as an empty one. Empty tables on either side are allowed: without targets all gains come from smoothing.
    Other columns are not looked at, whatever their names.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    gain = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets)))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).cast("binary"), 256)
    shaped = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("_h"))
    scored = shaped.mapInArrow(_score(gain, buckets), f"_id {kind}, n_words long, n_features long, weight long, score long")
    return ranked_runs(scored, least_words, percent).withColumnRenamed("_id", id_col)
