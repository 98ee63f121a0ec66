"""Quality classifier: ordinal regression with cumulative links on hashed text features.

A document has one score, the sum of the weights of its distinct features; ordered thresholds turn it into
P(grade > j) = sigmoid(score - threshold_j). All grades share the weights. Features are hashed into
2^``bits`` slots: words, heads of words, and the shapes of tokens with their share of the text.
The model is fitted on a bounded sample of the rated documents; every document is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import textbytes as tb
from tidemill.session import stage

BITS = 20
#: Rated documents that a fit looks at, at most, and bytes of their feature slots; the lowest hashes of the id are taken.
#: A text has at most 2^BITS slots of four bytes, so the bytes always suffice for some.
SAMPLE_ROWS, SAMPLE_BYTES = 12_000, 32 << 20
HEAD_BYTES = 5
#: Slots get a weight if their log-likelihood ratio with the grades is at least this, so that chance words of long texts don't add up.
LEAST_RATIO = 16.0

# Classes of bytes in token shapes: upper case, lower case and above 0x7F, digits, each other byte for itself.
_SHAPE = np.arange(256, dtype=np.uint64)
_SHAPE[0x41:0x5B], _SHAPE[0x61:0x7B], _SHAPE[0x80:], _SHAPE[0x30:0x3A] = 1, 2, 2, 3


def features(piece: tb.Piece, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature slots of all texts, in text order, and the first one of each text."""
    starts, ends, bounds = tb.word_spans(piece, tb.ALNUM)
    low = tb.lowered(piece.data)
    words = tb.word_hashes(low, starts, ends)
    heads = tb.mix(tb.word_hashes(low, starts, np.minimum(ends, starts + HEAD_BYTES)) + np.uint64(1))
    doc = np.repeat(np.arange(len(piece)), np.diff(bounds))
    t_starts, t_ends, t_bounds = tb.word_spans(piece, tb.SPACED)
    last = _SHAPE[piece.data[t_ends - 1]]
    before = _SHAPE[piece.data[np.maximum(t_ends - 2, t_starts)]]
    shape = (_SHAPE[piece.data[t_starts]] << np.uint64(16)) | (before << np.uint64(8)) | last
    t_doc = np.repeat(np.arange(len(piece)), np.diff(t_bounds))
    pair, times = np.unique((t_doc.astype(np.uint64) << np.uint64(24)) | shape, return_counts=True)
    p_doc = (pair >> np.uint64(24)).astype(np.int64)
    share = np.ceil(4 * times / np.maximum(np.diff(t_bounds), 1)[p_doc]).astype(np.uint64)
    shapes = tb.mix(((pair & np.uint64(0xFFFFFF)) << np.uint64(8) | share) + np.uint64(2))
    # Whether a token repeats the one before it, as a share of the text.
    tokens = tb.word_hashes(piece.data, t_starts, t_ends)
    same = np.concatenate([[False], (tokens[1:] == tokens[:-1]) & (t_doc[1:] == t_doc[:-1])]) if len(tokens) else np.zeros(0, bool)
    repeated = np.bincount(t_doc[same], minlength=len(piece)) / np.maximum(np.diff(t_bounds), 1)
    repeats = tb.mix(np.ceil(4 * repeated).astype(np.uint64) + np.uint64(1 << 40))
    slot = np.uint64((1 << bits) - 1)
    keys = np.concatenate([
        (d.astype(np.uint64) << np.uint64(32)) | (h & slot) for d, h in ((doc, words), (doc, heads), (p_doc, shapes), (np.arange(len(piece)), repeats))
    ])
    keys = np.unique(keys)
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), np.searchsorted(keys, np.arange(len(piece) + 1, dtype=np.uint64) << np.uint64(32))


@dataclass
class OrdinalModel:
    """``weights`` by slot; ``thresholds`` ascend, one below each grade but the lowest of ``grades``."""

    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray
    bits: int = BITS

    def scores(self, slots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Every text has a feature, so no range is empty."""
        return np.add.reduceat(self.weights[slots], bounds[:-1]) if len(slots) else np.zeros(len(bounds) - 1)

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > grades[j]) by text and j."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -500, 500)))


def likelihood_ratio(here: np.ndarray, of_level: np.ndarray) -> np.ndarray:
    """G statistic of the presence of each slot against the grades; ``here`` counts texts by grade and slot."""
    total, n = here.sum(axis=0), of_level.sum()
    part = lambda seen, want: np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(want, 1e-12)), 0.0)
    return 2 * sum(part(h, total * m / n) + part(m - h, (n - total) * m / n) for h, m in zip(here, of_level, strict=True))


def fit_ordinal(texts: list[np.ndarray], grades: np.ndarray, bits: int = BITS, rounds: int = 300, decay: float = 1e-4, rate: float = 0.05, least_ratio: float = LEAST_RATIO) -> OrdinalModel:
    """Maximum likelihood of the cumulative-link model with an L2 penalty, by Adam over the whole sample: the distinct slots of each text, and its grade."""
    levels = np.unique(grades)
    level = np.searchsorted(levels, grades)
    n, k = len(grades), len(levels) - 1
    here = np.zeros((k + 1, 1 << bits), np.int32)
    for j, slots in zip(level, texts, strict=True):
        here[j, slots] += 1
    kept = likelihood_ratio(here, np.bincount(level, minlength=k + 1)) >= least_ratio
    used, number = np.flatnonzero(kept), np.cumsum(kept) - 1
    found = [number[slots[kept[slots]]] for slots in texts]
    row, column = np.repeat(np.arange(n), [len(f) for f in found]), np.concatenate(found)
    # Rare grades weigh as much as the square root of their share.
    weight = 1 / np.sqrt(np.bincount(level, minlength=k + 1))[level]
    weight *= n / weight.sum()
    freq = np.cumsum(np.bincount(level, weight, minlength=k + 1))[:-1] / n
    theta = np.log(freq / (1 - freq))
    gaps = np.log(np.maximum(np.diff(theta), 1e-3)) if k > 1 else np.zeros(0)
    x = np.concatenate([np.zeros(len(used)), theta[:1], gaps])
    m, v = np.zeros_like(x), np.zeros_like(x)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    for t in range(1, rounds + 1):
        w, theta = x[:len(used)], x[len(used)] + np.concatenate([[0], np.cumsum(np.exp(x[len(used) + 1:]))])
        s = np.bincount(row, w[column], minlength=n)
        f = sigmoid(np.concatenate([np.full((1, n), -np.inf), theta[:, None] - s, np.full((1, n), np.inf)]))
        hi, lo = f[level + 1, np.arange(n)], f[level, np.arange(n)]
        p = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = weight * hi * (1 - hi) / p / n, weight * lo * (1 - lo) / p / n
        g_s = d_hi - d_lo  # of the loss by the score
        g_w = np.bincount(column, g_s[row], minlength=len(used)) + decay * w
        g_theta = np.array([d_lo[level == j + 1].sum() - d_hi[level == j].sum() for j in range(k)])
        tails = np.cumsum(g_theta[::-1])[::-1]
        g = np.concatenate([g_w, tails[:1], tails[1:] * np.exp(x[len(used) + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weights = np.zeros(1 << bits, np.float32)
    weights[used] = x[:len(used)]
    return OrdinalModel([int(g) for g in levels], weights, x[len(used)] + np.concatenate([[0], np.cumsum(np.exp(x[len(used) + 1:]))]), bits)


def _first_rows(rated: DataFrame, rows: int, size: int) -> DataFrame:
    """The first rows in the order of the hash of their id, at most ``rows`` and together at most ``size`` bytes of slots.

    An id may repeat without end, so the bytes are summed over sizes alone, of the first ``rows`` rows that the tasks leave.
    """
    place = F.struct(F.xxhash64("id").alias("hash"), "id", "grade", F.sha2("slots", 256).alias("digest"))
    sizes = rated.select(place.alias("place"), F.length("slots").cast("long").alias("size")).orderBy("place").limit(rows)
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = sizes.select(F.sum("size").over(upto).alias("upto"), "place").filter(F.col("upto") <= size).agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("last")).first()
    if not cut["n"]:
        return rated.limit(0)
    last = F.struct(*[F.lit(v) for v in cut["last"]])
    return rated.filter(place <= last).orderBy(place).limit(cut["n"])


def fit_on_ratings(
    docs: DataFrame, ratings: DataFrame, grade: Column, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES
) -> OrdinalModel | None:
    """Fit on at most ``rows`` rated documents and ``size`` bytes of their slots; None if fewer than two grades are found.

    Ratings with a null id or grade are left out, a document rated twice counts twice, and so does a row that repeats
    another; repeats count towards the bounds.
    """
    rated = ratings.select(F.col(id_col).alias("_id"), grade.cast("int").alias("_grade")).dropna()
    sample = rated.orderBy(F.xxhash64("_id"), "_id", "_grade").limit(rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = []
            for piece in tb.pieces(batch.column("_text")):
                slots, bounds = features(piece, bits)
                blobs += [slots[a:b].astype(np.uint32).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_grade"), batch.column("_id").cast(pa.string()), pa.array(blobs, pa.binary())], names=["grade", "id", "slots"])

    rated_slots = stage(texts.join(F.broadcast(sample), "_id").mapInArrow(read, "grade int, id string, slots binary"), "rated")
    found = _first_rows(rated_slots, rows, size).toPandas()
    found = found.sort_values(["id", "grade", "slots"], kind="stable")
    if found["grade"].nunique() < 2:
        return None
    return fit_ordinal([np.frombuffer(b, np.uint32) for b in found["slots"]], found["grade"].to_numpy(), bits)


def grade_documents(docs: DataFrame, model: OrdinalModel | None, least: int, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """Add score, expected_grade, tail_probability (of a grade of ``least`` or more) and accepted (tail >= ``cut``).

    Null and empty texts are graded by the features that every text has. Without a model the figures are null and
    every document is accepted. Columns of these names are replaced, all others kept; equal texts are graded alike.
    """
    figures = ["score", "expected_grade", "tail_probability"]
    kept = [c for c in docs.columns if c not in (*figures, "accepted")]
    base = docs.select(*[F.col(f"`{c}`") for c in kept])
    if model is None:
        return base.select("*", *[F.lit(None).cast("double").alias(f) for f in figures], F.lit(True).alias("accepted"))
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = OrdinalModel(*shared.value)
        grades = np.array(m.grades, float)
        for batch in batches:
            parts = [m.scores(*features(piece, m.bits)) for piece in tb.pieces(batch.column(text_col))]
            scores = np.concatenate([np.zeros(0), *parts]).astype(np.float64)
            above = m.above(scores)
            expected = grades[0] + above @ np.diff(grades)
            at_least = [j for j in range(len(grades) - 1) if m.grades[j] < least]
            tail = above[:, at_least[-1]] if at_least else np.ones(len(scores))
            if least > m.grades[-1]:
                tail = np.zeros(len(scores))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), pa.array(expected), pa.array(tail)], names=[*kept, *figures])

    schema = T.StructType([*base.schema.fields, *[T.StructField(f, T.DoubleType()) for f in figures]])
    return base.mapInArrow(run, schema).withColumn("accepted", F.col("tail_probability") >= cut)


#: Grades of rated documents: one point for good text, one for the absence of toxic content.
def rating_grade() -> Column:
    return F.col("quality") + 1 - F.col("toxic")


BEST_GRADE = 2
