"""Multinomial logistic regression over counts of more words than the driver can hold many vectors of.

The model is that of Spark's ``LogisticRegression`` with an L2 penalty on standardised features, found by the same method
(L-BFGS with ten corrections). Rows are packed into blocks of sparse counts; each pass sends the weights out and brings the
loss and the gradient back, summed by slices of words in tasks. The driver holds a handful of vectors while it adds up; the
corrections, of which Spark keeps twenty in its heap, lie in a file.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import stage

CORRECTIONS = 10
#: Counts in a block, words in a slice of a sum, and tasks that each hold a whole sum.
BLOCK_COUNTS = 250_000
SLICE = 262_144
MOST_SUMS = 64
_BLOCKS = "label binary, length binary, place binary, n binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (label, pairs) -> blocks of labels, numbers of pairs, places and counts."""
    for batch in batches:
        lengths = pc.fill_null(pc.list_value_length(batch.column("pairs")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto = np.cumsum(lengths)
        cuts = np.searchsorted(upto, np.arange(BLOCK_COUNTS, int(upto[-1]) if len(upto) else 0, BLOCK_COUNTS))
        edges = np.unique(np.concatenate([[0], cuts, [len(lengths)]]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            some = batch.column("pairs").slice(a, b - a).flatten()
            parts = [batch.column("label").slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int32), lengths[a:b].astype(np.int32),
                     some.field("i").to_numpy(zero_copy_only=False).astype(np.int32), some.field("n").to_numpy(zero_copy_only=False).astype(np.float32)]
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["label", "length", "place", "n"])


def _counts(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Labels, first places of the rows, places and counts of all blocks of a batch."""
    kinds = {"label": np.int32, "length": np.int32, "place": np.int32, "n": np.float32}
    label, length, place, n = (np.concatenate([np.frombuffer(x.as_buffer(), k) for x in batch.column(c)]) for c, k in kinds.items())
    return label, length.astype(np.int64), place, n.astype(float)


def _per_row(values: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Sums of each row's stretch of the values."""
    upto = np.concatenate([[0.0], np.cumsum(values)])
    ends = np.cumsum(length)
    return upto[ends] - upto[ends - length]


def _sums(blocks: DataFrame, of, size: int) -> np.ndarray:
    """``size`` numbers that ``of(blocks of counts)`` gives for each batch, summed in tasks by slices."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                of(*_counts(batch), total)
        for at in range(0, size, SLICE):
            yield pa.RecordBatch.from_arrays([pa.array([at // SLICE], pa.int32()), pa.array([total[at:at + SLICE].tobytes()], pa.binary())], names=["slice", "sums"])

    def add(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), float) for x in table.column("sums")]
        return pa.table({"slice": table.column("slice").slice(0, 1), "sums": pa.array([sum(parts[1:], parts[0].copy()).tobytes()], pa.binary())})

    out = np.zeros(size)
    for row in blocks.mapInArrow(run, "slice int, sums binary").groupBy("slice").applyInArrow(add, "slice int, sums binary").collect():
        out[row["slice"] * SLICE:row["slice"] * SLICE + SLICE] = np.frombuffer(row["sums"], float)
    return out


def _between(a: tuple, b: tuple) -> float:
    """Where the cubic through two points (step, value, slope) is least, kept off their ends."""
    (a, fa, da), (b, fb, db) = sorted((a, b))[:2]
    d1 = da + db - 3 * (fa - fb) / (a - b)
    d2 = np.sqrt(max(0.0, d1 * d1 - da * db))
    t = b - (b - a) * (db + d2 - d1) / (db - da + 2 * d2) if db - da + 2 * d2 else (a + b) / 2
    return float(np.clip(t, a + 0.1 * (b - a), a + 0.9 * (b - a))) if np.isfinite(t) else (a + b) / 2


def _step(at, f: float, slope: float, t: float) -> float | None:
    """A step that meets the strong Wolfe conditions; ``at(t)`` gives value and slope there."""
    low, high = (0.0, f, slope), None
    for _ in range(20):
        now, down = at(t)
        if not np.isfinite(now):
            t /= 2
            continue
        if now > f + 1e-4 * t * slope or (low[0] or high) and now >= low[1]:
            high = (t, now, down)
        elif abs(down) <= 0.9 * abs(slope):
            return t
        else:
            if down * ((high[0] if high else np.inf) - low[0]) >= 0:
                high = low
            low = (t, now, down)
        t = _between(low, high) if high else 1.5 * t
    return None


def _on_file(*shape: int) -> np.ndarray:
    """An array of zeros in a temporary file, which takes no memory of the driver's own."""
    with tempfile.TemporaryFile() as file:
        return np.memmap(file, float, "w+", shape=shape)


def minimum(value, x: np.ndarray, steps: int, tol: float, first: float = 1.0) -> np.ndarray:
    """L-BFGS with a strong Wolfe search, from a step of length ``first`` on; ``value(x)`` gives the function and its gradient.

    The corrections, and what stays between two calls, lie in a file.
    """
    held = _on_file(2 * CORRECTIONS + 3, len(x))
    held[-3] = x
    x, g, d = held[-3:]
    kept, curved = [], {}
    f, g[:] = value(x)
    for _ in range(steps):
        np.negative(g, out=d)
        alphas = {}
        for i in reversed(kept):
            alphas[i] = float(held[2 * i] @ d) / curved[i]
            d -= alphas[i] * held[2 * i + 1]
        if kept:
            last = held[2 * kept[-1] + 1]
            d *= curved[kept[-1]] / float(last @ last)
        for i in kept:
            d += (alphas[i] - float(held[2 * i + 1] @ d) / curved[i]) * held[2 * i]
        slope, seen = float(g @ d), {}

        def at(t: float, d=d, seen=seen) -> tuple[float, float]:
            seen.clear()
            seen[t] = value(x + t * d)
            return seen[t][0], float(seen[t][1] @ d)

        t = _step(at, f, slope, 1.0 if kept else first / max(1e-12, float(np.sqrt(g @ g)))) if slope < 0 else None
        if t is None:
            break
        new_f, new_g = seen.pop(t)
        place = kept.pop(0) if len(kept) == CORRECTIONS else len(kept)
        d *= t
        x += d
        held[2 * place] = d
        np.subtract(new_g, g, out=held[2 * place + 1])
        g[:] = new_g
        curved[place] = float(d @ held[2 * place + 1])
        kept.append(place)
        done = abs(f - new_f) <= tol * max(1e-6, abs(new_f))
        f = new_f
        if done:
            break
    return x


class Classes:
    """Weights (class, word) on plain counts and an intercept for each class; with two classes the first's are the negated second's."""

    def __init__(self, weights: np.ndarray, intercepts: np.ndarray):
        self.weights, self.intercepts = weights, intercepts

    def predict(self, rows: DataFrame, out: str = "prediction") -> DataFrame:
        """The likeliest class of each row of ``pairs``, in place of them."""
        data, intercepts = rows.sparkSession.sparkContext.broadcast(self.weights), self.intercepts
        rest = [f for f in rows.schema.fields if f.name != "pairs"]

        def run(batches):
            for batch in batches:
                lengths = pc.fill_null(pc.list_value_length(batch.column("pairs")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = batch.column("pairs").flatten()
                place, n = flat.field("i").to_numpy(zero_copy_only=False), flat.field("n").to_numpy(zero_copy_only=False)
                margins = np.stack([_per_row(w[place] * n, lengths) for w in data.value], axis=1)
                best = (_both(margins) + intercepts).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in rest], pa.array(best, pa.int32())], names=[*[f.name for f in rest], out])

        return rows.mapInArrow(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rest], f"{out} int"]))


def _both(margins: np.ndarray) -> np.ndarray:
    return np.hstack([-margins, margins]) if margins.shape[1] == 1 else margins


def fit_classes(rows: DataFrame, words: int, penalty: float, steps: int, tol: float = 1e-6) -> Classes:
    """Fit on rows (label, pairs): whole labels from 0 on, and the numbers n of the words at the places i below ``words``."""
    spark = rows.sparkSession
    per = {int(r["label"]): r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per or min(per) < 0:
        raise ValueError("labels must be there, and 0 or more")
    n, k = sum(per.values()), max(per) + 1
    prior = np.log1p(np.array([per.get(c, 0) for c in range(k)], float))
    if len(per) == 1:
        return Classes(np.zeros((max(1, k), words)), np.where(np.arange(k) == k - 1, 0.0, -np.inf))
    tracked = 1 if k == 2 else k
    blocks = stage(rows.select("label", "pairs").mapInArrow(_packed, _BLOCKS), "counts")
    blocks = blocks.coalesce(min(MOST_SUMS, spark.sparkContext.defaultParallelism))

    def moments(label, length, place, count, total):
        total[:words] += np.bincount(place, count, words)
        total[words:2 * words] += np.bincount(place, count * count, words)
        total[2 * words:] += np.bincount(place, count > 0, words)

    sums = _sums(blocks, moments, 3 * words)
    mean, scale = _on_file(2, words)
    mean[:] = sums[:words] / n
    deviation = np.sqrt(np.maximum(sums[words:2 * words] - n * mean * mean, 0) / max(1, n - 1))
    # A word of every document has no weight by its inverse frequency.
    scale[:] = np.where((deviation > 0) & (sums[2 * words:] < n), 1 / np.where(deviation > 0, deviation, 1), 0)
    mean *= scale
    del sums, deviation

    def value(x: np.ndarray) -> tuple[float, np.ndarray]:
        w = x[:tracked * words].reshape(tracked, words)
        data = spark.sparkContext.broadcast(np.asarray(w * scale))
        moved = np.asarray(x[tracked * words:] - w @ mean)

        def gradient(label, length, place, count, total):
            margins = _both(np.stack([_per_row(v[place] * count, length) for v in data.value], axis=1) + moved)
            margins -= margins.max(axis=1, keepdims=True)
            odds = np.exp(margins)
            whole = odds.sum(axis=1)
            at = np.arange(len(label))
            total[-1] += (np.log(whole) - margins[at, label]).sum()
            off = odds / whole[:, None]
            off[at, label] -= 1
            off = off[:, -tracked:]
            for c in range(tracked):
                total[c * words:(c + 1) * words] += np.bincount(place, count * np.repeat(off[:, c], length), words)
            total[tracked * words:-1] += off.sum(axis=0)

        # With two classes both rows of weights change together: the loss's slope and the penalty count for each.
        found = _sums(blocks, gradient, tracked * words + tracked + 1)
        data.destroy()
        times = 2 if tracked == 1 else 1
        found /= n
        slopes = found[:-1]
        steep = slopes[:tracked * words].reshape(tracked, words)
        steep *= scale
        for c in range(tracked):
            steep[c] -= slopes[tracked * words + c] * mean
            steep[c] += penalty * w[c]
        slopes *= times
        return float(found[-1] + times * penalty / 2 * sum(v @ v for v in w)), slopes

    start = np.concatenate([np.zeros(tracked * words), (prior - prior.mean())[-tracked:]])
    # Steps begin as they would on the weights of both classes.
    x = minimum(value, start, steps, tol, np.sqrt(0.5) if tracked == 1 else 1.0)
    w = np.asarray(x[:tracked * words].reshape(tracked, words) * scale)
    moved = x[tracked * words:] - x[:tracked * words].reshape(tracked, words) @ mean
    return Classes(w, _both(moved[None, :])[0])
