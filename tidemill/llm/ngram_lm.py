"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

Documents are put together to chunks. A chunk's distinct words and pairs of words are sent, with their counts in its
training documents, in slices of the hash range, so a shuffled row holds many of them. A slice adds up the counts and
stores a count c as its level 1 + floor(log_b c): its filter gets the n-gram once for each level up to its own, and
reading probes one level after the other until one is missing. A filter is sized from the number of its entries
alone and holds every n-gram at every level. The slice then reads the n-grams of each chunk and sends the levels back.
So a task holds one slice or one chunk at a time, and the driver holds sums.

P(w | v) = (c(v, w) + MU * P(w)) / (c(v) + MU), with P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)), c from the filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import textbytes as tb
from tidemill.session import stage

BASE = 1.5
PROBES = 4
BITS_PER_ENTRY = 12
MU = 200.0
#: Tokens from which a chunk of documents is closed.
CHUNK_TOKENS = 1 << 19
#: N-grams of a slice that are added up or looked up at once.
HELD = 1 << 22
END = np.uint64(0x5851F42D4C957F2D)

_POWERS = BASE ** np.arange(0, 110)


def planes(values: np.ndarray) -> bytes:
    """Sorted or small numbers byte by byte, all first bytes ahead of all second ones, which compresses better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def from_planes(raw: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(_POWERS, counts, "right")


def _mean_counts() -> np.ndarray:
    """The count that a level stands for: the middle of the whole numbers that have it."""
    low, high = np.ceil(_POWERS[:-1]), np.ceil(_POWERS[1:]) - 1
    return np.concatenate([[0.0], (low + np.maximum(low, high)) / 2])


MEAN = _mean_counts()


def tokens_of(piece: tb.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text with an end behind them, and the first token of each text."""
    words, bounds = tb.lower_words(piece, tb.SPACED)
    tokens = np.insert(words, bounds[1:], END)
    return tokens, bounds + np.arange(len(bounds))


def pairs_of(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; before the first of a text stands an end."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = END
    return tb.mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _spans(keys: np.ndarray, slice_bits: int) -> list[tuple[int, int, int]]:
    """Slice, begin and end of the sorted keys of each slice that has some."""
    cuts = np.searchsorted(keys, np.arange(1 << slice_bits, dtype=np.uint64) << np.uint64(64 - slice_bits)).tolist()
    return [(s, a, b) for s, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(keys)], strict=True)) if b > a]


@dataclass
class Filter:
    """Bits of a log-frequency Bloom filter, cut into slices by the leading bits of the hash; some slices or all."""

    bits: np.ndarray
    slice_bits: int
    bits_per_slice: int  # a power of two
    first: int = 0  # number of the first slice held

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Stored level of each key, 0 if none; never too low, and too high at the rate of false positives."""
        found = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        level = 1
        while len(left):
            for n in range(PROBES):
                at = places(keys[left], level, n, self.slice_bits, self.bits_per_slice) - np.uint64(self.first * self.bits_per_slice)
                left = left[(self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            found[left] = level
            level += 1
        return found


def places(keys: np.ndarray, level: int, probe: int, slice_bits: int, bits_per_slice: int) -> np.ndarray:
    one, two = tb.mix(keys + np.uint64(level * 0x632BE59BD9B4E019 & (1 << 64) - 1)), keys | np.uint64(1)
    inside = (one + np.uint64(probe) * (one >> np.uint64(32) ^ two)) & np.uint64(bits_per_slice - 1)
    return (keys >> np.uint64(64 - slice_bits)) * np.uint64(bits_per_slice) + inside


def _size(entries: int) -> int:
    """Bits for so many entries; nothing else counts."""
    return 1 << (max(64, entries * BITS_PER_ENTRY) - 1).bit_length()


def _filled(keys: np.ndarray, counts: np.ndarray, slice_bits: int, bits_per_slice: int) -> np.ndarray:
    """The filter of one slice."""
    levels = level_of(counts)
    bits = np.zeros(bits_per_slice, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        keys, levels = keys[levels >= level], levels[levels >= level]
        for n in range(PROBES):
            bits[(places(keys, level, n, slice_bits, bits_per_slice) & np.uint64(bits_per_slice - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


SUMMED = "kind int, slice int, hashes binary, counts binary, total long, levels array<long>"


def _build(summed: DataFrame, kind: int, slice_bits: int, max_bits: int) -> Filter:
    """The filter of one kind as a whole, to look into a table of sums; one of more than ``max_bits`` bits is refused."""
    rows = summed.filter(F.col("kind") == kind).select("slice", "hashes", "counts").collect()
    sums = {r["slice"]: (np.frombuffer(r["hashes"], np.uint64), np.frombuffer(r["counts"], np.int64)) for r in rows}
    per_slice = max((_size(int(level_of(counts).sum())) for _, counts in sums.values()), default=64)
    if per_slice << slice_bits > max_bits:
        raise ValueError(f"the filter has {per_slice << slice_bits} bits")
    bits = np.zeros(per_slice << slice_bits >> 3, np.uint8)
    for part, (keys, counts) in sums.items():
        bits[part * per_slice >> 3:(part + 1) * per_slice >> 3] = _filled(keys, counts, slice_bits, per_slice)
    return Filter(bits, slice_bits, per_slice)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents -> rows of many: ids, marks, numbers of tokens, distinct words, and which of these each token is."""
    held: list[tuple] = []
    size = 0

    def close() -> pa.RecordBatch:
        ids, marks = (pa.concat_arrays([h[i] for h in held]) for i in (0, 1))
        words, which = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
        lengths = np.concatenate([np.diff(h[3]) for h in held])
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, marks)]
        binary = [pa.array([x], pa.binary()) for x in (planes(lengths.astype(np.int64)), planes(words), planes(which.astype(np.int32)))]
        return pa.RecordBatch.from_arrays([*lists, *binary], names=["ids", "marks", "lengths", "words", "which"])

    for batch in batches:
        for piece in tb.pieces(batch.column("_text")):
            ids, marks = (batch.column(c).slice(piece.first, len(piece)) for c in ("_id", "held_out"))
            tokens, bounds = tokens_of(piece)
            held.append((ids, marks, tokens, bounds))
            size += len(tokens)
            if size >= CHUNK_TOKENS:
                yield close()
                held, size = [], 0
    if held:
        yield close()


def _tokens_of_chunk(lengths: bytes, words: bytes, which: bytes) -> tuple[np.ndarray, ...]:
    """Distinct words, which of these each token is, the first token of each text, distinct pairs and which each is."""
    bounds = np.concatenate([[0], np.cumsum(from_planes(lengths, np.int64))])
    names, at = from_planes(words, np.uint64), from_planes(which, np.int32)
    pairs, pair_at = np.unique(pairs_of(names[at], bounds), return_inverse=True)
    return names, at, bounds, pairs, pair_at


ASKED = "kind int, slice int, chunk long, hashes binary, counts binary"


def _requests(slice_bits: int):
    """Chunks -> their distinct words and pairs by slice, with counts in the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (chunk, *row) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("chunk", "lengths", "words", "which")], strict=True)):
                words, at, bounds, pairs, pair_at = _tokens_of_chunk(*row)
                train = np.repeat(~batch.column("marks")[i].values.to_numpy(zero_copy_only=False), np.diff(bounds))
                for kind, keys, place in ((1, words, at), (2, pairs, pair_at)):
                    counts, spans = np.bincount(place[train], minlength=len(keys)).astype(np.uint32), _spans(keys, slice_bits)
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array([kind] * len(spans), pa.int32()), "slice": pa.array([s for s, _, _ in spans], pa.int32()), "chunk": pa.array([chunk] * len(spans), pa.int64()),
                        "hashes": pa.array([planes(keys[a:b]) for _, a, b in spans], pa.binary()), "counts": pa.array([planes(counts[a:b]) for _, a, b in spans], pa.binary()),
                    })

    return run


ANSWERS = "chunk long, kind int, slice int, levels binary, counts binary, total long, n long"


def _answer(slice_bits: int):
    """Rows sorted by kind and slice -> levels for each chunk, exact counts of words, and one row (chunk -1) for each
    slice with the sum and the number of its n-grams met in training."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        names = ("chunk", "kind", "slice", "levels", "counts", "total", "n")
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    def close(kind: int, part: int, asked: list[tuple]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        for _, hashes, counts in asked:
            keys, numbers = from_planes(hashes, np.uint64), from_planes(counts, np.uint32).astype(np.int64)
            parts.append((keys[numbers > 0], numbers[numbers > 0]))
            if len(parts) > 1 and sum(len(k) for k, _ in parts) > HELD:
                parts = [_merged(parts)]
        keys, exact = _merged(parts)
        size = _size(int(level_of(exact).sum()))
        stored = Filter(_filled(keys, exact, slice_bits, size), slice_bits, size, part)
        yield batch_of([(-1, kind, part, None, None, int(exact.sum()), len(keys))])
        group: list[tuple] = []
        for i, (chunk, hashes, _) in enumerate(asked):
            group.append((chunk, from_planes(hashes, np.uint64)))
            if i + 1 < len(asked) and sum(len(k) for _, k in group) < HELD >> 4:
                continue
            wanted = np.concatenate([k for _, k in group])
            cuts = np.cumsum([len(k) for _, k in group])[:-1]
            levels = np.split(stored.levels(wanted).astype(np.uint8), cuts)
            numbers = [None] * len(group)
            if kind == 1:
                at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
                found = np.where(keys[at] == wanted, exact[at], 0) if len(keys) else np.zeros(len(wanted), np.int64)
                numbers = [planes(x) for x in np.split(found, cuts)]
            yield batch_of([(chunk, kind, part, x.tobytes(), n, None, None) for (chunk, _), x, n in zip(group, levels, numbers, strict=True)])
            group = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked = None, []
        for batch in batches:
            for kind, part, *row in zip(*[batch.column(c).to_pylist() for c in ("kind", "slice", "chunk", "hashes", "counts")], strict=True):
                if now != (kind, part):
                    if asked:
                        yield from close(*now, asked)
                    now, asked = (kind, part), []
                asked.append(tuple(row))
        if asked:
            yield from close(*now, asked)

    return run


def _score(unit: float):
    """Rows sorted by chunk, kind and slice: each chunk (kind 0) and its answers -> scores of its documents."""

    def scores(ids: pa.Array, marks: pa.Array, row: tuple, levels: dict[int, list], counts: list) -> pa.RecordBatch:
        words, at, bounds, pairs, pair_at = _tokens_of_chunk(*row)
        by_word, by_pair = (MEAN[np.frombuffer(b"".join(levels[kind]), np.uint8)] for kind in (1, 2))
        exact = np.concatenate([from_planes(c, np.int64) for c in counts])
        if not len(by_word) == len(exact) == len(words) or len(by_pair) != len(pairs):
            raise RuntimeError("a chunk lacks answers")
        each = by_word[at]
        before = np.empty_like(each)
        before[1:] = each[:-1]
        before[bounds[:-1]] = by_word[np.searchsorted(words, END)]
        logs = np.log10((np.minimum(by_pair[pair_at], before) + MU * (each + 0.5) / unit) / (before + MU))
        totals = [np.add.reduceat(x, bounds[:-1]) for x in ((exact > 0).astype(np.int64)[at], np.log10((exact + 0.5) / unit)[at], logs)]
        return pa.RecordBatch.from_arrays([ids, marks, *[pa.array(x) for x in (np.diff(bounds).astype(np.int64), *totals)]], names=["_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body, levels, counts = None, {}, []
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            for i, kind in enumerate(columns["kind"].to_pylist()):
                if kind == 0:
                    if body is not None:
                        yield scores(*body, levels, counts)
                    body = columns["ids"][i].values, columns["marks"][i].values, tuple(columns[c][i].as_py() for c in ("lengths", "words", "which"))
                    levels, counts = {1: [], 2: []}, []
                else:
                    levels[kind].append(columns["levels"][i].as_py())
                    if kind == 1:
                        counts.append(columns["counts"][i].as_py())
        if body is not None:
            yield scores(*body, levels, counts)

    return run


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", hot_words: int | None = None) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score; learnt from the rows not held out.

    base_score adds log10((c + 0.5) / (N + 0.5 (V + 1))) with exact counts c over the tokens, score the log10
    probabilities of the filter's model. Null texts are empty and an empty text is one end; a null ``held_out``
    counts as false; repeated rows are scored, and learnt from, each for itself. Without training rows all counts
    are 0. Other columns are not looked at. ``hot_words`` has no effect: all counts come from their slices.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slice_bits = max(6, (4 * partitions - 1).bit_length())
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    kind = docs.schema[id_col].dataType.simpleString()
    body = f"ids array<{kind}>, marks array<boolean>, lengths binary, words binary, which binary"
    chunks = stage(base.mapInArrow(_chunks, body).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    asked = chunks.select("chunk", "marks", "lengths", "words", "which").mapInArrow(_requests(slice_bits), ASKED)
    answers = stage(asked.repartition(partitions, "kind", "slice").sortWithinPartitions("kind", "slice").mapInArrow(_answer(slice_bits), ANSWERS), "answers")
    facts = answers.filter("chunk < 0 AND kind = 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v"), F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first()
    unit = facts["n"] + 0.5 * (facts["v"] + 1)
    both = chunks.withColumns({"kind": F.lit(0), "slice": F.lit(0)}).unionByName(answers.filter("chunk >= 0").drop("total", "n"), allowMissingColumns=True)
    dealt = both.repartition(partitions, "chunk").sortWithinPartitions("chunk", "kind", "slice")
    scored = dealt.mapInArrow(_score(unit), f"_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("_id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(facts["n"]).cast("long").alias("train_tokens"), "base_score", "score")
