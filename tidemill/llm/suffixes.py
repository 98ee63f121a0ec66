"""Removal of byte strings that repeat across a corpus, by suffix arrays of shards.

A window is a string of ``WINDOW`` bytes inside one text. It is filed under its anchor, the gram of ``GRAM`` bytes
with the lowest hash in it, so equal windows have equal anchors; the windows of one anchor are neighbours and form
a run. Runs with the same anchor and the same bytes are copies of each other: all but the earliest go. What is left
to compare are different runs of one anchor, of which only the earliest copy counts. Their bytes are cut out and
dealt to shards by anchor, and each shard builds the suffix array of its bytes by Larsson-Sadakane refinement and
the common prefixes by Kasai's walk. Windows next to each other with a common prefix of ``WINDOW`` bytes are equal.

An anchor with more than ``SHARD_RUNS`` different runs would outgrow its shard. Its runs are taken apart into single
windows, which meet by their own digest in a second pass over the same merge; that replaces a binary search of every
shard in every other, whose cost would grow with the square of the number of shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import textbytes as tb
from tidemill.session import stage

WINDOW = 100
GRAM = 24
#: Different runs of one anchor that one shard takes, and bytes that it handles at once.
SHARD_RUNS = 4096
SHARD_BYTES = 1 << 20
#: Sides of at most so many bytes, with ROW_BYTES for each row, are broadcast; larger ones are joined by a shuffle.
SMALL_BYTES, ROW_BYTES = 64 << 20, 48
#: A wanted run as the tables hold it: anchor, first window, number of windows (negative if its anchor is crowded).
WANTED = np.dtype([("anchor", "<i8"), ("first", "<i4"), ("n", "<i4")])
SPAN = np.dtype([("first", "<i4"), ("past", "<i4")])

_CODE = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, tb.PIECE_BYTES + 1)
        for name, base in (("up", _P), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` (24) bytes from each place on."""
    at = {1: _CODE[data]}
    for n in (1, 2, 4, 8):
        at[2 * n] = at[n][:-n] + at[n][n:] * np.uint64(pow(_P, n, 1 << 64))
    whole = at[16][:-8] + at[8][16:] * np.uint64(pow(_P, 16, 1 << 64))
    return tb.mix(whole)


def runs_of(piece: tb.Piece) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text, first window, number of windows, anchor's hash, hash of the bytes."""
    data, n = piece.data, len(piece.data)
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64))
    if n < WINDOW:
        return none
    grams = gram_hashes(data)
    places = np.arange(len(grams), dtype=np.uint64)
    low = (grams & ~np.uint64((1 << 22) - 1)) | (places & np.uint64((1 << 22) - 1))  # equal hashes: the first place
    size, left = 1, WINDOW - GRAM + 1
    while 2 * size <= left:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if left > size:
        low = np.minimum(low[:size - left], low[left - size:])
    starts = np.arange(n - WINDOW + 1)
    anchor = starts + ((low.astype(np.int64) - starts) & ((1 << 22) - 1))
    text = np.searchsorted(piece.offsets, starts, "right") - 1
    good = starts + WINDOW <= piece.offsets[text + 1]
    starts, anchor, text = starts[good], anchor[good], text[good]
    if not len(starts):
        return none
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    count = np.diff(np.concatenate([first, [len(starts)]]))
    begin, past = starts[first], starts[first] + count + WINDOW - 1
    up, down = _powers(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_CODE[data] * up[:n], dtype=np.uint64)])
    body = tb.mix((sums[past] - sums[begin]) * down[begin] + tb.mix(((anchor[first] - begin) << 20 | count).astype(np.uint64)))
    return text[first], begin - piece.offsets[text[first]], count, grams[anchor[first]].view(np.int64), body.view(np.int64)


RUNS = "kind int, anchor long, body long, doc long, first int, n int"


def _batch(kind: int, anchor, body, doc, first, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "kind": np.full(len(doc), kind, np.int32), "anchor": anchor.astype(np.int64), "body": body.astype(np.int64), "doc": doc.astype(np.int64), "first": first.astype(np.int32), "n": n.astype(np.int32),
    })


def _emit_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of every text, a text that the task has met under a smaller id left out (whole copies are handled apart)."""
    seen: dict[bytes, int] = {}
    for batch in batches:
        ids = batch.column("_id").to_numpy()
        for piece in tb.pieces(batch.column("_text")):
            fresh = np.zeros(len(piece), bool)
            for i in range(len(piece)):
                doc, digest = int(ids[piece.first + i]), hashlib.md5(piece.text(i), usedforsecurity=False).digest()
                if doc < seen.get(digest, doc + 1):
                    seen[digest] = doc
                    fresh[i] = True
            text, first, n, anchor, body = runs_of(piece)
            keep = fresh[text] if len(text) else np.zeros(0, bool)
            yield _batch(0, anchor[keep], body[keep], ids[piece.first + text[keep]], first[keep], n[keep])


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, body, doc and first: copies of an earlier run as kind 1, and the earliest copy of each
    run as kind 2 where the anchor has several different ones. What is held is one row."""
    last = None  # the last row
    held, several = None, False  # first run of the last anchor, and whether it has more
    for batch in batches:
        rows = [batch.column(c).to_numpy() for c in ("anchor", "body", "doc", "first", "n")]
        anchor, body, doc, first, n = rows
        if not len(doc):
            continue
        before = [np.concatenate([[x[0] if last is None else last[i]], x[:-1]]) for i, x in enumerate(rows[:4])]
        start = np.zeros(len(doc), bool)
        start[0] = last is None
        same_anchor = (anchor == before[0]) & ~start
        copy = same_anchor & (body == before[1])
        again = copy & ((doc != before[2]) | (first != before[3]))
        yield _batch(1, anchor[again], body[again], doc[again], first[again], n[again])
        heads = np.flatnonzero(~copy)
        parts = [x[heads] for x in rows]
        goes_on = len(heads) > 0 and bool(same_anchor[heads[0]])
        if held is not None and goes_on:
            parts = [np.concatenate([[h], p]) for h, p in zip(held, parts, strict=True)]
        if len(parts[0]):
            begins = np.flatnonzero(np.concatenate([[True], parts[0][1:] != parts[0][:-1]]))
            sizes = np.diff(np.concatenate([begins, [len(parts[0])]]))
            many = sizes > 1
            many[0] |= goes_on and several
            out = np.repeat(many, sizes)
            if out.any():
                yield _batch(2, *[p[out] for p in parts])
            several = bool(many[-1])
            held = None if several else tuple(p[-1] for p in parts)
        last = tuple(x[-1] for x in rows[:4])


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` bytes at least, and the place of each: Larsson-Sadakane refinement.

    Suffixes are sorted by eight bytes; then only groups of equal ones are sorted again by the rank of the suffix
    that lies as many bytes on as are already compared, which doubles them.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i:n + i].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    del key, ordered
    numbers = np.int32 if n < 1 << 31 else np.int64
    order = order.astype(numbers)
    rank = np.empty(n, numbers)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n, dtype=numbers), 0))  # a group's rank is its first place
    h = 8
    while h < depth:
        single = fresh & np.concatenate([fresh[1:], [True]])
        places = np.flatnonzero(~single)
        if not len(places):
            break
        members = order[places]
        group, then = rank[members], np.where(members + h < n, rank[np.minimum(members + h, n - 1)], -1)
        by = np.lexsort((then, group))
        members, group, then = members[by], group[by], then[by]
        order[places] = members
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (then[1:] != then[:-1])])
        fresh[places] = new
        rank[members] = np.maximum.accumulate(np.where(new, places, 0))
        h *= 2
    place = np.empty(n, numbers)
    place[order] = np.arange(n, dtype=numbers)
    return order, place


def common_prefixes(text: np.ndarray, order: np.ndarray, place: np.ndarray, starts: np.ndarray, lengths: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, up to ``most`` bytes, by Kasai's walk.

    A prefix shrinks by at most one byte from a suffix to the next, so each walk along a string compares only
    what is new; the strings of the shard (``starts``, ``lengths``) are walked side by side. That holds as long as
    what follows the two suffixes has their order. Ties of ``order`` stand in order of position, so it may not, and
    then the walk compares from the first byte on.
    """
    out = np.zeros(len(text), np.int16)
    padded = np.concatenate([text.astype(np.int16), np.full(most + 1, -1, np.int16)])
    by_length = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[by_length], lengths[by_length]
    have, last = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)  # prefix and neighbour one step ago
    for step in range(int(lengths.max(initial=0))):
        live = int(np.searchsorted(-lengths, -step, "left"))
        here = starts[:live] + step
        at = place[here]
        other = order[np.maximum(at - 1, 0)]
        ordered = place[np.minimum(last[:live] + 1, len(text) - 1)] < at
        h = np.where((at > 0) & ordered, np.maximum(have[:live] - 1, 0), 0)
        going = np.flatnonzero(at > 0)
        while len(going):
            going = going[h[going] < most]
            going = going[padded[here[going] + h[going]] == padded[other[going] + h[going]]]
            h[going] += 1
        have[:live], last[:live] = h, other
        out[at] = h
    return out


def repeated_windows(slices: list[bytes], docs: np.ndarray, firsts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of the slices (doc, place of the window in it) have an equal one earlier among them."""
    text = np.frombuffer(b"".join(slices), np.uint8)
    lengths = np.array([len(s) for s in slices])
    starts = np.cumsum(lengths) - lengths
    order, place = suffix_array(text, WINDOW)
    shared = common_prefixes(text, order, place, starts, lengths, WINDOW)
    group = np.cumsum(shared < WINDOW, dtype=order.dtype)
    owner = np.repeat(np.arange(len(slices)), counts)
    step = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    of = group[place[starts[owner] + step]]
    doc, window = docs[owner], firsts[owner] + step
    by = np.lexsort((window, doc, of))
    later = np.concatenate([[False], of[by][1:] == of[by][:-1]])
    # An equal window at the same place of the same document is the same one.
    head = np.flatnonzero(~later)
    lead = by[np.repeat(head, np.diff(np.concatenate([head, [len(by)]])))]
    later &= (doc[by] != doc[lead]) | (window[by] != window[lead])
    return doc[by][later], window[by][later]


SPANS = "doc long, first int, past int"


def _intervals(doc: np.ndarray, window: np.ndarray) -> pa.RecordBatch:
    by = np.lexsort((window, doc))
    doc, window = doc[by], window[by]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (window[1:] > window[:-1] + WINDOW)]) if len(doc) else np.zeros(0, bool)
    begins = np.flatnonzero(new)
    ends = np.concatenate([begins[1:], [len(doc)]])[:len(begins)] - 1
    return pa.RecordBatch.from_pydict({"doc": doc[begins], "first": window[begins].astype(np.int32), "past": (window[ends] + WINDOW).astype(np.int32)})


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices sorted by anchor -> intervals of repeated windows; whole anchors are put together up to a size."""
    held: list[tuple] = []
    size, last = 0, None

    def close() -> pa.RecordBatch:
        docs, firsts, counts = (np.array([h[i] for h in held], np.int64) for i in range(3))
        return _intervals(*repeated_windows([h[3] for h in held], docs, firsts, counts))

    for batch in batches:
        for anchor, *row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "doc", "first", "n", "bytes")], strict=True):
            if anchor != last and size >= SHARD_BYTES:
                yield close()
                held, size = [], 0
            last = anchor
            held.append(tuple(row))
            size += len(row[3])
    if held:
        yield close()


def _cut_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their wanted runs -> the bytes of these."""
    for batch in batches:
        for doc, text, packed in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            raw, wanted = text.encode(), np.frombuffer(packed, WANTED)
            first, n = wanted["first"], np.abs(wanted["n"])
            yield pa.RecordBatch.from_pydict({
                "anchor": pa.array(wanted["anchor"]), "crowded": pa.array(wanted["n"] < 0), "doc": pa.array(np.full(len(wanted), doc, np.int64)), "first": pa.array(first), "n": pa.array(n),
                "bytes": pa.array([raw[a:a + w + WINDOW - 1] for a, w in zip(first.tolist(), n.tolist(), strict=True)], pa.binary()),
            })


def _packed(columns: list[str], kind: np.dtype, signed: str | None = None):
    """Rows of doc and a list of structs -> doc and the list as one binary; ``signed`` names a flag that negates n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("l")
            flat = lists.flatten()
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            out = np.empty(len(flat), kind)
            for c in columns:
                out[c] = flat.field(c).to_numpy(zero_copy_only=False)
            if signed:
                out["n"] *= np.where(flat.field(signed).to_numpy(zero_copy_only=False), -1, 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array([p.tobytes() for p in np.split(out, ends[:-1])] if len(lists) else [], pa.binary())], names=["doc", "packed"])

    return run


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices -> one run for each window, filed under the two halves of its digest."""
    for batch in batches:
        for doc, first, n, raw in zip(*[batch.column(c).to_pylist() for c in ("doc", "first", "n", "bytes")], strict=True):
            keys = np.frombuffer(b"".join(hashlib.md5(raw[i:i + WINDOW], usedforsecurity=False).digest() for i in range(n)), np.int64).reshape(-1, 2)
            yield _batch(0, keys[:, 0], keys[:, 1], np.full(n, doc), first + np.arange(n), np.ones(n))


def _small(df: DataFrame, packed: str) -> DataFrame:
    """Broadcast ``df`` (doc and a packed list) if it has few bytes."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(packed)), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if size["n"] * ROW_BYTES + size["b"] <= SMALL_BYTES else df


def _merged(runs: DataFrame, partitions: int) -> DataFrame:
    return runs.repartition(partitions, "anchor").sortWithinPartitions("anchor", "body", "doc", "first").mapInArrow(_merge_runs, RUNS)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Intervals of bytes (doc, first, past) that repeated windows cover; they may touch or overlap."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shaped = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    sizes = shaped.select("_id", F.octet_length("_text").alias("size"), F.md5(F.col("_text").cast("binary")).alias("digest")).filter(F.col("size") >= WINDOW)
    sizes = stage(sizes, "sizes")
    firsts = sizes.groupBy("digest").agg(F.min("_id").alias("least"), F.max("_id").alias("most")).filter("least < most").select("digest", "least")
    copies = sizes.join(firsts, "digest").filter(F.col("_id") > F.col("least")).select(F.col("_id").alias("doc"), F.lit(0).alias("first"), F.col("size").cast("int").alias("past"))

    merged = stage(_merged(shaped.mapInArrow(_emit_runs, RUNS), partitions), "runs")
    span = lambda kind: F.struct("first", (F.col("first") + F.col("n") + WINDOW - 1).alias("past"))
    whole = merged.filter("kind = 1").select("doc", span(1).alias("s")).select("doc", "s.first", "s.past")
    heads = merged.filter("kind = 2")
    counted = heads.join(heads.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")), "anchor")
    listed = counted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "first", "n", (F.col("m") > SHARD_RUNS).alias("crowded"))).alias("l"))
    wanted = stage(listed.mapInArrow(_packed(["anchor", "first", "n"], WANTED, "crowded"), "doc long, packed binary"), "wanted").withColumnRenamed("packed", "wanted")
    # An id stands for one text: of rows that repeat it, one is cut.
    texts = shaped.join(_small(wanted, "wanted"), F.col("_id") == F.col("doc")).select("_id", "_text", "wanted")
    slices = stage(texts.mapInArrow(_cut_slices, "anchor long, crowded boolean, doc long, first int, n int, bytes binary"), "slices")
    narrow = slices.filter("NOT crowded").select("anchor", "doc", "first", "n", "bytes").repartition(partitions, "anchor").sortWithinPartitions("anchor")
    found = stage(narrow.mapInArrow(_shards, SPANS), "repeats")
    single = slices.filter("crowded").select("doc", "first", "n", "bytes").mapInArrow(_single_windows, RUNS)
    hot = _merged(single, partitions).filter("kind = 1").select("doc", "first", (F.col("first") + WINDOW).alias("past"))
    return copies.unionAll(whole).unionAll(found.select("doc", "first", "past")).unionAll(stage(hot, "hot_repeats"))


def _join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by doc and first -> disjoint spans, those that touch put together."""
    rest = None
    for batch in batches:
        docs, firsts, pasts = (batch.column(c).to_numpy().astype(np.int64) for c in ("doc", "first", "past"))
        if rest is not None:
            docs, firsts, pasts = (np.concatenate([[r], x]) for r, x in zip(rest, (docs, firsts, pasts), strict=True))
        if not len(docs):
            continue
        number = np.cumsum(np.concatenate([[0], docs[1:] != docs[:-1]]))
        lift = int(pasts.max()) + 2
        reach = np.maximum.accumulate(pasts + number * lift) - number * lift
        new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (firsts[1:] > reach[:-1])])
        begins = np.flatnonzero(new)
        ends = np.concatenate([begins[1:], [len(docs)]]) - 1
        out = docs[begins], firsts[begins], reach[ends]
        rest = tuple(int(x[-1]) for x in out)
        yield pa.RecordBatch.from_pydict({"doc": out[0][:-1], "first": out[1][:-1].astype(np.int32), "past": out[2][:-1].astype(np.int32)})
    if rest is not None:
        yield pa.RecordBatch.from_pydict({"doc": pa.array([rest[0]], pa.int64()), "first": pa.array([rest[1]], pa.int32()), "past": pa.array([rest[2]], pa.int32())})


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes) after removing every byte
    that a string of 100 bytes covers which also starts earlier (smaller id, or earlier in the same text).

    Texts are UTF-8 bytes and null counts as empty; matches do not cross texts. An id stands for one text, so rows
    that repeat an id with its text are one document and are treated alike. Rows with a null id stay whole and
    are not compared. Texts under 100 bytes stay whole; an empty table gives none. Other columns are not looked at.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = repeated_spans(docs, id_col, text_col)
    joined = spans.repartition(partitions, "doc").sortWithinPartitions("doc", "first", "past").mapInArrow(_join_spans, SPANS)
    listed = joined.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("first", "past"))).alias("l"))
    of_doc = stage(listed.mapInArrow(_packed(["first", "past"], SPAN), "doc long, packed binary"), "spans").withColumnRenamed("packed", "spans")
    shaped = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    both = shaped.join(_small(of_doc, "spans"), F.col("_id") == F.col("doc"), "left").select("_id", "_text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, counts, digests, kept = [], [], [], [], []
            for text, gone in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw, at, parts = (text or "").encode(), 0, []
                spans = np.frombuffer(gone or b"", SPAN).tolist()
                for first, past in spans:
                    parts.append(raw[at:first])
                    at = past
                left = b"".join([*parts, raw[at:]])
                sizes.append(len(raw))
                removed.append(len(raw) - len(left))
                counts.append(len(spans))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
                names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return both.mapInArrow(cut, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
