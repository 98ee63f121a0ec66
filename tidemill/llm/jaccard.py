"""Near duplicates by an exact join in the metric space of Jaccard distances between sets of word n-grams.

Documents with the same set form one class, and classes are joined in regions.

1. First regions. Nearly all documents are at distance 1 of each other, so regions around sampled documents would
   each need a copy of nearly all others. The first pivots are therefore n-grams: with a fixed order of all
   n-grams, rare ones first, a class belongs to the regions of its first n - ceil(t n) + 1 n-grams. Two sets at
   similarity t or more always share one of them, so no link is lost. The order comes from counts of all n-grams
   in a fixed number of hash slots, so boilerplate comes last; it steers the work and never the result.
2. Small regions give their pairs, filtered by size, by position (a pair that first meets late in its sets has too
   few n-grams left to share) and by a lower bound of the distance from small count vectors, and the sets are
   compared.
3. Large regions are joined through pivots drawn from their classes. Distances to the pivots give links at once;
   classes fall to their nearest pivot's Voronoi cell, and into every other cell whose window they meet: with
   tau = 1 - t, a class x at distance d of its nearest pivot may have a partner in the cell of q only if
   d(x, q) <= d + 2 tau. Cells are joined in the same way again; a pair is looked at only while its classes
   are not connected, and only if its distances to every pivot differ by tau at most. Regions above a bound are
   cut into blocks that meet two by two, so that a task holds a bounded number of sets.

What is returned are connected components; every link between two components that the pivots leave open is tested.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import textbytes as tb
from tidemill.llm.components import components
from tidemill.operators.joins import bounded
from tidemill.session import stage

NGRAM = 5
NUMERATOR, DENOMINATOR = 75, 100
SLOT_BITS = 22
SLICES = 64
#: Regions of up to so many classes give pairs; larger ones are joined by pivots.
PAIRS_UPTO = 24
PIVOTS = 8
#: Classes in a block of a large region.
BLOCK = 2048
BUCKETS = 64
#: Pairs of 24 bytes at most that are broadcast to the sets; more are joined by a shuffle.
MOST_PAIRS = 1_000_000


def shingles(piece: tb.Piece, n: int = NGRAM) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its n-grams of words; of all its words, if fewer; none without words."""
    words, bounds = tb.lower_words(piece, tb.SPACED)
    grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        grams = tb.mix(grams + words[i:len(words) - n + 1 + i] + np.uint64(i + 1)) if len(grams) else grams
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            g = np.sort(grams[a:b - n + 1])
            out.append(g[np.concatenate([[True], g[1:] != g[:-1]])])
        elif b > a:
            h = np.zeros(1, np.uint64)
            for i in range(a, b):
                h = tb.mix(h + words[i] + np.uint64(i - a + 101))
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_key(grams: np.ndarray) -> int:
    """One number for a set."""
    total = tb.mix(grams).sum(dtype=np.uint64) + np.uint64(len(grams))
    return int(tb.mix(np.array([total]))[0].view(np.int64))


def similar(common, size_a, size_b):
    return DENOMINATOR * common >= NUMERATOR * (size_a + size_b - common)


def prefix_length(size: int) -> int:
    """A partner shares at least ceil(t size) n-grams, so one of the first this many."""
    return size - -(-NUMERATOR * size // DENOMINATOR) + 1


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the class of each document, and at the end the slot counts of the task, in slices."""
    counts = np.zeros(1 << SLOT_BITS, np.uint32)
    seen: set[int] = set()
    for batch in batches:
        keys, sizes = [], []
        for piece in tb.pieces(batch.column("_text")):
            fresh = []
            for grams in shingles(piece):
                key = class_key(grams) if len(grams) else None
                keys.append(key)
                sizes.append(len(grams))
                if key is not None and key not in seen:
                    seen.add(key)
                    fresh.append(grams)
            if fresh:
                counts += np.bincount((np.concatenate(fresh) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=1 << SLOT_BITS).astype(np.uint32)
        n = len(keys)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=["_id", "key", "n", "slice", "counts"]
        )
    if seen:
        few = np.minimum(counts, 255).astype(np.uint8).reshape(SLICES, -1)
        id_type = batch.column("_id").type
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(SLICES, id_type), pa.nulls(SLICES, pa.int64()), pa.nulls(SLICES, pa.int64()), pa.array(range(SLICES), pa.int32()), pa.array([r.tobytes() for r in few], pa.binary())],
            names=["_id", "key", "n", "slice", "counts"],
        )


def _rank_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the slot counts (a task's count stops at 255), as ranks of one byte on a log scale."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            found = np.frombuffer(counts, np.uint8).astype(np.uint64)
            sums[part] = sums[part] + found if part in sums else found
    for part, total in sums.items():
        rank = np.minimum(255, np.round(12 * np.log2(total + 1.0))).astype(np.uint8)
        yield pa.RecordBatch.from_pydict({"slice": pa.array([part], pa.int32()), "ranks": pa.array([rank.tobytes()], pa.binary())})


def _prefixes(ranks):
    """Documents -> n-grams that a class is filed under: gram, key, size, and whole hundredths of the set before the n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        order = ranks.value
        for batch in batches:
            for piece in tb.pieces(batch.column("_text")):
                grams_out, keys_out, sizes_out, before_out = [], [], [], []
                for grams in shingles(piece):
                    if not len(grams) or (key := class_key(grams)) in seen:
                        continue
                    seen.add(key)
                    length = prefix_length(len(grams))
                    rank = order[(grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                    # Grams are sorted, so a stable sort by rank orders by rank, then hash.
                    first = grams[np.argsort(rank, kind="stable")[:length]]
                    grams_out.append(first)
                    keys_out.append(np.full(len(first), key, np.int64))
                    sizes_out.append(np.full(len(first), len(grams), np.int32))
                    before_out.append((np.arange(len(first)) * 100 // len(grams)).astype(np.int8))
                if grams_out:
                    yield pa.RecordBatch.from_pydict({"gram": np.concatenate(grams_out).view(np.int64), "key": np.concatenate(keys_out), "n": np.concatenate(sizes_out), "before": np.concatenate(before_out)})

    return run


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gram and key -> pairs of small regions, pairs of pivot and class of large ones (kind 0), and the classes of large ones (kind 1: gram, key)."""
    names = ["kind", "a", "b"]

    def close(gram: int, keys: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        """A large region."""
        m = len(keys)
        pivots = np.argsort(tb.mix(keys.view(np.uint64)), kind="stable")[:PIVOTS]
        a, b = np.repeat(keys[pivots], m), np.tile(keys, len(pivots))
        sa, sb = np.repeat(sizes[pivots], m), np.tile(sizes, len(pivots))
        kept = (a != b) & (np.minimum(sa, sb) * DENOMINATOR >= np.maximum(sa, sb) * NUMERATOR)
        a, b = np.minimum(a, b)[kept], np.maximum(a, b)[kept]
        kinds = np.concatenate([np.zeros(len(a), np.int32), np.ones(m, np.int32)])
        return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(np.concatenate([a, np.full(m, gram)])), pa.array(np.concatenate([b, keys]))], names=names)

    def pairs(starts: np.ndarray, lengths: np.ndarray, keys: np.ndarray, sizes: np.ndarray, before: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All small regions at once: their first with their second classes, first with third, and so on."""
        # In the region of the first n-gram that two sets share, all that they share is among what is left of both.
        left = sizes * (100 - before) // 100
        at = np.repeat(starts, lengths) + np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        to_end = np.repeat(starts + lengths, lengths)
        for step in range(1, int(lengths.max(initial=1))):
            i = at[at + step < to_end]
            j = i + step
            kept = np.minimum(sizes[i], sizes[j]) * DENOMINATOR >= np.maximum(sizes[i], sizes[j]) * NUMERATOR
            i, j = i[kept], j[kept]
            kept = similar(np.minimum(left[i], left[j]), sizes[i], sizes[j])
            if kept.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(int(kept.sum()), np.int32)), pa.array(keys[i[kept]]), pa.array(keys[j[kept]])], names=names)

    rest: tuple[np.ndarray, ...] = tuple(np.zeros(0, np.int64) for _ in range(4))

    def emit(grams: np.ndarray, keys: np.ndarray, sizes: np.ndarray, before: np.ndarray) -> Iterator[pa.RecordBatch]:
        fresh = np.concatenate([[True], (grams[1:] != grams[:-1]) | (keys[1:] != keys[:-1])]) if len(grams) else np.zeros(0, bool)
        grams, keys, sizes, before = grams[fresh], keys[fresh], sizes[fresh].astype(np.int64), before[fresh].astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
        lengths = np.diff(np.concatenate([starts, [len(grams)]]))
        few = (lengths > 1) & (lengths <= PAIRS_UPTO)
        made = list(pairs(starts[few], lengths[few], keys, sizes, before))
        for s, m in zip(starts[lengths > PAIRS_UPTO].tolist(), lengths[lengths > PAIRS_UPTO].tolist(), strict=True):
            made.append(close(int(grams[s]), keys[s:s + m], sizes[s:s + m]))
        if made:
            yield from pa.Table.from_batches(made).combine_chunks().to_batches()

    for batch in batches:
        now = [np.concatenate([r, batch.column(c).to_numpy()]) for r, c in zip(rest, ("gram", "key", "n", "before"), strict=True)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))  # the last region may go on
        yield from emit(*[x[:cut] for x in now])
        rest = tuple(x[cut:] for x in now)
    yield from emit(*rest)


def _sets(wanted):
    """The sets of the documents whose class's bit is on: key, size, count vector, hashes. One row for a class and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        seen: set[int] = set()
        for batch in batches:
            slots = batch.column("_slot").to_numpy()
            on = np.flatnonzero((bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1)
            texts = batch.column("_text").take(pa.array(on))
            for piece in tb.pieces(texts):
                rows = [(class_key(g), g) for g in shingles(piece) if len(g)]
                rows = [(k, g) for k, g in dict(rows).items() if k not in seen]
                seen.update(k for k, _ in rows)
                counts = [np.minimum(np.bincount((g & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS), 65535).astype(np.uint16) for _, g in rows]
                if rows:
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array([k for k, _ in rows], pa.int64()), "n": pa.array([len(g) for _, g in rows], pa.int32()),
                        "counts": pa.array([c.tobytes() for c in counts], pa.binary()), "grams": pa.array([g.tobytes() for _, g in rows], pa.binary()),
                    })

    return run


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose distance between count vectors, which never exceeds that of the sets, is small enough."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS).astype(np.int64) for c in ("ca", "cb"))
        full = ((a == 65535) | (b == 65535)).any(axis=1)
        common = np.minimum(a, b).sum(axis=1)
        keep = similar(common, a.sum(axis=1), b.sum(axis=1)) | full
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by a, first the set of a itself and then its partners' -> links."""
    key, mine = None, np.zeros(0, np.uint64)
    for batch in batches:
        a_out, b_out = [], []
        for a, b, grams in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("grams").to_pylist(), strict=True):
            found = np.frombuffer(grams, np.uint64)
            if b is None:
                key, mine = a, found
            elif key == a:
                at = np.searchsorted(mine, found)
                common = int((mine[np.minimum(at, len(mine) - 1)] == found).sum())
                if similar(common, len(mine), len(found)):
                    a_out.append(a)
                    b_out.append(b)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a_out, pa.int64()), "b": pa.array(b_out, pa.int64())})


class Region:
    """Sets of one task, with the components known so far."""

    def __init__(self, keys: list[int], labels: list[int], sets: list[np.ndarray]):
        self.keys, self.sets = keys, sets
        self.sizes = np.array([len(s) for s in sets])
        self.flat, self.bounds = np.concatenate(sets), np.concatenate([[0], np.cumsum(self.sizes)])
        names = np.unique(np.array(labels), return_inverse=True)[1]
        self.label = names.copy()
        self.links: list[tuple[int, int]] = []

    def common(self, rows: np.ndarray, with_set: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of the rows' sets with one set."""
        lengths = self.sizes[rows]
        firsts = np.cumsum(lengths) - lengths
        at = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths) + np.repeat(self.bounds[rows], lengths)
        grams = self.flat[at]
        place = np.minimum(np.searchsorted(with_set, grams), len(with_set) - 1)
        return np.add.reduceat((with_set[place] == grams).astype(np.int64), firsts)

    def link(self, x: int, rows: np.ndarray) -> None:
        for y in rows.tolist():
            if self.label[x] != self.label[y]:
                self.links.append((self.keys[x], self.keys[y]))
                self.label[self.label == self.label[y]] = self.label[x]

    def distances(self, x: int, rows: np.ndarray) -> np.ndarray:
        """Distances of the rows to class x; linked ones are joined to it."""
        common = self.common(rows, self.sets[x])
        self.link(x, rows[similar(common, self.sizes[x], self.sizes[rows])])
        return 1 - common / (self.sizes[x] + self.sizes[rows] - common)

    def join(self, rows: np.ndarray, pivots: int = PIVOTS) -> None:
        """Find links between the components that meet in ``rows``."""
        tau, eps = 1 - NUMERATOR / DENOMINATOR, 1e-9
        if len(np.unique(self.label[rows])) < 2:
            return
        if len(rows) > 4 * pivots:
            chosen = rows[np.linspace(0, len(rows) - 1, pivots).astype(np.int64)]
            d = np.stack([self.distances(int(p), rows) for p in chosen], axis=1)
            if len(np.unique(self.label[rows])) < 2:
                return
            home, nearest = d.argmin(axis=1), d.min(axis=1)
            cells = [rows[(home == c) | (d[:, c] <= nearest + 2 * tau + eps)] for c in range(pivots)]
            if max(len(c) for c in cells) <= 0.7 * len(rows):
                for cell in cells:
                    self.join(cell, pivots)
                return
        else:
            d = np.zeros((len(rows), 1))
        # The cells don't get smaller: one class after the other, outside the largest component.
        labels, counts = np.unique(self.label[rows], return_counts=True)
        main = labels[counts.argmax()]
        for i, x in enumerate(rows.tolist()):
            if self.label[x] == main:
                continue
            near = (np.abs(d - d[i]) <= tau + eps).all(axis=1) & (self.label[rows] != self.label[x])
            near &= np.minimum(self.sizes[rows], self.sizes[x]) * DENOMINATOR >= np.maximum(self.sizes[rows], self.sizes[x]) * NUMERATOR
            if near.any():
                self.distances(x, rows[near])
                main = self.label[rows[np.flatnonzero(self.label[rows] == main)[0]]] if (self.label[rows] == main).any() else self.label[x]


def _join_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by region: key, label, grams -> links."""
    now, held = None, []

    def close() -> pa.RecordBatch:
        links = []
        if len(held) > 1:
            region = Region([k for k, _, _ in held], [x for _, x, _ in held], [np.frombuffer(g, np.uint64) for _, _, g in held])
            region.join(np.arange(len(held)))
            links = region.links
        return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    for batch in batches:
        for region, key, label, grams in zip(*[batch.column(c).to_pylist() for c in ("region", "key", "label", "grams")], strict=True):
            if region != now:
                if held:
                    yield close()
                now, held = region, []
            held.append((key, label, grams))
    if held:
        yield close()


def _bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """Bits of the hash slots of ``keys``: at most bits / 8 bytes."""
    slot = F.pmod(F.xxhash64("key"), F.lit(bits)) + 1
    maps = keys.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("map")).collect()
    out = np.zeros(bits >> 3, np.uint8)
    for r in maps:  # buckets of 32768 bits, from 1; position p of a bucket is bit p
        one = np.frombuffer(bytes(r["map"]), np.uint8)
        out[(r["bucket"] - 1) * 4096:(r["bucket"] - 1) * 4096 + len(one)] |= one
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles and component_id, the smallest id among the documents connected with it by links.

    Words are cut at white space, A-Z lower-cased; a set holds the distinct runs of five words, or the whole
    sequence of fewer. Two documents are linked if their sets' Jaccard similarity is 0.75 or more. Null, empty and
    blank texts have the empty set and are linked with nothing. Repeated rows are linked as copies; rows with a
    null id take part, and a component of such rows alone has a null id. Other columns are not looked at. Sets
    are held as 64-bit hashes.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    shaped = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = stage(shaped.mapInArrow(_classes, f"_id {kind}, key long, n long, slice int, counts binary"), "classes")
    members = found.filter("slice IS NULL").select("_id", "key", "n")

    ranked = found.filter("slice IS NOT NULL").select("slice", "counts").repartition("slice").mapInArrow(_rank_slices, "slice int, ranks binary").collect()
    order = np.zeros((SLICES, (1 << SLOT_BITS) // SLICES), np.uint8)
    for r in ranked:
        order[r["slice"]] = np.frombuffer(r["ranks"], np.uint8)
    ranks = spark.sparkContext.broadcast(order.ravel())

    filed = shaped.select("_text").mapInArrow(_prefixes(ranks), "gram long, key long, n int, before byte")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    regions = stage(filed.repartition(partitions, "gram").sortWithinPartitions("gram", "key").mapInArrow(_regions, "kind int, a long, b long"), "regions")
    large = regions.filter("kind = 1").select(F.col("a").alias("gram"), F.col("b").alias("key"))
    pairs = stage(regions.filter("kind = 0").select("a", "b").distinct(), "pairs")

    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).unionAll(large.select("key")).distinct()
    wanted = stage(ends, "keys")
    # The bit of a document's class decides whether its set is built again; wrong bits only cost time.
    firsts = members.filter("key IS NOT NULL").groupBy("key").agg(F.min("_id").alias("first"))
    n_wanted = wanted.count()
    bits = min(1 << 30, max(1 << 15, 1 << (16 * n_wanted).bit_length()))
    reps = wanted.join(firsts, "key").select(F.col("first").alias("key"))
    bitmap = spark.sparkContext.broadcast(_bitmap(reps, bits))
    slotted = shaped.select("_text", F.pmod(F.xxhash64("_id"), F.lit(bits)).alias("_slot"))
    sets = stage(slotted.mapInArrow(_sets(bitmap), "key long, n int, counts binary, grams binary"), "sets")

    counts = sets.select("key", "counts").dropDuplicates(["key"])
    near = pairs.join(counts.withColumnsRenamed({"key": "a", "counts": "ca"}), "a").join(counts.withColumnsRenamed({"key": "b", "counts": "cb"}), "b")
    near = stage(near.mapInArrow(_possible, "a long, b long"), "possible")
    # A set that several tasks have built meets its partners more than once, which gives the same links; the pairs are
    # sent to the sets while they are few, since a set is some hundred times as long as a pair.
    grams = sets.select("key", "grams")
    theirs = bounded(near, MOST_PAIRS).join(grams.withColumnRenamed("key", "b"), "b").select("a", "b", "grams")
    own = bounded(near.select("a").distinct(), MOST_PAIRS).join(grams.withColumnRenamed("key", "a"), "a").select("a", F.lit(None).cast("long").alias("b"), "grams")
    together = own.unionAll(theirs).repartition(partitions, "a").sortWithinPartitions("a", "b")  # nulls first
    links = stage(together.mapInArrow(_verify, "a long, b long"), "links")

    labels = components(links)
    open_rows = large.join(labels, large["key"] == labels["node"], "left").select("gram", "key", F.coalesce("label", "key").alias("label"))
    # Of regions with the same classes one is enough.
    summary = open_rows.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(7))).alias("y"))
    summary = summary.filter("lo <> hi").groupBy("m", "x", "y").agg(F.min("gram").alias("gram"))
    summary = stage(summary.select("gram", "m"), "open")
    if not summary.isEmpty():
        cuts = F.ceil(F.col("m") / BLOCK).cast("int")
        rows = open_rows.join(summary, "gram").withColumn("cuts", cuts).withColumn("mine", F.pmod(F.xxhash64("key"), F.col("cuts")).cast("int"))
        # Block i meets block j in one task for every i <= j.
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        rows = rows.select(F.xxhash64("gram", F.least("mine", "other"), F.greatest("mine", "other")).alias("region"), "key", "label")
        held = bounded(stage(rows, "blocks"), MOST_PAIRS).join(grams, "key").repartition(partitions, "region").sortWithinPartitions("region", "key")
        more = stage(held.mapInArrow(_join_regions, "a long, b long"), "links")
        labels = components(links.unionAll(more))

    # The smallest id of each component, then of every document.
    of_class = firsts.join(labels, firsts["key"] == labels["node"], "left").select("key", "first", F.coalesce("label", "key").alias("label"))
    of_class = stage(of_class, "classes")
    smallest = of_class.groupBy("label").agg(F.min("first").alias("component_id"))
    named = of_class.join(smallest, "label").select(F.col("key").alias("_key"), "component_id")
    joined = members.join(named, F.col("key") == F.col("_key"), "left")
    return joined.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the smallest id of each component; rows with a null id, and all columns, stay.

    Rows are judged by id and text, so of different texts under one id each has its own component and only copies
    go. Of rows that repeat both, one stays. Other columns stay as they are, whatever their names.
    """
    key = lambda: F.when(F.col(id_col).isNotNull(), F.struct(F.col(id_col).alias("id"), F.md5(F.col(text_col).cast("binary")).alias("digest")))
    found = near_duplicates(docs.select(key().alias("_key"), F.col(text_col).alias("_text")), "_key", "_text").filter("_key IS NOT NULL")
    # A component is named by its smallest id and text. A null text has no digest but equals itself.
    judged = found.groupBy("_key").agg(F.first(F.col("_key") != F.col("component_id")).alias("gone"), F.count(F.lit(1)).alias("n"))
    judged = stage(judged.filter("gone OR n > 1").select(F.col("_key.id").alias("_judged_id"), F.col("_key.digest").alias("_judged_digest"), "gone"), "judged")
    # The row travels as one value, so that no column of it meets a name used here.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"), F.md5(F.col(text_col).cast("binary")).alias("_digest"))
    same = (F.col("_id") == F.col("_judged_id")) & F.col("_digest").eqNullSafe(F.col("_judged_digest"))
    kept = rows.join(judged, same, "left_anti")
    repeated = judged.filter("NOT gone")
    if not repeated.isEmpty():
        kept = kept.unionAll(rows.join(repeated, same, "left_semi").dropDuplicates(["_id", "_digest"]))
    return kept.select("_row.*")
