"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures, confirmed on full sets.

Documents with the same set of word n-grams form one class; a class has a signature of 64 symbols of 16 bits, each the
low bits of a minimum over its hashed n-grams.

1. Multi-index. The signature is cut into 16 chunks of 4 symbols. Signatures at distance 31 or less have a chunk with one
   wrong symbol at most (16 chunks with two each would make 32), so a class is filed under every chunk with every
   single symbol left out: 64 keys, and all pairs up to that distance meet in one of them.
2. Stars. In every key each class is paired with the key's first one only. Pairs whose signatures differ in at most 31
   symbols are confirmed on their sets, and confirmed links give components.
3. What stays open. Keys of three classes or more that still hold several components go on: small ones with their
   pairs across components, larger ones as regions, in which signatures are compared and close ones confirmed in the
   task, across components only. Keys that overlap, as those of a family of near copies do, become one region with
   each class once, and regions are cut into blocks of bounded size, so no task holds a group.

Signatures are random: a pair at similarity s differs in a symbol with probability 1 - s. At 0.85, the least linked
similarity, 32 or more of 64 differ in 5 of 10 ** 11 pairs, at 0.87 in 1 of 10 ** 12; only links
that no chain of other links replaces can be lost that way. No pair below the threshold is ever linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm import textbytes as tb
from tidemill.llm.components import components
from tidemill.llm.jaccard import _bitmap, shingles
from tidemill.session import stage

NUMERATOR, DENOMINATOR = 85, 100
CHUNKS, SYMBOLS = 16, 4
LENGTH = CHUNKS * SYMBOLS
#: Every chunk but the best may hold two wrong symbols: what the keys guarantee.
DISTANCE = 2 * CHUNKS - 1
#: Sets below this size have no partner but equal ones: the nearest other one has an n-gram more.
LEAST_SET = next(n for n in range(1, 1000) if DENOMINATOR * n >= NUMERATOR * (n + 1))
#: Open keys of up to so many classes give pairs; larger ones become regions.
PAIRS_UPTO = 16
#: Partners of a class that one task confirms.
PARTNERS = 2048
#: N-grams in a block of a region.
BLOCK_GRAMS = 2_000_000
#: Classes in a block of a region.
BLOCK_CLASSES = 2048

_RANDOM = np.random.Generator(np.random.PCG64(71))
_FACTORS = _RANDOM.integers(1, 1 << 63, LENGTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = _RANDOM.integers(1, 1 << 63, LENGTH, dtype=np.uint64)
_SECOND = np.uint64(0xA0761D6478BD642F)


def similar(common, size_a, size_b):
    return DENOMINATOR * common >= NUMERATOR * (size_a + size_b - common)


def set_keys(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """128 bits for each non-empty set, as two columns."""
    firsts = np.cumsum(sizes) - sizes
    out = [tb.mix(np.add.reduceat(tb.mix(g), firsts) + sizes.astype(np.uint64)) for g in (flat, flat * _SECOND + np.uint64(1))]
    return np.stack(out, axis=1)


def signatures(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row of LENGTH symbols for each non-empty set of n-gram hashes."""
    firsts = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), LENGTH), np.uint16)
    for i, (factor, salt) in enumerate(zip(_FACTORS, _SALTS, strict=True)):
        turned = (flat ^ salt) * factor
        least = np.minimum.reduceat(turned, firsts)
        out[:, i] = (tb.mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def file_keys(symbols: np.ndarray) -> np.ndarray:
    """Signatures -> per row the LENGTH keys: each chunk with each of its symbols left out."""
    parts = symbols.astype(np.uint64).reshape(-1, CHUNKS, SYMBOLS)
    out = np.empty((len(symbols), CHUNKS, SYMBOLS), np.uint64)
    for left_out in range(SYMBOLS):
        word = np.zeros(parts.shape[:2], np.uint64)
        for s in range(SYMBOLS):
            if s != left_out:
                word = (word << np.uint64(16)) | parts[:, :, s]
        tag = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(SYMBOLS) + np.uint64(left_out + 1)
        out[:, :, left_out] = tb.mix(tb.mix(word) + tag * np.uint64(0x9E3779B97F4A7C15))
    return out.reshape(-1, LENGTH)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents -> id, set key, size, and the signature where the task has not given it yet."""
    seen: set[bytes] = set()
    for batch in batches:
        for piece in tb.pieces(batch.column("_text")):
            sets = shingles(piece)
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            keys: list = [None] * len(sets)
            signs: list = [None] * len(sets)
            if len(full):
                flat = np.concatenate([sets[i] for i in full.tolist()])
                found = [k.tobytes() for k in set_keys(flat, sizes[full])]
                fresh = []
                for i, key in zip(full.tolist(), found, strict=True):
                    keys[i] = key
                    if key not in seen:
                        seen.add(key)
                        fresh.append(i)
                if fresh:
                    rows = signatures(np.concatenate([sets[i] for i in fresh]), sizes[fresh])
                    for i, row in zip(fresh, rows, strict=True):
                        signs[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").slice(piece.first, len(piece)), pa.array(keys, pa.binary()), pa.array(sizes), pa.array(signs, pa.binary())], names=["_id", "key", "n", "sign"]
            )


def _filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes -> keys of the multi-index with class and size, LENGTH rows each."""
    for batch in batches:
        if len(batch):
            symbols = np.frombuffer(b"".join(batch.column("sign").to_pylist()), np.uint16).reshape(-1, LENGTH)
            keys = file_keys(symbols)
            yield pa.RecordBatch.from_pydict({
                "place": pa.array(keys.ravel().view(np.int64)), "cls": pa.array(np.repeat(batch.column("cls").to_numpy(), LENGTH)), "n": pa.array(np.repeat(batch.column("n").to_numpy(), LENGTH)),
            })


def _small_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of small open keys, each a list of its classes with label and size -> pairs across labels that may be similar."""
    for batch in batches:
        a_out, b_out = [], []
        for members in batch.column("members").to_pylist():
            for i, x in enumerate(members):
                for y in members[:i]:
                    if x["label"] != y["label"] and min(x["n"], y["n"]) * DENOMINATOR >= max(x["n"], y["n"]) * NUMERATOR:
                        a_out.append(min(x["cls"], y["cls"]))
                        b_out.append(max(x["cls"], y["cls"]))
        yield pa.RecordBatch.from_pydict({"a": pa.array(a_out, pa.int64()), "b": pa.array(b_out, pa.int64())})


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures differ in DISTANCE symbols at most."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, LENGTH) for c in ("sa", "sb"))
        yield batch.select(["a", "b"]).filter(pa.array((a != b).sum(axis=1) <= DISTANCE))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by a, the set of a itself ahead of its partners' -> links."""
    key, mine = None, np.zeros(0, np.uint64)
    for batch in batches:
        a_out, b_out = [], []
        for a, b, grams in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "grams")], strict=True):
            theirs = np.frombuffer(grams, np.uint64)
            if b is None:
                key, mine = a, theirs
            elif key == a and similar(shared(mine, theirs), len(mine), len(theirs)):
                a_out.append(a)
                b_out.append(b)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a_out, pa.int64()), "b": pa.array(b_out, pa.int64())})


def shared(one: np.ndarray, two: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(one) < len(two):
        one, two = two, one
    return int((one[np.minimum(np.searchsorted(one, two), len(one) - 1)] == two).sum())


def _meet_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by region (one or two blocks of a crowded key): class, label, signature, set -> links between components."""
    now, held = None, []

    def close() -> pa.RecordBatch:
        links = []
        if len({h[1] for h in held}) > 1:
            label = np.unique(np.array([h[1] for h in held]), return_inverse=True)[1]
            signs = np.frombuffer(b"".join(h[2] for h in held), np.uint16).reshape(-1, LENGTH)
            sizes = np.array([len(h[3]) // 8 for h in held])
            firsts = np.cumsum(sizes) - sizes
            distinct, codes = np.unique(np.frombuffer(b"".join(h[3] for h in held), np.uint64), return_inverse=True)
            on = np.zeros(len(distinct), np.uint8)
            for x in range(1, len(held)):
                across = np.flatnonzero(label[:x] != label[x])
                across = across[np.minimum(sizes[across], sizes[x]) * DENOMINATOR >= np.maximum(sizes[across], sizes[x]) * NUMERATOR]
                near = across[(signs[across] != signs[x]).sum(axis=1) <= DISTANCE]
                if not len(near):
                    continue
                # The n-grams of all near sets are looked up among those of x at once.
                mine = codes[firsts[x]:firsts[x] + sizes[x]]
                on[mine] = 1
                ends = np.cumsum(sizes[near])
                spots = np.arange(ends[-1]) + np.repeat(firsts[near] - ends + sizes[near], sizes[near])
                common = np.add.reduceat(on[codes[spots]], ends - sizes[near], dtype=np.int64)
                on[mine] = 0
                for y in near[similar(common, sizes[near], sizes[x])].tolist():
                    if label[y] != label[x]:
                        links.append((held[y][0], held[x][0]))
                        label[label == label[y]] = label[x]
        return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    for batch in batches:
        for region, cls, label, sign, grams in zip(*[batch.column(c).to_pylist() for c in ("region", "cls", "label", "sign", "grams")], strict=True):
            if region != now:
                if held:
                    yield close()
                now, held = region, []
            held.append((cls, label, sign, grams))
    if held:
        yield close()


def _grams(wanted):
    """Texts whose slot's bit is on -> key and sorted n-gram hashes of each set, once in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        seen: set[bytes] = set()
        for batch in batches:
            slots = batch.column("_slot").to_numpy()
            on = np.flatnonzero((bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1)
            for piece in tb.pieces(batch.column("_text").take(pa.array(on))):
                sets = [s for s in shingles(piece) if len(s)]
                if not sets:
                    continue
                keys = [k.tobytes() for k in set_keys(np.concatenate(sets), np.array([len(s) for s in sets]))]
                rows = {k: s for k, s in zip(keys, sets, strict=True) if k not in seen}
                seen.update(rows)
                yield pa.RecordBatch.from_pydict({"key": pa.array(list(rows), pa.binary()), "grams": pa.array([s.tobytes() for s in rows.values()], pa.binary())})

    return run


def _sets_of(wanted: DataFrame, classes: DataFrame, shaped: DataFrame) -> DataFrame:
    """cls and grams of the classes in ``wanted``, built anew from texts; a bitmap of ids spares the others."""
    spark = classes.sparkSession
    named = stage(classes.join(wanted.distinct(), "cls").select("cls", F.col("key").alias("_key"), "first"), "wanted")
    bits = min(1 << 30, max(1 << 15, 1 << (16 * named.count()).bit_length()))
    # Bits that are on by chance cost time only: the keys decide.
    bitmap = spark.sparkContext.broadcast(_bitmap(named.select(F.col("first").alias("key")), bits))
    slotted = shaped.select("_text", F.pmod(F.xxhash64("_id"), F.lit(bits)).alias("_slot"))
    built = slotted.mapInArrow(_grams(bitmap), "key binary, grams binary").join(named.select("cls", "_key"), F.col("key") == F.col("_key"))
    return stage(built.select("cls", "grams"), "sets").dropDuplicates(["cls"])


def _confirmed(pairs: DataFrame, classes: DataFrame, shaped: DataFrame) -> DataFrame:
    """Links among ``pairs`` (a, b) of classes with close signatures."""
    signs = classes.select("cls", "sign")
    both = pairs.join(signs.withColumnsRenamed({"cls": "a", "sign": "sa"}), "a").join(signs.withColumnsRenamed({"cls": "b", "sign": "sb"}), "b")
    near = stage(both.mapInArrow(_close, "a long, b long"), "near")
    sets = _sets_of(near.select(F.explode(F.array("a", "b")).alias("cls")), classes, shaped)
    # A class with many partners is dealt to several tasks, each with its set.
    parts = near.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("parts"))
    dealt = near.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"))
    theirs = dealt.join(sets.withColumnRenamed("cls", "b"), "b").select("a", "part", "b", "grams")
    own = parts.join(sets.withColumnRenamed("cls", "a"), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "grams")
    partitions = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = own.unionAll(theirs).repartition(partitions, "a", "part").sortWithinPartitions("a", "part", "b")  # nulls first
    return stage(together.mapInArrow(_confirm, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id among the documents connected with it by links) and kept.

    Words are cut at white space, A-Z lower-cased; a set holds the distinct runs of five words, or the whole
    sequence of fewer. Two documents are linked if their sets' Jaccard similarity is 0.85 or more. Null, empty and
    blank texts have the empty set and are linked with nothing, so each is kept. Repeated rows are linked as copies;
    of those that carry the smallest id all are marked as kept. Rows with a null id take part, a component of such
    rows alone has a null id, and only there they are kept. An empty table gives an empty one. Other columns are not
    looked at, whatever their names. N-grams are held as 64-bit hashes, sets are told apart by 128 bits.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shaped = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    signed = stage(shaped.mapInArrow(_signed, f"_id {kind}, key binary, n long, sign binary"), "signed")
    grouped = signed.filter("key IS NOT NULL").groupBy("key").agg(F.min("_id").alias("first"), F.max("n").alias("n"), F.max("sign").alias("sign"))
    classes = stage(grouped.withColumn("cls", F.monotonically_increasing_id()), "classes")

    filed = classes.filter(F.col("n") >= LEAST_SET).select("cls", "n", "sign").mapInArrow(_filed, "place long, cls long, n long")
    heads = filed.groupBy("place").agg(F.min(F.struct("cls", "n")).alias("head"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = stage(filed.join(heads, "place").select("place", "cls", "n", F.col("head.cls").alias("head"), F.col("head.n").alias("head_n"), "m"), "members")
    fit = F.least("n", "head_n") * DENOMINATOR >= F.greatest("n", "head_n") * NUMERATOR
    stars = members.filter((F.col("cls") != F.col("head")) & fit).select(F.col("head").alias("a"), F.col("cls").alias("b")).distinct()
    links = _confirmed(stars, classes, shaped)
    labels = components(links)

    crowded = members.filter("m > 2").join(labels, F.col("cls") == F.col("node"), "left").select("place", "cls", "n", F.coalesce("label", "cls").alias("label"))
    # Of keys with the same classes one is enough.
    facts = crowded.groupBy("place").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("grams"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(7))).alias("y")
    )
    still = stage(facts.filter("lo <> hi").groupBy("m", "grams", "x", "y").agg(F.min("place").alias("place")).select("place", "m", "grams"), "open")
    if not still.isEmpty():
        rows = stage(crowded.join(still.drop("grams"), "place"), "open_rows")
        listed = rows.filter(F.col("m") <= PAIRS_UPTO).groupBy("place").agg(F.collect_list(F.struct("cls", "label", "n")).alias("members"))
        few = listed.select("members").mapInArrow(_small_groups, "a long, b long").distinct()
        more = _confirmed(few.join(stars, ["a", "b"], "left_anti"), classes, shaped)
        links = links.unionAll(more).unionAll(_region_links(rows.filter(F.col("m") > PAIRS_UPTO), classes, shaped))
        labels = components(links)

    of_class = stage(classes.select("key", "first", "cls").join(labels, F.col("cls") == F.col("node"), "left").select("key", "first", F.coalesce("label", "cls").alias("label")), "named")
    smallest = of_class.groupBy("label").agg(F.min("first").alias("component"))
    named = of_class.join(smallest, "label").select(F.col("key").alias("_key"), "component")
    joined = signed.join(named, F.col("key") == F.col("_key"), "left")
    component = F.when(F.col("key").isNull(), F.col("_id")).otherwise(F.col("component"))
    return joined.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("_id")).alias("kept"))


def _merged(rows: DataFrame) -> DataFrame:
    """Crowded keys (place, cls, n, label, m) -> regions (place and whole, cls, n, label), with all pairs of each key in one.

    Near copies of one text fill most of its keys, and their pairs would be compared in each. So keys are named after
    their most crowded class, the one whose keys hold the most classes, and the keys of one name (LENGTH at most)
    become one region, named by that class, with each of its classes once; where the union makes more pairs than the
    keys do, they stay regions of their own.
    """
    weighed = rows.withColumn("weight", F.sum("m").over(Window.partitionBy("cls")))
    heads = stage(weighed.groupBy("place").agg(F.max(F.struct("weight", "cls")).getField("cls").alias("head"), F.max("m").alias("m")), "heads")
    named = rows.drop("m").join(heads, "place").select("place", "head", "cls", "n", "label")
    union = named.select("head", "cls").distinct().groupBy("head").agg(F.count(F.lit(1)).alias("size"))
    whole = union.join(heads.groupBy("head").agg(F.sum(F.col("m") * F.col("m")).alias("pairs")), "head").select("head", (F.col("size") * F.col("size") <= F.col("pairs")).alias("whole"))
    region = F.when(F.col("whole"), F.col("head")).otherwise(F.col("place"))
    return named.join(whole, "head").select(region.alias("place"), "whole", "cls", "n", "label").distinct()


def _region_links(rows: DataFrame, classes: DataFrame, shaped: DataFrame) -> DataFrame:
    """Links within crowded keys (place, cls, n, label, m classes): every block of a region meets every other one in a task."""
    rows = stage(rows, "regions")
    if rows.isEmpty():
        return classes.sparkSession.createDataFrame([], "a long, b long")
    sets = _sets_of(rows.select("cls"), classes, shaped)
    rows = stage(_merged(rows), "merged")
    totals = rows.groupBy("place", "whole").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("m"))
    cuts = F.ceil(F.greatest(F.col("total") / BLOCK_GRAMS, F.col("m") / BLOCK_CLASSES)).cast("int")
    cut = rows.join(totals, ["place", "whole"]).withColumn("cuts", cuts).withColumn("mine", F.pmod(F.xxhash64("cls"), "cuts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    cut = cut.select(F.xxhash64("place", "whole", F.least("mine", "other"), F.greatest("mine", "other")).alias("region"), "cls", "label")
    held = cut.join(classes.select("cls", "sign"), "cls").join(sets, "cls")
    partitions = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = held.repartition(partitions, "region").sortWithinPartitions("region", "cls")
    return stage(held.mapInArrow(_meet_blocks, "a long, b long"), "links")
