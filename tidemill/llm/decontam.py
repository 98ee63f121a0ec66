"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The automaton holds every run of words of the items. Streaming a document through it gives, at each word, the
longest run of item words that ends there; where that run reaches a window (``window`` words, or a whole item
of fewer words), the window's words are hit and its items noted. Only stretches of words that all occur in
items are streamed, since the match is empty outside them. Items are cut into chunks of bounded size, one
automaton for each chunk, so that what a task holds does not grow with the benchmark.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import textbytes as tb
from tidemill.session import stage

#: Characters of item text in one automaton.
CHUNK_CHARS = 4_000_000


class Automaton:
    """States are numbers; ``step`` has the words leading out of each, ``link`` the longest suffix in another state."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int):
        self.window = window
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *[w for _, w in items]]))
        self.vocabulary = vocabulary
        self.shortest = min([window, *[len(w) for _, w in items if len(w)]])
        marks: list[tuple[int, int, str]] = []
        for item, words in items:
            at = 0
            for n, word in enumerate(np.searchsorted(vocabulary, words).tolist(), 1):
                at = self._extend(at, word)
                if n >= window:
                    marks.append((at, window, item))
            if 0 < len(words) < window:
                marks.append((at, len(words), item))
        #: State -> windows that end in it: words of the window -> items.
        self.ends: dict[int, dict[int, set[str]]] = {}
        for state, n, item in marks:
            while self.length[self.link[state]] >= n:
                state = self.link[state]
            self.ends.setdefault(state, {}).setdefault(n, set()).add(item)
        #: State -> the windows ending in it or in one of its suffixes; filled as states are met.
        self.known: dict[int, list[tuple[int, set[str]]]] = {}

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            old = self.step[last][word]
            return old if self.length[old] == self.length[last] + 1 else self._split(last, word, old)
        new = self._state(self.length[last] + 1, {})
        p = last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            old = self.step[p][word]
            self.link[new] = old if self.length[old] == self.length[p] + 1 else self._split(p, word, old)
        return new

    def _state(self, length: int, step: dict[int, int], link: int = 0) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, word: int, old: int) -> int:
        """A state for the part of ``old`` that ``p`` reaches by ``word``."""
        clone = self._state(self.length[p] + 1, dict(self.step[old]), self.link[old])
        self.link[old] = clone
        while p >= 0 and self.step[p].get(word) == old:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def windows(self, state: int) -> list[tuple[int, set[str]]]:
        if state not in self.known:
            found, at = [], state
            while at > 0:
                found += self.ends.get(at, {}).items()
                at = self.link[at]
            self.known[state] = found
        return self.known[state]

    def stream(self, words: list[int], first: int, hit: np.ndarray, items: set[str]) -> None:
        """Follow words that all occur in items; mark what is hit in ``hit`` from place ``first`` on."""
        state = matched = 0
        for i, word in enumerate(words, first):
            while state and word not in self.step[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.step[state]:
                state = self.step[state][word]
                matched += 1
            if matched >= self.shortest:
                for n, names in self.windows(state):
                    if n <= matched:
                        hit[i + 1 - n:i + 1] = True
                        items |= names


#: The automaton that this worker process built last, by the name of its chunk.
_built: dict[str, Automaton] = {}


def _automaton(key: str, chunk, window: int) -> Automaton:
    """One automaton for a chunk and worker process, however many tasks it runs; that of an earlier chunk is let go."""
    if key not in _built:
        _built.clear()
        items = []
        for name, text in chunk.value:
            piece = next(tb.pieces(pa.array([text], pa.string())))
            items.append((name, tb.lower_words(piece, tb.ALNUM)[0]))
        _built[key] = Automaton(items, window)
    return _built[key]


RESULT = "_id {id}, n_words long, spans array<struct<first:int,past:int>>, items array<string>"


def _spans(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _scan(chunk, window: int):
    """Documents -> words, hit spans and items of one chunk."""
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = _automaton(key, chunk, window)
        common = np.zeros(1 << 16, bool)
        common[(auto.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        for batch in batches:
            n_words, spans, names = [], [], []
            for piece in tb.pieces(batch.column("_text")):
                words, bounds = tb.lower_words(piece, tb.ALNUM)
                maybe = np.flatnonzero(common[(words & np.uint64(0xFFFF)).astype(np.int64)])
                place = np.searchsorted(auto.vocabulary, words[maybe])
                sure = auto.vocabulary[np.minimum(place, len(auto.vocabulary) - 1)] == words[maybe] if len(auto.vocabulary) else np.zeros(len(maybe), bool)
                at, place = maybe[sure], place[sure]
                # Stretches of neighbouring known words inside one document.
                doc = np.searchsorted(bounds, at, "right") - 1
                cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(doc) != 0)) + 1
                begins, ends = np.concatenate([[0], cut]).astype(np.int64), np.concatenate([cut, [len(at)]]).astype(np.int64)
                hits: dict[int, tuple[np.ndarray, set[str]]] = {}
                for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
                    if e - b >= auto.shortest:
                        d = int(doc[b])
                        if d not in hits:
                            hits[d] = (np.zeros(int(bounds[d + 1] - bounds[d]), bool), set())
                        auto.stream(place[b:e].tolist(), int(at[b] - bounds[d]), *hits[d])
                n_words += np.diff(bounds).tolist()
                for d in range(len(piece)):
                    hit, found = hits.get(d, (None, ()))
                    names.append(sorted(found))
                    spans.append([] if hit is None else [{"first": int(f), "past": int(p)} for f, p in zip(*_spans(hit), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))), pa.array(names, pa.list_(pa.string()))],
                names=["_id", "n_words", "spans", "items"],
            )

    return run


def _merge_chunks(parts: DataFrame) -> DataFrame:
    """One row per document from the rows of its chunks."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, items = [], []
            for row in batch.select(["all_spans", "all_items"]).to_pylist():
                both = sorted((s["first"], s["past"]) for chunk in row["all_spans"] for s in chunk)
                merged: list[list[int]] = []
                for first, past in both:
                    if merged and first <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], past)
                    else:
                        merged.append([first, past])
                spans.append([{"first": f, "past": p} for f, p in merged])
                items.append(sorted({i for chunk in row["all_items"] for i in chunk}))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("n_words"), pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))), pa.array(items, pa.list_(pa.string()))],
                names=["_id", "n_words", "spans", "items"],
            )

    kind = parts.schema["_id"].dataType.simpleString()
    grouped = parts.groupBy("_row").agg(F.first("_id").alias("_id"), F.first("n_words").alias("n_words"), F.collect_list("spans").alias("all_spans"), F.collect_list("items").alias("all_items"))
    return grouped.drop("_row").mapInArrow(unite, RESULT.format(id=kind))


def find_matches(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """Per document: id, n_words, hit spans as word places [first, past), sorted ids of the items with occurring windows.

    Words are runs of ASCII letters, digits and characters above 0x7F, A-Z lower-cased. Null and empty texts have
    no words; items without words or with a null id have no windows, and item ids are compared as text. Repeated
    documents each get their row, repeated items count once. Without items nothing is hit.
    """
    texts = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")).filter("item IS NOT NULL AND text IS NOT NULL")
    texts = stage(texts.distinct().withColumn("size", F.length("text").cast("long") + 16), "items")
    total = texts.agg(F.sum("size")).first()[0] or 0
    chunks = max(1, -(-total // chunk_chars))
    id_type = docs.schema[id_col].dataType.simpleString()
    shaped = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    if chunks > 1:  # a document meets the chunks one by one and its rows are merged
        shaped = stage(shaped.withColumn("_row", F.expr("uuid()")), "documents")
    parts = None
    for n in range(chunks):
        mine = texts.filter(F.pmod(F.xxhash64("item", "text"), F.lit(chunks)) == n).select("item", "text").orderBy("item", "text").collect()
        chunk = docs.sparkSession.sparkContext.broadcast([(r["item"], r["text"]) for r in mine])
        if chunks == 1:
            return shaped.mapInArrow(_scan(chunk, window), RESULT.format(id=id_type))
        keyed = shaped.select(F.struct("_row", "_id").alias("_id"), "_text")
        found = keyed.mapInArrow(_scan(chunk, window), RESULT.format(id=f"struct<_row:string,_id:{id_type}>")).select("_id._row", "_id._id", "n_words", "spans", "items")
        parts = found if parts is None else parts.unionAll(found)
    return _merge_chunks(parts)


def n_hit(spans="spans") -> F.Column:
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda s, x: s + x["past"] - x["first"])


def contaminated(share: int = 20) -> F.Column:
    """At least one word hit, and at least one of ``share`` words."""
    return (n_hit() > 0) & (F.lit(share) * n_hit() >= F.col("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, share: int = 20, **names) -> DataFrame:
    """Drop contaminated documents; all columns of the others stay as they are. A document with a null id is kept.

    Contamination is a matter of the text, so documents that share an id are dropped together only if each is hit.
    """
    found = find_matches(docs.select(id_col, text_col), items, id_col, text_col, window=window, **names)
    judged = found.groupBy("_id").agg(F.min(contaminated(share)).alias("bad")).filter("bad").select(F.col("_id").alias(id_col))
    return docs.join(judged, id_col, "left_anti")


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the bytes from the first to the last word of each span of words."""
    piece = next(tb.pieces(pa.array([text], pa.string())))
    starts, ends, _ = tb.word_spans(piece, tb.ALNUM)
    out, at = [], 0
    for first, past in spans:
        out.append(piece.data[at:starts[first]].tobytes())
        at = ends[past - 1]
    return b"".join([*out, piece.data[at:].tobytes()]).decode()


def cut_matches(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = 13, share: int = 20, **names) -> DataFrame:
    """Drop contaminated documents and cut the hit spans out of all others; other columns stay as they are.

    A span goes from the first to the last word of windows that overlap or touch, so it has ``window`` words or a
    whole shorter item at least; a document where spans cover one of ``share`` words or more goes as a whole. Each
    row is judged by its own text, also where ids are repeated or null. Null texts stay null.
    """
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    whole = docs.select(row.alias("_doc"), F.col(f"`{text_col}`").alias("_text"))
    found = find_matches(whole, items, "_doc", "_text", window=window, **names).filter(~contaminated(share))
    text = F.col(f"_id.c{docs.columns.index(text_col)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                remove_spans(t, [(s["first"], s["past"]) for s in spans]) if spans else t
                for t, spans in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(texts, pa.string())], names=["_id", "_text"])

    kind = whole.schema["_doc"].dataType.simpleString()
    cut = found.select("_id", text.alias("_text"), "spans").mapInArrow(run, f"_id {kind}, _text string")
    return cut.select(*[F.col("_text" if c == text_col else f"_id.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def items_digest(names="items") -> F.Column:
    return F.sha2(F.concat_ws(",", F.array_sort(F.col(names))), 256)


