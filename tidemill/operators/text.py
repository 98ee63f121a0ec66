"""Text preprocessing over token tables and vocabularies.

A document is one row of the input, so its own tokens may be gathered again; anything
that crosses documents stays distributed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.stemming import stem_tokens, stem_word
from tidemill.functions.tokens import basic_tokens, without_stop_words
from tidemill.operators.joins import LOOKUP_CHARS, LOOKUP_ROWS, salted_lookup
from tidemill.operators.ordering import global_row_number
from tidemill.session import spread, stage

PADDING, END, START = "", "[END]", "[START]"


def token_rows(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """One row per token with its place in the document."""
    return df.select(key, F.posexplode(tokens).alias("pos", "token"))


def gather_tokens(rows: DataFrame, key: str, value: str = "token", out: str = "tokens") -> DataFrame:
    """Tokens of each document in their order."""
    pairs = F.sort_array(F.collect_list(F.struct("pos", F.col(value).alias("v"))))
    return rows.groupBy(key).agg(F.transform(pairs, lambda s: s["v"]).alias(out))


def _filtered(lists: pa.Array, values: pa.Array, keep: np.ndarray) -> pa.Array:
    """The lists with ``values`` in place of their flat items, reduced to those to keep; null lists stay null."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(keep)])
    offsets = upto[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values.filter(pa.array(keep)), mask=lists.is_null() if lists.null_count else None)


def _frequent_tokens(min_count: int):
    @F.arrow_udf("array<string>")
    def keep(lists: pa.Array) -> pa.Array:
        flat = lists.flatten()
        rows = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        codes = flat.dictionary_encode(null_encoding="encode")
        key = rows * max(1, len(codes.dictionary)) + codes.indices.to_numpy(zero_copy_only=False)
        _, place, n = np.unique(key, return_inverse=True, return_counts=True)
        return _filtered(lists, flat, n[place] >= min_count)

    return keep


def drop_rare(df: DataFrame, tokens: str, min_count: int = 2) -> DataFrame:
    """Keep tokens that occur at least ``min_count`` times within their document, in their order.

    A document's tokens sit in one row, so they are counted there, for whole Arrow batches at once, and no token is
    shuffled. A null list stays null.
    """
    return df.withColumn(tokens, _frequent_tokens(min_count)(F.col(tokens)))


def _shared_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys of several rows, null included."""
    return stage(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col(key).alias("_shared")), "shared")


def drop_rare_in_corpus(df: DataFrame, key: str, tokens: str, min_count: int, small_rows: int = LOOKUP_ROWS) -> DataFrame:
    """key and tokens: those that occur at least ``min_count`` times in the whole corpus, in their order.

    Tokens are counted in their tasks ahead of the shuffle and kept or dropped in their rows, so lists are not taken
    apart. Only keys that several rows share are gathered from single tokens, by their places. Documents of rare
    tokens alone are left out.
    """
    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("_n"))
    frequent = stage(counts.filter((F.col("_n") >= min_count) & F.col("token").isNotNull()).select("token"), "frequent")
    shared = _shared_keys(df, key)
    if shared.isEmpty():
        return _by_words(df, key, F.col(tokens), frequent, _known_only, "array<string>", tokens, small_rows).filter(F.size(tokens) > 0)
    same = F.col(key).eqNullSafe(F.col("_shared"))
    single = _by_words(df.join(shared, same, "left_anti"), key, F.col(tokens), frequent, _known_only, "array<string>", tokens, small_rows).filter(F.size(tokens) > 0)
    several = token_rows(df.join(shared, same, "left_semi"), key, F.col(tokens))
    return single.unionByName(gather_tokens(salted_lookup(several, frequent, "token", key, small_rows=small_rows), key, out=tokens))


def stem_vocabulary(words: DataFrame, stemmer: str = "porter", out: str = "stem") -> DataFrame:
    """Stem of each distinct token; the stemmer runs once per token, not once per occurrence."""
    return words.withColumn(out, stem_word(F.col("token"), stemmer))


def preprocess(df: DataFrame, key: str, text: str, min_count: int = 2, stemmer: str = "porter") -> DataFrame:
    """Tokenise, drop stop words, stem, and drop what is rare within the document; one pass, no shuffle."""
    tokens = without_stop_words(basic_tokens(F.col(text)))
    stemmed = df.select(key, stem_tokens(tokens, stemmer).alias("tokens"))
    return drop_rare(stemmed, "tokens", min_count)


def _list_counts():
    @F.arrow_udf("array<struct<token:string,n:bigint>>")
    def count(lists: pa.Array) -> pa.Array:
        """The distinct tokens of every list with their numbers."""
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        codes = lists.flatten().dictionary_encode(null_encoding="encode")
        size = max(1, len(codes.dictionary))
        key, n = np.unique(np.repeat(np.arange(len(lists)), lengths) * size + codes.indices.to_numpy(zero_copy_only=False), return_counts=True)
        offsets = np.searchsorted(key, np.arange(len(lists) + 1) * size).astype(np.int32)
        pairs = pa.StructArray.from_arrays([codes.dictionary.take(pa.array(key % size)), pa.array(n, pa.int64())], names=["token", "n"])
        return pa.ListArray.from_arrays(pa.array(offsets), pairs)

    return count


def word_counts(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """Number of each token of a document: key, token, n.

    The tokens of a document are counted in their row. Only keys that several rows share are brought together.
    """
    held = df.select(F.col(key).alias("_key"), F.col(tokens).alias("_tokens"))
    shared = _shared_keys(held, "_key")
    same = F.col("_key").eqNullSafe(F.col("_shared"))
    single = held.join(shared, same, "left_anti").select(F.col("_key").alias(key), F.explode(_list_counts()("_tokens")).alias("c")).select(key, "c.token", "c.n")
    several = token_rows(held.join(shared, same, "left_semi").withColumnRenamed("_key", key), key, F.col("_tokens"))
    return single.unionByName(several.groupBy(key, "token").agg(F.count(F.lit(1)).alias("n")))


def bag_of_words(counts: DataFrame, key: str, vocabulary: DataFrame) -> DataFrame:
    """Sparse counts by term number: one row per document and term."""
    return salted_lookup(counts, vocabulary, "token", key).select(key, "term_id", "n")


def sorted_vocabulary(rows: DataFrame, start: int = 0, out: str = "term_id") -> DataFrame:
    """Distinct tokens numbered in sorted order."""
    return global_row_number(rows.select("token").distinct(), ["token"], out, start)


def special_vocabulary(rows: DataFrame) -> DataFrame:
    """Vocabulary from id 1 on, with the padding id 0 and the end and start ids behind the last token."""
    words = stage(sorted_vocabulary(rows, 1), "vocabulary")
    last = words.agg(F.max("term_id").alias("_last"))
    special = last.select(F.explode(F.array(
        F.struct(F.lit(PADDING).alias("token"), F.lit(0).cast("long").alias("term_id")),
        F.struct(F.lit(END).alias("token"), (F.col("_last") + 1).alias("term_id")),
        F.struct(F.lit(START).alias("token"), (F.col("_last") + 2).alias("term_id")),
    )).alias("s")).select("s.*")
    return words.select("token", "term_id").union(special)


def _known_only(lists: pa.Array, known: pa.Table) -> pa.Array:
    """Token lists without unknown tokens."""
    flat = lists.flatten()
    codes = flat.dictionary_encode()
    held = np.append(pc.is_in(codes.dictionary, value_set=known.column("token").combine_chunks()).to_numpy(zero_copy_only=False), False)
    return _filtered(lists, flat, held[pc.fill_null(codes.indices, -1).to_numpy(zero_copy_only=False)])


def _numbered(lists: pa.Array, known: pa.Table) -> pa.Array:
    """Token lists to number lists; unknown tokens are left out."""
    numbers = known.column("term_id").to_numpy()
    codes = lists.flatten().dictionary_encode()
    at = pc.index_in(codes.dictionary, value_set=known.column("token").combine_chunks())
    held = np.append(~at.is_null().to_numpy(zero_copy_only=False), False)
    ids = np.append(numbers[pc.fill_null(at, 0).to_numpy(zero_copy_only=False)], 0) if len(at) and len(numbers) else np.zeros(1, np.int64)
    spot = pc.fill_null(codes.indices, -1).to_numpy(zero_copy_only=False) if len(numbers) else np.full(len(codes), -1)
    return _filtered(lists, pa.array(ids[spot], pa.int64()), held[spot])


def _placed_counts(lists: pa.Array, known: pa.Table) -> pa.Array:
    """Token lists to pairs of a known token's number and how often it occurs, by number."""
    numbered = _numbered(lists, known)
    ids = numbered.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = int(ids.max()) + 1 if len(ids) else 1
    lengths = pc.fill_null(pc.list_value_length(numbered), 0).to_numpy(zero_copy_only=False)
    key, n = np.unique(np.repeat(np.arange(len(lists)), lengths) * size + ids, return_counts=True)
    offsets = np.searchsorted(key, np.arange(len(lists) + 1) * size).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(key % size, pa.int32()), pa.array(n, pa.float64())], names=["i", "n"])
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)


#: Tokens in the documents that look their words up together.
CHUNK_TOKENS = 1_000_000


def _chunked(batches):
    """Rows with ``tokens`` -> the same with ``_chunk``, which rows in a row share until it holds CHUNK_TOKENS tokens."""
    first, held = TaskContext.get().partitionId() << 33, 0
    for batch in batches:
        lengths = pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto = held + np.cumsum(lengths)
        chunk = first + (upto - lengths) // CHUNK_TOKENS
        held = int(upto[-1]) if len(upto) else held
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunk, pa.int64())], names=[*batch.schema.names, "_chunk"])


def _by_words(df: DataFrame, key: str, tokens: Column, vocabulary: DataFrame, on_lists, kind: str, out: str, small_rows: int) -> DataFrame:
    """key and ``out``: ``on_lists`` of the token lists and the words of the vocabulary that may occur in them.

    A vocabulary of checked size is broadcast, and lists are looked up in their rows without any shuffle. A larger one
    is joined with the distinct tokens of chunks of documents, and each chunk meets its own part of it: a document is
    shuffled once, as one row, and a word once for each chunk that holds it.
    """
    size = vocabulary.select(F.length("token").alias("l")).limit(small_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum("l").alias("l")).first()
    if size["n"] <= small_rows and (size["l"] or 0) <= LOOKUP_CHARS:
        data = df.sparkSession.sparkContext.broadcast(vocabulary.toArrow().combine_chunks())
        look_up_here = F.arrow_udf(kind)(_on_broadcast(on_lists, data))
        return df.select(key, look_up_here(tokens).alias(out))
    shaped = df.select(F.col(key).alias("_key"), tokens.alias("tokens"))
    key_kind = shaped.schema["_key"].dataType.simpleString()
    chunks = stage(shaped.mapInArrow(_chunked, f"_key {key_kind}, tokens array<string>, _chunk long"), "chunks")
    words = chunks.select("_chunk", F.explode("tokens").alias("token")).distinct()
    found = words.join(vocabulary, "token").withColumnRenamed("_chunk", "_part")

    def look_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        lists = pa.concat_arrays(rows.column("tokens").chunks) if len(rows) else pa.array([], rows.schema.field("tokens").type)
        return pa.table({"_key": rows.column("_key"), out: on_lists(lists, known)})

    met = chunks.groupBy("_chunk").cogroup(found.groupBy("_part")).applyInArrow(look_up, f"_key {key_kind}, {out} {kind}")
    return met.select(F.col("_key").alias(key), out)


def _on_broadcast(on_lists, data):
    def run(lists: pa.Array) -> pa.Array:
        return on_lists(lists, data.value)

    return run


def encode(df: DataFrame, key: str, tokens: Column, vocabulary: DataFrame, small_rows: int = LOOKUP_ROWS) -> DataFrame:
    """key and ids: the numbers of the tokens in their order, without unknown ones."""
    return _by_words(df, key, tokens, vocabulary.select("token", "term_id"), _numbered, "array<bigint>", "ids", small_rows)


def encode_pad(df: DataFrame, key: str, tokens: Column, vocabulary: DataFrame, length: int | None = None, add_end: bool = False, small_rows: int = LOOKUP_ROWS) -> DataFrame:
    """Token ids with start (and end) marks, padded to ``length`` or to the longest document.

    A document longer than a given length is an error, never cut.
    """
    ids = encode(df, key, tokens, vocabulary, small_rows)
    marks = vocabulary.agg(
        F.max(F.when(F.col("token") == START, F.col("term_id"))).alias("_start"),
        F.max(F.when(F.col("token") == END, F.col("term_id"))).alias("_end"),
    )
    known = ids.join(F.broadcast(marks))
    body = F.coalesce("ids", F.array().cast("array<bigint>"))
    tail = F.array("_end") if add_end else F.array().cast("array<bigint>")
    marked = known.select(key, F.concat(F.array("_start"), body, tail).alias("ids"))
    if length is None:
        marked = stage(marked, "encoded")
        longest = marked.agg(F.max(F.size("ids")).alias("_len"))
        sized = spread(marked).join(F.broadcast(longest))
    else:
        sized = marked.withColumn("_len", F.lit(length))
    gap = F.col("_len") - F.size("ids")
    padded = F.concat("ids", F.array_repeat(F.lit(0).cast("long"), gap))
    too_long = F.raise_error(F.concat(F.lit("a sequence is longer than "), F.col("_len").cast("string")))
    return sized.select(key, F.when(gap >= 0, padded).otherwise(too_long).alias("ids"))


def dictionary(tokens: DataFrame, key: str, column: str, min_docs: int = 2) -> DataFrame:
    """Words in at least ``min_docs`` documents, numbered in sorted order: token, term_id."""
    words = tokens.select(key, F.explode(F.array_distinct(column)).alias("token"))
    frequent = words.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_docs)
    return global_row_number(frequent.select("token"), ["token"], "term_id", 0)


_sparse = F.udf(lambda size, places, values: Vectors.sparse(size, places, values), VectorUDT())


def placed_counts(df: DataFrame, key: str, column: str, words: DataFrame, small_rows: int = LOOKUP_ROWS) -> DataFrame:
    """key and ``pairs``: the dictionary's words in the document as (place i, number n), by place.

    ``words`` (token, term_id) may have any size. The tokens of a row are looked up and counted there, and only the
    (place, count) pairs of keys that several rows share are brought together: those rows are one document. Without
    known words, and for a null key, the list is empty.
    """
    keyed = df.filter(F.col(key).isNotNull())
    placed = _by_words(keyed, key, F.col(column), words.select("token", "term_id"), _placed_counts, "array<struct<i:int,n:double>>", "pairs", small_rows)
    shared = _shared_keys(keyed, key)
    if not shared.isEmpty():
        same = F.col(key) == F.col("_shared")
        pairs = placed.join(shared, same, "left_semi").select(key, F.explode_outer("pairs").alias("p")).groupBy(key, F.col("p.i").alias("i")).agg(F.sum("p.n").alias("n"))
        merged = pairs.groupBy(key).agg(F.sort_array(F.collect_list(F.when(F.col("i").isNotNull(), F.struct("i", "n")))).alias("pairs"))
        placed = placed.join(shared, same, "left_anti").unionByName(merged)
    unnamed = df.filter(F.col(key).isNull()).select(key).distinct().withColumn("pairs", F.array().cast("array<struct<i:int,n:double>>"))
    return placed.unionByName(unnamed)


def count_vectors(df: DataFrame, key: str, column: str, words: DataFrame, out: str = "counts", small_rows: int = LOOKUP_ROWS) -> DataFrame:
    """key and the sparse counts of the dictionary's words in the document; every word has a place of its own."""
    size = F.broadcast(words.agg(F.count(F.lit(1)).cast("int").alias("_size")))
    every = placed_counts(df, key, column, words, small_rows).join(size)
    return every.select(key, _sparse("_size", F.transform("pairs", lambda p: p["i"]), F.transform("pairs", lambda p: p["n"])).alias(out))
