"""Line dedup by a deletion-neighbourhood join, with DataFrame functions only.

Lines are compared as sequences of lower-cased words. Two lines are near when one word inserted, deleted or
replaced turns one into the other; they are then equal after at most one deletion from each, at the same place
where both lose a word. Each line emits a hashed key for itself and for itself without each of its words; keys
meet in a join, the earliest line of a key is found by an aggregate (no pairs are made), and the words of the two
lines are compared. Every line that has an equal or near line earlier in the input goes.

Before that, cheap keys set aside the lines that have no near line: of two near lines either the first or the
last halves agree, taken at half the length of the shorter one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import stage

MIN_WORDS = 6
#: Sides of at most so many rows and list entries are broadcast; larger ones are joined by a shuffle.
SMALL_ROWS, SMALL_ENTRIES = 400_000, 4_000_000
SPACE = r"[\x20\x09-\x0D]+"
PRIME = (1 << 31) - 1


def line_words(line) -> Column:
    return F.filter(F.split(F.lower(line), SPACE), lambda w: w != "")


def _small(df: DataFrame, entries: Column | None = None) -> DataFrame:
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(entries if entries is not None else F.lit(1)), F.lit(0)).alias("e")).first()
    return F.broadcast(df) if size["n"] <= SMALL_ROWS and size["e"] <= SMALL_ENTRIES else df


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, line_no and words of every line; words are made ahead of the rows, so that a filter on them makes none anew."""
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    return rows.select("doc", F.posexplode(F.transform(F.split("text", "\n", -1), line_words)).alias("line_no", "words"))


def line_key(words: Column, n: Column) -> Column:
    """The line as 128 bits, two hashes with different seeds, so that chance equals none at any size of the corpus."""
    return F.struct(F.xxhash64(words, n).alias("a"), F.xxhash64(F.lit(1), words, n).alias("b"))


def _several_lines() -> Column:
    """Whether the rows of a group hold more than one line; four numbers, which hash aggregates take."""
    return (F.min("h.a") != F.max("h.a")) | (F.min("h.b") != F.max("h.b"))


def _half_keys(words: Column, n: Column) -> Column:
    """Four keys: first and last half, at half this length and at half the length less one."""
    keys = []
    for of in (n, n - 1):
        half = F.floor(of / 2).cast("int")
        keys += [F.xxhash64(of, F.lit(0), F.slice(words, 1, half)), F.xxhash64(of, F.lit(1), F.slice(words, n - half + 1, half))]
    return F.array(*keys)


def _without(words: Column, place: Column) -> Column:
    """The words without the one at ``place`` (from 1); all of them for place 0."""
    return F.when(place == 0, words).otherwise(F.concat(F.slice(words, 1, place - 1), F.slice(words, place + 1, F.size(words))))


def _deletion_keys(lines: DataFrame) -> DataFrame:
    """h, first, place and key for place 0 (the whole line) and for every word left out.

    A key is a sum over words of hash times a number for the word's place, modulo a prime, with two hashes;
    words behind the gap move down one place. Sums up to a word come from a window over the line's words.
    """
    terms, sums = [], []
    for s in (1, 2):
        word, of = F.pmod(F.xxhash64(F.lit(s), "word"), F.lit(PRIME)), lambda place, s=s: F.pmod(F.xxhash64(F.lit(s + 10), place), F.lit(PRIME))
        terms += [(word * of(F.col("place")) % PRIME).alias(f"a{s}"), (word * of(F.col("place") - 1) % PRIME).alias(f"c{s}")]
    words = lines.select("h", "first", F.size("words").alias("n"), F.posexplode("words").alias("at", "word")).withColumn("place", F.col("at") + 1)
    words = words.select("h", "first", "n", "place", *terms)
    upto = Window.partitionBy("h").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("h").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for s in (1, 2):
        a, c = F.col(f"a{s}"), F.col(f"c{s}")
        sums += [(F.sum(a).over(upto) - a + F.sum(c).over(whole) - F.sum(c).over(upto)).alias(f"k{s}"), F.sum(a).over(whole).alias(f"t{s}")]
    placed = words.select("h", "first", "n", "place", *sums)
    gone = F.struct(F.col("place"), (F.col("n") - 1).alias("len"), "k1", "k2")
    full = F.struct(F.lit(0).alias("place"), F.col("n").alias("len"), F.col("t1").alias("k1"), F.col("t2").alias("k2"))
    both = placed.select("h", "first", F.explode(F.when(F.col("place") == 1, F.array(full, gone)).otherwise(F.array(gone))).alias("v"))
    return both.select("h", "first", "v.place", F.struct("v.len", "v.k1", "v.k2").alias("key"))


def _near_lines(docs: DataFrame, distinct: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """h of the distinct lines that have a near line whose first occurrence is earlier."""
    halves = distinct.select("h", F.explode("halves").alias("half"))
    met = halves.groupBy("half").agg(_several_lines().alias("several")).filter("several").select("half")
    names = stage(halves.join(met, "half", "left_semi").select("h").distinct().join(distinct.select("h", "first"), "h"), "candidates")
    wanted = names.select(F.col("first.doc").alias("doc"), F.col("first.line_no").alias("line_no"), "h", "first")
    of_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("line_no", "h")).alias("wanted"))
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    picked = rows.join(_small(of_doc, F.size("wanted")), "doc").withColumn("lines", F.split("text", "\n", -1))
    picked = picked.select("doc", "lines", F.explode("wanted").alias("w")).select(
        F.col("w.h").alias("h"), F.struct("doc", F.col("w.line_no").alias("line_no")).alias("first"), line_words(F.element_at("lines", F.col("w.line_no") + 1)).alias("words")
    )
    lines = stage(picked.dropDuplicates(["h"]), "lines")

    variants = stage(_deletion_keys(lines), "variants")
    shared = variants.groupBy("key").agg(_several_lines().alias("several")).filter("several").select("key")
    variants = stage(variants.join(shared, "key", "left_semi"), "shared")
    mine = F.struct("first", "h", "place")
    by_key = variants.groupBy("key").agg(F.min(mine).alias("any"), F.min(F.when(F.col("place") == 0, mine)).alias("whole"))
    by_place = variants.groupBy("key", "place").agg(F.min(mine).alias("same"))
    joined = variants.join(by_key, "key").join(by_place, ["key", "place"])
    other = F.when(F.col("place") == 0, F.col("any")).otherwise(F.least("same", F.coalesce("whole", "same")))
    found = joined.select("h", "place", "first", other.alias("o")).filter(F.col("o.first") < F.col("first"))
    found = found.groupBy("h").agg(F.min(F.struct(F.col("o.first").alias("first"), F.col("o.h").alias("h"), F.col("o.place").alias("place"), F.col("place").alias("mine"))).alias("o"))
    # The words decide, not the hashes.
    left = lines.select("h", F.col("words").alias("w"))
    right = lines.select(F.col("h").alias("oh"), F.col("words").alias("ow"))
    checked = found.join(left, "h").join(right, F.col("o.h") == F.col("oh"))
    return checked.filter(_without(F.col("w"), F.col("o.mine")) == _without(F.col("ow"), F.col("o.place"))).select("h")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Per document with any: doc and the sorted numbers (from 0) of its lines that have an equal or near line earlier."""
    lines = _numbered(docs, id_col, text_col).filter(F.size("words") >= min_words)
    n = F.size("words")
    lines = stage(lines.select("doc", "line_no", line_key(F.col("words"), n).alias("h"), _half_keys(F.col("words"), n).alias("halves")), "line_hashes")
    distinct = lines.groupBy("h").agg(F.min(F.struct("doc", "line_no")).alias("first"), F.max(F.struct("doc", "line_no")).alias("last"), F.min("halves").alias("halves"))
    distinct = stage(distinct, "distinct_lines")
    near = stage(_near_lines(docs, distinct, id_col, text_col), "near")
    judged = distinct.join(near.withColumn("near", F.lit(True)), "h", "left").filter(F.col("near") | (F.col("first") < F.col("last")))
    judged = stage(judged.select("h", "first", F.coalesce("near", F.lit(False)).alias("near")), "judged")
    gone = lines.select("doc", "line_no", "h").join(_small(judged), "h").filter(F.col("near") | (F.struct("doc", "line_no") != F.col("first")))
    return gone.groupBy("doc").agg(F.array_sort(F.collect_set("line_no")).alias("gone"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, counts: bool = False) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one, exactly or with one word changed; with ``counts`` also n_lines and n_removed.

    Earlier is a smaller id, or a smaller line number in the same document; all lines are judged on the input. Lines
    of fewer than ``min_words`` words stay. Lines end at line feeds; the kept ones are joined by line feeds again.
    Null texts stay null, an empty text is one line without words. Rows with a null id stay as they are and do not
    count. Rows that repeat an id with its text lose the same lines; different texts under one id are documents of
    their own, in the order of their hashes. Other columns stay as they are, whatever their names; with ``counts``
    columns of the two added names are replaced.
    """
    digest = F.xxhash64(text_col)
    several = docs.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(digest).alias("lo"), F.max(digest).alias("hi")).filter("lo <> hi")
    # Only where an id has several texts must the key tell them apart.
    key = F.col(id_col) if several.isEmpty() else F.when(F.col(id_col).isNotNull(), F.struct(F.col(id_col).alias("id"), digest.alias("digest")))
    keyed = docs.select(key.alias("_key"), F.col(text_col).alias("_text"))
    gone = stage(repeated_lines(keyed, "_key", "_text", min_words), "gone").withColumnsRenamed({"doc": "_doc", "gone": "_gone"})
    # The row travels as one value, so that no column of it meets a name used here.
    shaped = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_key"), F.col(text_col).alias("_text"))
    joined = shaped.join(_small(gone, F.size("_gone")), F.col("_key") == F.col("_doc"), "left")
    # A column of its own: written into the lambda below, the text would be split anew for every line.
    joined = joined.withColumn("_lines", F.when(F.lit(counts) | F.col("_gone").isNotNull(), F.split(F.col("_text"), "\n", -1)))
    lines = F.col("_lines")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    added = ("n_lines", "n_removed") if counts else ()
    out = joined.select(*[text.alias(c) if c == text_col else F.col(f"_row.`{c}`") for c in docs.columns if c not in added], *([
        F.when(F.col("_text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    ] if counts else []))
    return out
