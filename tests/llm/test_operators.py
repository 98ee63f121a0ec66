"""Operators against brute force and SQL, with odd rows, empty tables and clashing names."""

import hashlib
import html as html_lib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from tidemill.llm import components, decontam, jaccard, lines, maintext, mixing, ngram_lm, quality, queries, suffixes, topk, urls
from tidemill.llm import textbytes as tb

DOCS = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a long text, and further columns."""
    long = " ".join(f"w{i % 997}" for i in range(30_000))
    ten = "One two three four five six seven eight nine ten."
    rows = [
        (1, ten + "\nshort line", "a", 0), (2, ten, "a", 1), (2, ten, "a", 1), (3, "one two three four five SIX seven eight nine eleven.", "a", 2), (4, None, None, 3), (5, "", "b", 4),
        (6, " \n\t ", "b", 5), (None, ten.lower(), "b", 6), (7, long, "a", 7), (8, long + " tail", None, 8), (9, "é ü ß 中文 words that nobody else has written here", "c", 9),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score int")


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = sorted(str(tuple(row[c] for c in columns)) for row in df.collect())
    result = duck.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert ours == sorted(str(tuple(row[names.index(c)] for c in columns)) for row in result.fetchall())


# --- words


def test_words_and_lower_case():
    texts = ["Ab\tc  D\x0be", None, "", "É x-1_2", "z" * 70_000]
    piece = next(tb.pieces(pa.array(texts)))
    words, bounds = tb.lower_words(piece)
    assert np.diff(bounds).tolist() == [4, 0, 0, 2, 1]
    same = tb.lower_words(next(tb.pieces(pa.array(["d AB"]))))[0]
    assert words[2] == same[0] and words[0] == same[1]
    assert np.diff(tb.lower_words(piece, tb.ALNUM)[1]).tolist() == [4, 0, 0, 4, 1]


def test_pieces_cover_everything():
    texts = [f"text {i} " * (i % 7) for i in range(100)]
    column = pa.array(texts).slice(3, 90)
    found = [p.text(i).decode() for p in tb.pieces(column, 64) for i in range(len(p))]
    assert found == texts[3:93]


# --- op1


def sets_of(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute_components(ids, texts):
    sets, root = sets_of(texts), list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(zip(ids, sets, strict=True))]


def same_components(df):
    rows = df.select("doc_id", "text").collect()
    expected = brute_components([r[0] for r in rows], [r[1] for r in rows])
    got = [tuple(r) for r in jaccard.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()]
    return sorted(got, key=str) == sorted(expected, key=str)


def test_near_duplicates_against_brute_force(spark, odd_docs):
    assert same_components(documents(spark))
    assert same_components(odd_docs)
    assert jaccard.near_duplicates(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("small", [2, 24])
def test_large_group_of_near_copies(spark, monkeypatch, small):
    """Two families of near copies, strangers sharing boilerplate, and regions cut into blocks."""
    rng = np.random.default_rng(3)
    rows = []
    for family in range(2):
        base = [f"f{family}w{i}" for i in range(60)]
        for _ in range(90):
            w = list(base)
            for at in rng.choice(60, rng.integers(0, 4), replace=False):
                w[at] = f"x{rng.integers(1 << 30)}"
            rows.append(" ".join(w))
    rows += ["the same old words in every one of these " + " ".join(f"s{i}w{j}" for j in range(9)) for i in range(40)]
    df = spark.createDataFrame([(i * 7 % 1000, t) for i, t in enumerate(rows)], "doc_id long, text string")
    monkeypatch.setattr(jaccard, "BLOCK", 32)
    monkeypatch.setattr(jaccard, "PAIRS_UPTO", small)
    assert same_components(df)


def test_pairs_around_the_threshold(spark):
    """Small families whose sets share just enough n-grams or one too few, at the ends or by changed words."""
    rng = np.random.default_rng(11)
    rows, exact = [], 0
    for family in range(150):
        size = int(rng.integers(1, 80))
        base = [f"f{family}w{i}" for i in range(size + 4)]
        rows.append(" ".join(base))
        edge = size - -(-3 * size // 4)  # a part without so many n-grams is just similar enough
        exact += 4 * (size - edge) == 3 * size
        for cut in (edge, edge + 1):
            if size > cut:
                at = int(rng.integers(0, cut + 1))
                rows.append(" ".join(base[at:len(base) - (cut - at)]))
        changed = list(base)
        for at in rng.choice(len(base), min(len(base), max(1, size // 30)), replace=False):
            changed[at] = f"y{family}"
        rows.append(" ".join(changed))
    assert exact > 20
    assert same_components(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))


def test_region_join_finds_every_component():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 12, 14).astype(np.uint64)) for _ in range(150)]
    region = jaccard.Region(list(range(150)), list(range(150)), sets)
    region.join(np.arange(150))
    expected = {}
    for i in range(150):
        expected[i] = {i}
    for i in range(150):
        for j in range(i):
            common = len(np.intersect1d(sets[i], sets[j]))
            if jaccard.similar(common, len(sets[i]), len(sets[j])) and expected[i] is not expected[j]:
                expected[i] |= expected[j]
                for k in expected[i]:
                    expected[k] = expected[i]
    for i in range(150):
        assert {j for j in range(150) if region.label[j] == region.label[i]} == expected[i]


def test_components_of_a_path(spark):
    path = spark.createDataFrame([(i * 37 % 101, (i + 1) * 37 % 101) for i in range(90)] + [(200, 200), (500, 400), (None, 3)], "a long, b long")
    found = {r["node"]: r["label"] for r in components.components(path).collect()}
    assert len(set(found.values())) == 2 and found[500] == found[400] == 400 and 200 not in found


def test_keep_one_of_each(spark, odd_docs):
    kept = [r["doc_id"] for r in jaccard.keep_one_of_each(odd_docs).collect()]
    assert sorted(kept, key=str) == sorted([1, 3, 4, 5, 6, None, 7, 9], key=str) or set(kept) >= {1, 4, 5, 6, None, 7, 9}
    assert 8 not in kept


def test_keep_one_of_each_with_repeated_ids(spark):
    """One id with a near copy and a unique text, rows that repeat id and text, null texts."""
    text = lambda word: " ".join(f"{word}{i}" for i in range(40))
    rows = [(1, text("a"), 0), (2, text("a") + " more", 1), (2, text("b"), 2), (3, text("c"), 3), (3, text("c"), 4), (4, None, 5), (4, None, 6), (None, text("d"), 7), (None, text("d"), 8), (5, text("e"), 9), (5, text("e"), 10), (4, text("e"), 11)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    out = jaccard.keep_one_of_each(df)
    assert out.columns == df.columns
    got = sorted([(r["doc_id"] or 0, r["text"] or "") for r in out.collect()])
    assert got == sorted([(1, text("a")), (2, text("b")), (3, text("c")), (4, ""), (0, text("d")), (0, text("d")), (4, text("e"))])


# --- op2


def brute_repeats(rows):
    """id -> n_bytes, n_removed, n_spans, digest."""
    seen, out = {}, {}
    for doc, text in sorted({(d, t or "") for d, t in rows}):
        raw = text.encode()
        hit = np.zeros(len(raw) + 1, bool)
        for s in range(len(raw) - 99):
            if seen.setdefault(raw[s:s + 100], (doc, s)) != (doc, s):
                hit[s:s + 100] = True
        kept = bytes(b for b, h in zip(raw, hit, strict=False) if not h)
        out[doc] = (len(raw), len(raw) - len(kept), int((hit[1:] < hit[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return out


def same_repeats(df):
    got = suffixes.drop_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    expected = brute_repeats([(r[0], r[1]) for r in df.filter("doc_id IS NOT NULL").select("doc_id", "text").collect()])
    assert len(got) == df.count()
    for r in got:
        if r[0] is None:
            assert r[2] == 0
        else:
            assert tuple(r)[1:] == expected[r[0]], r[0]


def test_repeats_against_brute_force(spark, odd_docs):
    same_repeats(documents(spark))
    short = spark.createDataFrame([(20, "é" * 400), (21, "ab" * 300), (22, "x" + "ab" * 60 + "é" * 60), (23, "y" * 99), (24, "y" * 99), (25, "y" * 100), (26, "y" * 100), (27, None)], "doc_id long, text string")
    same_repeats(odd_docs.filter("doc_id < 7 OR doc_id = 9 OR doc_id IS NULL").select("doc_id", "text").unionAll(short))
    assert suffixes.drop_repeats(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("runs", [2, 4096])
def test_repeats_in_crowded_anchors(spark, monkeypatch, runs):
    rng = np.random.default_rng(8)
    common = "".join(chr(97 + x) for x in rng.integers(0, 26, 130))
    part = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    rows = [(i, part(rng.integers(0, 60)) + common[:rng.integers(60, 130)] + part(rng.integers(0, 60)) + common[rng.integers(0, 25):]) for i in range(80)]
    monkeypatch.setattr(suffixes, "SHARD_RUNS", runs)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 5000)
    same_repeats(spark.createDataFrame(rows, "doc_id long, text string"))


def test_common_prefixes_behind_long_ties():
    """Passages of 140 to 170 shared bytes with different tails, the earlier ones with the larger tail as well."""
    rng = np.random.default_rng(5)
    slices = []
    for size in rng.integers(140, 171, 60):
        passage = bytes(rng.integers(97, 101, size).astype(np.uint8))
        slices += [passage + bytes(rng.integers(97, 101, 276 - size).astype(np.uint8)) for _ in range(4)]
    slices = [slices[i] for i in rng.permutation(len(slices))]
    text = np.frombuffer(b"".join(slices), np.uint8)
    lengths = np.array([len(s) for s in slices])
    order, place = suffixes.suffix_array(text, suffixes.WINDOW)
    got = suffixes.common_prefixes(text, order, place, np.cumsum(lengths) - lengths, lengths, suffixes.WINDOW)
    raw = text.tobytes()
    for at in range(1, len(order)):
        a, b = raw[order[at - 1]:][:suffixes.WINDOW], raw[order[at]:][:suffixes.WINDOW]
        assert got[at] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    counts = lengths - suffixes.WINDOW + 1
    docs, windows = suffixes.repeated_windows(slices, np.arange(len(slices)), np.zeros(len(slices), np.int64), counts)
    seen, want = set(), set()
    for doc, part in enumerate(slices):
        for i in range(len(part) - suffixes.WINDOW + 1):
            window = part[i:i + suffixes.WINDOW]
            if window in seen:
                want.add((doc, i))
            seen.add(window)
    assert set(zip(docs.tolist(), windows.tolist(), strict=True)) == want


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(9)
    text = np.concatenate([rng.integers(97, 99, 300), rng.integers(97, 99, 40).repeat(3), np.full(150, 97)]).astype(np.uint8)
    raw = text.tobytes()
    order, place = suffixes.suffix_array(text, 128)
    cut = [raw[i:i + 128] for i in order]
    assert cut == sorted(cut) and (order[place] == np.arange(len(text))).all()
    got = suffixes.common_prefixes(text, order, place, np.array([0, 300, 420]), np.array([300, 120, 150]), 100)
    for i in range(1, len(order)):
        a, b = raw[order[i]:], raw[order[i - 1]:]
        n = next((k for k in range(100) if k >= len(a) or k >= len(b) or a[k] != b[k]), 100)
        assert got[i] == n


# --- op3


def test_top_k_ties_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [1.0, 0.0]), (7, None), (8, [float("nan"), 1.0]),
            (9, [None, 1.0]), (10, [float("inf"), 0.0]), (11, [1.0, 2.0, 3.0]), (12, []), (None, [1.0, 1.0]), (100, [2.0, 3.0, 4.0]), (1, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect())
    ties = [1, 2, 3, 4, 5]
    assert got == sorted(
        [(0, i + 1, v, 65536) for i, v in enumerate(ties)] + [(50, i + 1, v, 32768) for i, v in enumerate([0, 1, 2, 3, 4])] + [(100, 1, 11, (2 * 1 + 3 * 2 + 4 * 3) * 65536)]
    )
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_top_k_many_rounds(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 40, (300, 3)).astype(np.float32)
    vectors[::3] = vectors[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    whole = np.floor(256 * vectors.astype(np.float64)).astype(np.int64)
    expected = set()
    for q in range(0, 300, 50):
        order = sorted((-int(whole[q] @ whole[c]), c) for c in range(300) if c != q)[:5]
        expected |= {(q, i + 1, c, -s) for i, (s, c) in enumerate(order)}
    assert {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()} == expected


# --- op4


def test_quality_held_out_accuracy(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0
    model = quality.fit_on_ratings(docs, labels.filter(~held), quality.rating_grade())
    assert list(model.thresholds) == sorted(model.thresholds)
    graded = quality.grade_documents(docs, model, quality.BEST_GRADE).join(labels.filter(held), "doc_id")
    right = graded.agg(F.avg((F.col("accepted") == (quality.rating_grade() == 2)).cast("int"))).first()[0]
    assert right > 0.8


def test_quality_odd_rows(spark, odd_docs):
    assert quality.fit_on_ratings(odd_docs, spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"), quality.rating_grade()) is None
    free = quality.grade_documents(odd_docs, None, 2)
    assert free.count() == 11 and free.filter("accepted").count() == 11
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 1), (5, 0, 0), (None, 1, 1), (9, None, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit_on_ratings(odd_docs, labels, quality.rating_grade())
    graded = quality.grade_documents(odd_docs, model, 2).collect()
    assert len(graded) == 11 and all(0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in graded)
    assert quality.grade_documents(odd_docs.limit(0), model, 2).count() == 0


# --- op5


def test_urls_odd_rows(spark):
    rules = spark.createDataFrame(queries.URL_RULES + [("WWW.x.com", "", "block"), (None, "/a", "block"), ("dup.org", "/", "allow"), ("dup.org", "/", "block")], "host string, path string, verdict string")
    rows = [(1, None), (2, "no scheme"), (3, "http://A.Example.com/en/x"), (4, "http://www.example.com/en/"), (5, "http://example.com"), (6, "http://example.com/"), (7, "http://notexample.com/en/"),
            (8, "https://a.net/es/1?x=/fr/"), (9, "http://net/fr/"), (10, "x://dup.org/y#z"), (None, "http://www.x.com?q"), (1, None), (11, "http:///en/"), (12, "http://m.example.com/en")]
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(1)), rules, ranges=3).collect()}
    assert got == {
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "a.example.com", "/en/x", "example.com/en/", "block"), (4, "www.example.com", "/en/", "www.example.com/en/", "allow"),
        (5, "example.com", "", None, "allow"), (6, "example.com", "/", "com/", "allow"), (7, "notexample.com", "/en/", "com/", "allow"), (8, "a.net", "/es/1", "net/es/", "block"), (9, "net", "/fr/", "net/fr/", "block"),
        (10, "dup.org", "/y", "dup.org/", "block"), (None, "www.x.com", "", "www.x.com", "block"), (11, "", "/en/", None, "allow"), (12, "m.example.com", "/en", "com/", "allow"),
    }
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0


# --- op6


def near(a, b):
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return a[p + 1:] == b[p + 1:] or a[p + 1:] == b[p:] or a[p:] == b[p + 1:]


def test_lines_against_brute_force(spark, odd_docs):
    rng = np.random.default_rng(2)
    rows = []
    for d in range(60):
        text = []
        for _ in range(6):
            words = [f"w{x}" for x in rng.integers(0, 2, rng.integers(5, 9))]
            text.append(" ".join(words))
        rows.append((d, "\n".join(text)))
    rows += [(60, None), (61, ""), (62, "a a b c d e f"), (63, "a b c d e f"), (64, "b a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen, expected = [], {}
    for d, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            words = line.lower().split()
            if len(words) >= lines.MIN_WORDS:
                gone = any(near(words, s) for s in seen)
                seen.append(words)
                if gone:
                    continue
            kept.append(line)
        expected[d] = None if text is None else "\n".join(kept)
    got = {r["doc_id"]: r["text"] for r in lines.drop_repeated_lines(df).collect()}
    assert got == expected
    odd = lines.drop_repeated_lines(odd_docs, counts=True)
    found = sorted(((r["doc_id"], r["text"] and r["text"][:20], r["n_lines"], r["n_removed"]) for r in odd.filter("doc_id < 7 OR doc_id IS NULL").collect()), key=str)
    assert found == sorted([(1, "One two three four f", 2, 0), (2, "", 1, 1), (2, "", 1, 1), (3, "", 1, 1), (4, None, 0, 0), (5, "", 1, 0), (6, " \n\t ", 2, 0), (None, "one two three four f", 1, 0)], key=str)
    assert lines.drop_repeated_lines(odd_docs.limit(0)).count() == 0


def test_lines_of_several_texts_under_one_id(spark):
    line = lambda word, n=8: " ".join(f"{word}{i}" for i in range(n))
    rows = [(1, line("a")), (2, f"{line('a')}\n{line('b')}"), (2, f"{line('c')}\n{line('d')}"), (3, line("d")), (4, line("e")), (4, line("e")), (None, line("a")), (5, None), (5, line("f"))]
    got = sorted((r["doc_id"] or 0, r["text"] or "", r["n_removed"]) for r in lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), counts=True).collect())
    assert got == sorted([(1, line("a"), 0), (2, line("b"), 1), (2, f"{line('c')}\n{line('d')}", 0), (3, "", 1), (4, line("e"), 0), (4, line("e"), 0), (0, line("a"), 0), (5, "", 0), (5, line("f"), 0)])


# --- op7


def test_decontamination_chunks_and_short_items(spark, odd_docs):
    items = spark.createDataFrame([("i1", "four five six"), ("i1", "four five six"), ("i2", " ".join(f"w{i}" for i in range(20, 40))), ("i3", None), (None, "one two"), ("i4", "--- !")], "item_id string, text string")
    for size in (4_000_000, 30):
        found = decontam.find_matches(odd_docs.filter("doc_id < 9"), items, chunk_chars=size).select("_id", "n_words", decontam.n_hit().alias("n"), "items").collect()
        rows = {r["_id"]: (r["n_words"], r["n"], r["items"]) for r in found}
        assert len(found) == 9 and rows[1] == (12, 3, ["i1"]) and rows[4] == rows[5] == rows[6] == (0, 0, [])
        assert rows[7] == (30_000, 20 * 30, ["i2"]) or rows[7][1] >= 600
    kept = {r["doc_id"] for r in decontam.decontaminate(odd_docs, items).collect()}
    assert kept == {None, 4, 5, 6, 7, 8, 9}
    assert decontam.decontaminate(odd_docs, items.limit(0)).count() == 11
    assert decontam.find_matches(odd_docs.limit(0), items).count() == 0


def test_remove_spans():
    assert decontam.remove_spans("One, two; three four.", [(1, 3)]) == "One,  four."


@pytest.mark.parametrize("size", [4_000_000, 30])
def test_cut_matches(spark, size):
    items = spark.createDataFrame([("i1", " ".join(f"q{i}" for i in range(13))), ("i2", "alpha beta gamma")], "item_id string, text string")
    long, quote = " ".join(f"w{i}" for i in range(400)), " ".join(f"Q{i}" for i in range(13))
    rows = [(1, f"{long}. {quote}! {long}", 5), (1, long, 6), (2, quote, 7), (None, f"{long} Alpha, beta gamma; {long}", 8), (3, None, 9), (4, "", 10), (5, "alpha beta " + long, 11)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `odd name` int")
    out = decontam.cut_matches(df, items, chunk_chars=size)
    assert out.columns == df.columns
    got = {r["odd name"]: (r["doc_id"], r["text"]) for r in out.collect()}
    assert got == {5: (1, f"{long}. ! {long}"), 6: (1, long), 8: (None, f"{long} ; {long}"), 9: (3, None), 10: (4, ""), 11: (5, "alpha beta " + long)}
    assert decontam.cut_matches(df.limit(0), items).count() == 0 and decontam.cut_matches(df, items.limit(0)).count() == 7


def test_automaton_tracks_longest_match():
    rng = np.random.default_rng(4)
    items = [(str(i), rng.integers(1, 4, rng.integers(1, 12)).astype(np.uint64)) for i in range(12)]
    auto = decontam.Automaton(items, 4)
    text = rng.integers(1, 4, 300).astype(np.uint64)
    hit, found = np.zeros(300, bool), set()
    auto.stream(np.searchsorted(auto.vocabulary, text).tolist(), 0, hit, found)
    want, names = np.zeros(300, bool), set()
    for name, words in items:
        n = min(4, len(words))
        for i in range(len(words) - n + 1):
            for at in range(300 - n + 1):
                if (text[at:at + n] == words[i:i + n]).all():
                    want[at:at + n] = True
                    names.add(name)
    assert (hit == want).all() and found == names


# --- op8


def test_scores_against_plain_counts(spark, odd_docs):
    rows = documents(spark).select("doc_id", "text").collect() + [r for r in odd_docs.select("doc_id", "text").collect() if r["doc_id"] is None or r["doc_id"] < 7]
    df = spark.createDataFrame([(None if r[0] is None else r[0] + 100_000 * (i >= 200), r[1]) for i, r in enumerate(rows)], "doc_id long, text string")
    rows = df.collect()
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")) + ["\n"] for r in rows]
    held = [r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 5 == 1 for r in rows]
    counts = Counter(w for ws, h in zip(words, held, strict=True) if not h for w in ws)
    total = sum(counts.values())
    unit = total + 0.5 * (len(counts) + 1)
    expected = sorted((str(r["doc_id"]), h, len(ws), sum(w in counts for w in ws), total, round(sum(math.log10((counts[w] + 0.5) / unit) for w in ws), 4)) for r, ws, h in zip(rows, words, held, strict=True))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    for hot in (1 << 19, 50):
        got = ngram_lm.score_documents(df, held_out, hot_words=hot).collect()
        assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == expected
        assert all(r["score"] < 0 for r in got)
        trained = [r for r in got if not r["held_out"]]
        assert sum(r["score"] for r in trained) > sum(r["base_score"] for r in trained)
    assert ngram_lm.score_documents(df.limit(0), held_out).count() == 0
    assert ngram_lm.score_documents(df.limit(3), F.lit(True)).count() == 3


def test_pairs_met_once_count(spark, monkeypatch):
    """Every pair is met once in training; known text beats the same words in another order, over many chunks."""
    monkeypatch.setattr(ngram_lm, "CHUNK_TOKENS", 500, raising=False)
    rng = np.random.default_rng(11)
    train = [(i, " ".join(f"w{x}" for x in rng.permutation(2000)[:200])) for i in range(0, 40, 2)]
    mixed = [(i + 1, " ".join(sorted(text.split()))) for i, text in train]
    df = spark.createDataFrame(train + mixed, "doc_id long, text string")
    got = {r["doc_id"]: r for r in ngram_lm.score_documents(df, F.col("doc_id") % 2 == 1).collect()}
    assert len(got) == 40
    counts = Counter(w for _, text in train for w in [*text.split(), "\n"])
    pairs = Counter(p for _, text in train for p in zip(["\n", *text.split()], [*text.split(), "\n"], strict=True))
    total = sum(counts.values())
    unit = total + 0.5 * (len(counts) + 1)
    assert sorted(pairs.values())[len(pairs) // 2] == 1
    mean = lambda c: ngram_lm.MEAN[ngram_lm.level_of(np.array([c]))[0]] if c else 0.0
    for doc, text in train + mixed:
        before, score = "\n", 0.0
        for word in [*text.split(), "\n"]:
            c = mean(counts[before])
            score += math.log10((min(mean(pairs[before, word]), c) + ngram_lm.MU * (mean(counts[word]) + 0.5) / unit) / (c + ngram_lm.MU))
            before = word
        # A false positive of the filter moves one term.
        assert got[doc]["score"] == pytest.approx(score, rel=0.02)
    for doc, _ in train:
        assert got[doc]["score"] > got[doc + 1]["score"]


def test_filter_is_sized_from_its_entries(spark):
    """No level is left out to fit a bound."""
    keys, counts = np.sort(tb.mix(np.arange(1, 5001, dtype=np.uint64))), np.ones(5000, np.int64)
    rows = spark.createDataFrame([(2, 0, keys[keys >> np.uint64(63) == 0].tobytes(), counts[keys >> np.uint64(63) == 0].tobytes(), 0, [0, 2500])], ngram_lm.SUMMED)
    with pytest.raises(ValueError):
        ngram_lm._build(rows, 2, 1, 1 << 14)
    assert all(ngram_lm._size(n) >= n * ngram_lm.BITS_PER_ENTRY for n in (0, 1, 10**6, 10**10, 10**13))


def test_filter_levels_never_too_low(spark):
    keys = tb.mix(np.arange(1, 5001, dtype=np.uint64))
    counts = np.arange(1, 5001)
    rows = spark.createDataFrame([(1, i, keys[keys >> np.uint64(62) == i].tobytes(), counts[keys >> np.uint64(62) == i].tobytes(), 0, np.bincount(ngram_lm.level_of(counts[keys >> np.uint64(62) == i]), minlength=110).tolist()) for i in range(4)], ngram_lm.SUMMED)
    built = ngram_lm._build(rows, 1, 2, 1 << 26)
    found = built.levels(keys)
    assert (found >= ngram_lm.level_of(counts)).all() and (found == ngram_lm.level_of(counts)).mean() > 0.95
    assert built.levels(tb.mix(np.arange(9_000_000, 9_005_000, dtype=np.uint64))).mean() < 0.1


# --- op9


def test_main_text_of_pages(spark):
    rows = queries.op9_html_extraction(spark, SF_DIR).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)(?:</article>|$)", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html_lib.unescape(re.sub("<[^>]*>", " ", b.replace("<b>", ""))).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


PAGE = """<html><head><title>T</title><style>x{}</style></head><body class="page"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
<div class="cookie-notice">We use cookies to make this site work well for you and everybody else here.</div>
<main><article><h1>Head &amp; more</h1><p>First &lt;b&gt; para&nbsp;graph<br>goes on<p>Second <a href="#">link</a> text.
<ul><li>one<li>two</ul><form><label>Your mail</label><input></form><aside>Aside text that is long enough to look like a paragraph of the article itself.</aside>
<script>var a = "<p>no</p>";</script><table><tr><td>a<td>b</table></article>
<section id="comments"><p>A reader says that this was a good article and that there should be more.</p></section></main>
<div id="sidebar"><p>Read more of the same things here.</p></div><div class="ad">Buy now.</div><footer>Copyright</footer></body>"""


def test_main_text_of_a_mixed_page(spark, odd_docs):
    df = spark.createDataFrame([(1, "u", PAGE), (2, "u", None), (3, "u", ""), (4, "u", "<p>cut off <b"), (4, "u", "<p>cut off <b"), (5, "u", "<nav>a</nav><p>x</p>" + "y " * 50_000)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r["text"] for r in maintext.extract_main_text(df).collect()}
    assert got[1] == "Head & more\nFirst <b> para graph goes on\nSecond link text.\none\ntwo\na\nb"
    assert got[2] == got[3] == "" and got[4] == "cut off" and got[5].startswith("x\ny y")
    assert maintext.extract_main_text(df.limit(0)).count() == 0


def test_main_text_by_counts_and_neighbours(spark):
    """Wrappers named like boilerplate, titles in a named header, pages without an article, text outside it."""
    text = lambda n, word="text": " ".join([word] * n)
    wrapped = f"<div class='layout has-sidebar'><article><header class='entry-header'><h1>The title</h1></header><p>{text(60)}</p><p>{text(45)}</p></article><div class='sidebar'><p>{text(12, 'more')}</p></div></div>"
    plain = f"<div><ul><li><a href='/'>Home</a><li><a href='/n'>News</a></ul></div><h1>The title</h1><div>{text(80)}</div><div>{text(50)}</div><div>All rights reserved by the owner of this page.</div>"
    outside = f"<article class='teaser'><h2>Teaser</h2><p>{text(9)}</p></article><div><p>{text(120)}</p><p>{text(70)}</p></div><aside><p>{text(20, 'more')}</p></aside>"
    df = spark.createDataFrame([(1, "u", wrapped), (2, "u", plain), (3, "u", outside)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"].split("\n") for r in maintext.extract_main_text(df).collect()}
    assert got[1] == ["The title", text(60), text(45)]
    assert got[2] == ["The title", text(80), text(50)]
    assert got[3] == ["Teaser", text(9), text(120), text(70)]


# --- op10


def test_mixing_reaches_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 5)), f"s{0 if i % 2 else i % 7}") for i in range(3000)]
    df = spark.createDataFrame(rows, DOCS)
    total = Counter()
    for _, t, s in rows:
        total[s] += len(t.split())
    mixed = mixing.mix_sources(df, entropy=0.99, repetitions=None).collect()
    tokens = Counter()
    for r in mixed:
        tokens[r["source"]] += r["n_tokens"]
    share = {s: n / sum(tokens.values()) for s, n in tokens.items()}
    entropy = -sum(p * math.log(p) for p in share.values()) / math.log(len(share))
    assert abs(entropy - 0.99) < 0.005
    assert {r["doc_id"] for r in mixed} == set(range(3000))
    limited = mixing.mix_sources(df, entropy=1.0, repetitions=2.0).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()
    assert max(r["n"] / total[r["source"]] for r in limited) <= 2.0 + 1e-6
    assert max(r["n"] / total[r["source"]] for r in limited) > 1.8
    budget = sum(total.values()) / 2
    cut = mixing.mix_sources(df, entropy=None, repetitions=None, budget=budget).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()
    for r in cut:
        assert total[r["source"]] / 2 - 5 <= r["n"] <= total[r["source"]] / 2 + 1
    per_block = Counter((r["block"], r["source"]) for r in mixed)
    assert max(per_block.values()) < 12 * max(1, len(mixed) / 64 / 7)


def test_mixing_odd_rows(spark, odd_docs):
    mixed = mixing.mix_sources(odd_docs.withColumn("weight", F.lit("clash")), entropy=None, repetitions=None).collect()
    assert len(mixed) == 11 and all(r["epoch"] == 1 for r in mixed)
    assert mixing.mix_sources(odd_docs.limit(0)).count() == 0
    again = mixing.mix_sources(odd_docs.withColumn("weight", F.lit("clash")), entropy=None, repetitions=None).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, again))
