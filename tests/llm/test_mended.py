"""Cases that once failed: page structure, names that clash, long vectors, and the pipeline as a whole."""

import time

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from tidemill.llm import jaccard, lines, maintext, mixing, suffixes, topk
from tidemill.llm import textbytes as tb
from test_operators import odd_docs  # noqa: F401


@pytest.fixture(scope="module")
def tree(spark):
    return maintext.fit_tree(spark)


LONG = "This paragraph is long enough to be read as a part of the article by anybody who looks at it, and then some more words follow here."


@pytest.mark.parametrize("page", [
    f"<html><head><title>t</title><body><article><h1>Head</h1><p>{LONG}</article>",
    f"<head><meta charset=x><style>a</style><article><h1>Head</h1><p>{LONG}</article>",
    f"<article><h1>Head</h1><svg><path d=1><p>{LONG}</article>",
    f"<article><h1>Head</h1><canvas><p>{LONG}</article>",
    f"<article><h1>Head</h1><select><option>one<option>two<p>{LONG}</article>",
    f"<article><h1>Head</h1><object data=x><p>{LONG}</article>",
])
def test_open_ends_lose_nothing(tree, page):
    assert maintext.main_text(page, tree) == f"Head\n{LONG}"


def test_closed_hidden_elements_stay_hidden(tree):
    page = f"<article><h1>Head</h1><select><option>one<option>two</select><svg><text>no</text><foreignObject><div>no</div></foreignObject></svg><canvas>no</canvas><p>{LONG}</article>"
    assert maintext.main_text(page, tree) == f"Head\n{LONG}"


def test_linked_items_of_the_article_stay(tree):
    items = ["first linked item here", "second linked item", "third one"]
    page = f"<nav><ul><li><a href=/>Home</a><li><a href=/b>More</a></ul></nav><article><h1>Head</h1><p>{LONG}<ul>" + "".join(f"<li><a href=/x>{i}</a>" for i in items) + f"</ul><p>{LONG}</article>"
    assert maintext.main_text(page, tree) == "\n".join(["Head", LONG, *items, LONG])


def test_comments_behind_the_article_go(tree):
    comment = "I read all of this and I think that the writer has a point, although I would have put it in other words than these ones are."
    page = f"<article><h1>Head</h1><p>{LONG} {LONG}<p>{LONG}<p>{LONG} {LONG}</article><div class='user-posts'><p>{comment}<p>{comment}</div>"
    assert maintext.main_text(page, tree) == f"Head\n{LONG} {LONG}\n{LONG}\n{LONG} {LONG}"


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<div class=ad>" * 100_000 + "x", "<p>a" * 30_000, "<svg>" * 100_000 + "x", "<div><a>" * 50_000 + "x", "<li>" * 100_000 + "x"])
def test_nesting_costs_no_more_than_its_length(page):
    start = time.perf_counter()
    maintext.text_blocks(page)
    assert time.perf_counter() - start < 10  # seconds, where a search for each element took minutes


NAMES = [
    "rest", "low", "whole", "cut", "passes", "p_src", "src", "total", "_row", "_h", "_id", "_text", "_html", "_key", "_doc", "_gone", "gone", "doc", "_digest", "_judged_id", "_judged_digest",
    "n_tokens", "weight", "epoch", "block", "place", "n_lines", "n_removed", "label", "key", "_",
]


def test_names_of_other_columns_do_not_matter(spark, odd_docs):  # noqa: F811
    plain = odd_docs.drop("score")
    named = plain.select("*", *[F.lit(f"own {n}").alias(n) for n in NAMES])

    def same(operator, added=()):
        few, many = operator(plain), operator(named)
        kept = [n for n in NAMES if n not in added]
        columns = [c for c in few.columns if c not in kept]
        assert sorted(map(str, few.select(columns).collect())) == sorted(map(str, many.select(columns).collect()))
        rows = many.select(kept).distinct().collect()
        assert len(rows) == 1 and all(rows[0][n] == f"own {n}" for n in kept)

    same(mixing.mix_sources, ["n_tokens", "weight", "epoch", "block", "place"])
    same(lines.drop_repeated_lines)
    same(lambda d: lines.drop_repeated_lines(d, counts=True), ["n_lines", "n_removed"])
    same(jaccard.keep_one_of_each)
    same(lambda d: maintext.extract_main_text(d.withColumn("page", F.concat(F.lit("<p>"), "text")), "page", "main"))


def test_long_vectors(spark):
    """Components whose bound, not whose score, leaves 64 bits; against plain whole numbers."""
    rng = np.random.default_rng(3)
    rows = [(0, [1e12, 0.0, 1.0]), (50, [0.0, 1e12, 2.0]), (51, [0.0, -10.0, 0.5])] + [(i, [float(v) for v in rng.normal(size=3)]) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()]
    ints = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    expected = []
    for q in (0, 50):
        scores = sorted(((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q and abs(sum(a * b for a, b in zip(ints[q], v))) < 2**63))[:5]
        expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    assert sorted(got) == sorted(expected)


def test_copies_of_sets_change_nothing(spark, monkeypatch):
    """Near copies dealt to many tasks, with rows that repeat id and text: joined with and without a broadcast."""
    rng = np.random.default_rng(5)
    base = [[f"t{t}w{i}" for i in range(80)] for t in range(6)]
    rows = []
    for i in range(240):
        w = list(base[i % 6])
        for at in rng.choice(80, 2, replace=False):
            w[at] = f"x{rng.integers(40)}"
        rows += [(i, " ".join(w))] * (1 + i % 3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    few = sorted(tuple(r) for r in jaccard.near_duplicates(df).collect())
    monkeypatch.setattr(jaccard, "MOST_PAIRS", 0)
    assert few == sorted(tuple(r) for r in jaccard.near_duplicates(df).collect())


def test_spans_by_broadcast_and_by_shuffle(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    few = sorted(tuple(r) for r in suffixes.drop_repeats(docs).drop("kept").collect())
    monkeypatch.setattr(suffixes, "SMALL_BYTES", 0)
    monkeypatch.setattr(tb, "PIECE_BYTES", 1 << 18)
    assert few == sorted(tuple(r) for r in suffixes.drop_repeats(docs).drop("kept").collect())


# --- the pipeline


def test_pipeline_runs_its_stages_in_order(spark, monkeypatch):
    """Each stage gets what the one before returned, with the columns of documents, and none adds or changes ids."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = []

    def watched(name, function):
        def run(spark, given, sf_dir):
            out = function(spark, given, sf_dir)
            seen.append((name, given.columns, out.columns, given.count()))
            return out

        return name, run

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights"]
    monkeypatch.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
    made = corpus_pipeline.run(spark, SF_DIR)
    assert [s[0] for s in seen] == names
    assert all(s[1] == docs.columns for s in seen) and all(s[2] == docs.columns for s in seen[:-1])
    counts = [s[3] for s in seen]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * docs.count()
    assert made.select("doc_id").distinct().count() == counts[-1]
    assert made.join(docs, "doc_id", "left_anti").isEmpty()


@pytest.mark.parametrize("stage", range(1, 5))
def test_stages_on_odd_rows(spark, stage):
    """Nulls, empty texts, repeated rows, clashing names and an empty table go through every stage but the fitted one."""
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text, "en", "a", 62), (1, text, "en", "a", 62), (2, text, "en", None, 62), (3, None, None, "b", None), (4, "", "en", "b", 0), (None, text, "en", "a", 62)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("rest", F.lit("r")).withColumn("_gone", F.lit("g"))
    _, function = corpus_pipeline.STAGES[stage]
    out = function(spark, docs, SF_DIR)
    assert out.count() >= 3 and {r["rest"] for r in out.select("rest").collect()} == {"r"}
    assert function(spark, docs.limit(0), SF_DIR).count() == 0


def test_small_regions_are_paired_at_once():
    """Regions of two to thirty classes give the pairs and rows that they gave one by one, without a step of Python for each."""
    r = np.random.default_rng(3)
    lengths = np.concatenate([r.integers(1, 31, 300), np.full(60_000, 3)])
    gram = np.repeat(np.arange(len(lengths)), lengths)
    rows = [gram, np.arange(len(gram)) * 7, r.integers(20, 28, len(gram)).astype(np.int32), r.integers(0, 24, len(gram)).astype(np.int8)]
    table = pa.table(rows, names=["gram", "key", "n", "before"])
    start = time.perf_counter()
    found = list(jaccard._regions(iter(table.to_batches(max_chunksize=10_000))))
    assert time.perf_counter() - start < 1.2  # seconds, where a step for each region took several
    got = {tuple(x) for b in found for x in zip(*[c.to_pylist() for c in b.columns], strict=True)}
    few = int(lengths[:300].sum())
    expected = set()
    for s, m in zip(np.cumsum(lengths[:300]) - lengths[:300], lengths[:300], strict=True):
        for i in range(s, s + m if m <= jaccard.PAIRS_UPTO else s):
            for j in range(i + 1, s + m):
                (ni, nj), (li, lj) = ([int(rows[2][x]) for x in (i, j)], [int(rows[2][x]) * (100 - int(rows[3][x])) // 100 for x in (i, j)])
                if min(ni, nj) * 100 >= max(ni, nj) * 75 and jaccard.similar(min(li, lj), ni, nj):
                    expected.add((0, int(rows[1][i]), int(rows[1][j])))
    large = {int(rows[1][x]) for s, m in zip(np.cumsum(lengths[:300]) - lengths[:300], lengths[:300], strict=True) if m > jaccard.PAIRS_UPTO for x in range(s, s + m)}
    assert {x for x in got if x[0] == 0 and x[1] < 7 * few and x[1] not in large} == expected
    assert {x[2] for x in got if x[0] == 1} == large
