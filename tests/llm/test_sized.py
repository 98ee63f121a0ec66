"""Operators whose parts follow the size of the input: the result stays the same with any number of them."""

from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import decontam, lines, quality, queries, topk, urls


def test_top_bins_complete_k():
    counts = np.array([[3, 0, 2, 4, 1], [0, 0, 0, 0, 2], [9, 0, 0, 0, 0], [0, 0, 0, 0, 0]], np.int64)
    got = topk._top_bins(np.array([7, 8, 9, 10]), counts, 5).to_pylist()
    assert [(r["id"], r["bin"], r["n"]) for r in got] == [(7, 3, 4), (7, 4, 1), (8, 4, 2), (9, 0, 9)]


@pytest.mark.parametrize("per_slot,per_block,held", [(1 << 20, 4096, 16), (10, 8, 1), (64, 16, 2)])
def test_top_k_with_any_number_of_slots(spark, monkeypatch, per_slot, per_block, held):
    monkeypatch.setattr(topk, "ROWS_PER_SLOT", per_slot)
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", per_block)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 3)
    monkeypatch.setattr(topk, "HELD", held)
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 9, (400, 4)).astype(np.float32)
    vectors[100:250] = vectors[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    whole = np.floor(256 * vectors.astype(np.float64)).astype(np.int64)
    expected = set()
    for q in range(0, 400, 50):
        order = sorted((-int(whole[q] @ whole[c]), c) for c in range(400) if c != q)[:5]
        expected |= {(q, i + 1, c, -s) for i, (s, c) in enumerate(order)}
    assert {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()} == expected


@pytest.mark.parametrize("per_range,sampled", [(1_000_000, 100), (5, 100), (20, 1)])
def test_urls_with_any_number_of_ranges(spark, monkeypatch, per_range, sampled):
    monkeypatch.setattr(urls, "URLS_PER_RANGE", per_range)
    monkeypatch.setattr(urls, "RANGES", 2)
    monkeypatch.setattr(urls, "SAMPLED", sampled)
    hosts = ["example.com", "www.example.com", "a.www.example.com", "b.net", "net", "other.org", "exämple.com", "\U0001f600.com"]
    paths = ["/en/", "/en/a", "/es/", "/fr/x", "/", ""]
    rows = [(i, f"https://{hosts[i % 8] if i % 3 else hosts[0]}{paths[i % 5]}?{i}") for i in range(300)]
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()

    def plain(url):
        host, _, rest = url.partition("://")[2].partition("/")
        host, path = host.split("?")[0], ("/" + rest).split("?")[0] if "/" in url.partition("://")[2] else ""
        fits = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1:] if fits else (None, "allow")

    assert len(got) == 300
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in got} == {i: plain(u) for i, u in rows}


def test_automaton_is_built_once_for_a_worker():
    chunk = SimpleNamespace(value=[("a", "one two three")])
    first = decontam._automaton("x", chunk, 2)
    assert decontam._automaton("x", chunk, 2) is first
    other = decontam._automaton("y", chunk, 2)
    assert other is not first and list(decontam._built) == ["y"]


def test_matches_of_two_benchmarks_do_not_mix(spark):
    """Workers run on from one set of items to the next."""
    docs = spark.createDataFrame([(1, "p q r s t"), (2, "u v w x y")], "doc_id long, text string")
    for text, hits in (("q r s", {1: 3, 2: 0}), ("v w", {1: 0, 2: 2}), ("q r s", {1: 3, 2: 0})):
        items = spark.createDataFrame([("i", text)], "item_id string, text string")
        got = decontam.find_matches(docs, items, window=2).select("_id", decontam.n_hit().alias("n")).collect()
        assert {r["_id"]: r["n"] for r in got} == hits


@pytest.mark.parametrize("size,rows", [(1 << 20, 100), (1 << 20, 7), (400, 100), (3, 100)])
def test_rated_sample_within_rows_and_bytes(spark, size, rows):
    """One id holds most rows; the rows that fit are the first in the order, whatever the partitions."""
    rated = [(i % 3, f"d{i}", bytes(range(4 * (1 + i % 9)))) for i in range(40)] + [(1, "hot", bytes(24))] * 200
    df = spark.createDataFrame(rated, "grade int, id string, slots binary")
    got = quality._first_rows(df.repartition(5), rows, size).collect()
    order = df.select("*", F.xxhash64("id").alias("hash"), F.sha2("slots", 256).alias("digest")).orderBy("hash", "id", "grade", "digest").collect()
    expected, used = [], 0
    for r in order[:rows]:
        used += len(r["slots"])
        if used > size:
            break
        expected.append((r["grade"], r["id"], bytes(r["slots"])))
    assert sorted((r["grade"], r["id"], bytes(r["slots"])) for r in got) == sorted(expected)
    assert quality._first_rows(df.limit(0), rows, size).count() == 0


def test_fit_takes_no_more_than_its_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(50)) + (" good" if i % 2 else " bad")) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality, "fit_ordinal", lambda texts, grades, bits: seen.append((len(texts), sum(4 * len(t) for t in texts))))
    quality.fit_on_ratings(docs, labels, quality.rating_grade())
    quality.fit_on_ratings(docs, labels, quality.rating_grade(), size=6_000)
    (whole, _), (part, held) = seen
    assert whole == 60 and 1 < part < 60 and held <= 6_000


@pytest.mark.parametrize("constant", ["a", "b"])
def test_lines_tell_apart_by_either_half_of_the_key(spark, monkeypatch, constant):
    """With one half of the key alike for all lines, the other one still keeps different lines apart."""
    real = lines.line_key
    rows = [(d, "\n".join(f"line {d % 7} of {k} holds word w{d * k % 11} and more" for k in range(5))) for d in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted(tuple(r) for r in lines.drop_repeated_lines(df, counts=True).collect())
    monkeypatch.setattr(lines, "line_key", lambda words, n: real(words, n).withField(constant, F.lit(1).cast("long")))
    assert sorted(tuple(r) for r in lines.drop_repeated_lines(df, counts=True).collect()) == expected
    assert any(r[3] for r in expected)
