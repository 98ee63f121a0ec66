"""Statistics, series, models and texts against brute force or planted answers."""

import datetime as dt
import math
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidemill.functions.stemming import porter, snowball, stem_tokens
from tidemill.functions.tails import chi2_tail, f_tail, t_tail_two_sided
from tidemill.functions.tokens import STOP_WORDS, basic_tokens, digit_split
from tidemill.operators import linear, stats
from tidemill.operators import text as X
from tidemill.operators import timeseries as TS
from tidemill.plans import load_all, texts
from tidemill.plans.registry import QUERIES, TWINS

load_all()


def month(i):
    return dt.date(2000 + i // 12, i % 12 + 1, 1)


def series_frame(spark, named):
    rows = [(n, month(i), float(v)) for n, y in named.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "series_id string, t date, y double")


def planted_ar(n=240):
    r = np.random.default_rng(1)
    y = [50.0, 52.0]
    for _ in range(n - 2):
        y.append(10 + 0.5 * y[-1] + 0.3 * y[-2] + r.normal(0, 0.1))
    return np.array(y)


def test_autoregression_finds_planted_coefficients(spark):
    y = planted_ar()
    df = series_frame(spark, {"a": y, "b": y * 2})
    betas = {r["series_id"]: r["beta"] for r in TS.ar_fit(df, 2).collect()}
    x = np.column_stack([np.ones(len(y) - 2), y[1:-1], y[:-2]])
    expected = np.linalg.lstsq(x, y[2:], rcond=None)[0]
    assert betas["a"] == pytest.approx(expected.tolist(), rel=1e-4)
    out = TS.ar_predict(df, TS.ar_fit(df, 2), 2, 5).filter("series_id = 'a' AND kind = 'forecast'").orderBy("t").collect()
    history = list(y)
    for r in out:
        history.append(expected[0] + expected[1] * history[-1] + expected[2] * history[-2])
        assert r["yhat"] == pytest.approx(history[-1], rel=1e-5)
    assert out[0]["t"] == month(len(y))


def test_unit_root(spark):
    r = np.random.default_rng(5)
    walk, noise = np.cumsum(r.normal(0, 1, 200)), r.normal(0, 1, 200)
    rows = TS.adf_first_stationary(series_frame(spark, {"walk": walk, "noise": noise}), 3).collect()
    at = {(x["series_id"], x["order"]): x for x in rows}
    assert at["noise", 0]["stationary"] and not at["walk", 0]["stationary"]
    assert at["walk", 1]["stationary"] and at["walk", 1]["first_order"] == 1


def test_recursive_forecast_of_a_linear_recurrence(spark):
    y = 100 + np.arange(60) * 2.0
    df = series_frame(spark, {"a": y, "b": y + 7})
    model, assembler = TS.fit_lag_model(df, LinearRegression(regParam=0.0), 3, month=False)
    out = TS.recursive_forecast(model, assembler, df, 4).orderBy("series_id", "t").collect()
    assert [r["t"] for r in out[:4]] == [month(60 + i) for i in range(4)]
    assert [r["yhat"] for r in out[:4]] == pytest.approx([y[-1] + 2 * i for i in range(1, 5)], rel=1e-3)


def test_two_way_anova_on_a_balanced_table(spark):
    r = np.random.default_rng(2)
    rows = [(a, b, float(a * 3 + b + r.normal())) for a in range(3) for b in range(2) for _ in range(6)]
    df = spark.createDataFrame(rows, "a int, b int, y double")
    y = np.array([v for *_, v in rows]).reshape(3, 2, 6)
    grand = y.mean()
    ss_a = 12 * ((y.mean((1, 2)) - grand) ** 2).sum()
    ss_b = 18 * ((y.mean((0, 2)) - grand) ** 2).sum()
    ss_within = ((y - y.mean(2, keepdims=True)) ** 2).sum()
    ss_ab = ((y - grand) ** 2).sum() - ss_a - ss_b - ss_within
    for sequential in (False, True):
        out = {x["source"]: x for x in stats.anova_two_way(df, "a", "b", "y", sequential).collect()}
        assert out["a"]["sum_sq"] == pytest.approx(ss_a)
        assert out["b"]["sum_sq"] == pytest.approx(ss_b)
        assert out["a:b"]["sum_sq"] == pytest.approx(ss_ab)
        assert out["residual"]["sum_sq"] == pytest.approx(ss_within) and out["residual"]["dof"] == 30
        assert out["a"]["f_value"] == pytest.approx(ss_a / 2 / (ss_within / 30))


def test_tail_probabilities():
    assert chi2_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert chi2_tail(18.307038053275146, 10) == pytest.approx(0.05)
    assert f_tail(3.325834530413011, 5, 10) == pytest.approx(0.05)
    assert t_tail_two_sided(2.2281388519649385, 10) == pytest.approx(0.05)


def test_kruskal_with_ties(spark):
    groups = {"x": [1, 1, 2, 5, 7], "y": [2, 2, 2, 9, 9, 9], "z": [1, 8, 8, 8]}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double")
    values = sorted(v for vs in groups.values() for v in vs)
    n = len(values)
    rank = {v: np.mean([i + 1 for i, w in enumerate(values) if w == v]) for v in values}
    h = 12 / (n * (n + 1)) * sum(sum(rank[v] for v in vs) ** 2 / len(vs) for vs in groups.values()) - 3 * (n + 1)
    h /= 1 - sum(c**3 - c for c in Counter(values).values()) / (n**3 - n)
    assert stats.kruskal(df, "g", "v").first()["statistic"] == pytest.approx(h)


# fixed values: published example pairs of the two stemmers
@pytest.mark.parametrize("word,stem", [("caresses", "caress"), ("ponies", "poni"), ("agreed", "agre"), ("hopping", "hop"),
    ("filing", "file"), ("relational", "relat"), ("electriciti", "electr"), ("adjustment", "adjust"), ("controll", "control")])
def test_porter(word, stem):
    assert porter(word) == stem


@pytest.mark.parametrize("word,stem", [("consolingly", "consol"), ("knackeries", "knackeri"), ("generally", "general"),
    ("communication", "communic"), ("gas", "gas"), ("ties", "tie"), ("hoped", "hope"), ("nationally", "nation")])
def test_snowball(word, stem):
    assert snowball(word) == stem


def test_preprocess_by_hand(spark):
    text = 'I am reading a book now; reading BOOKS!  "Readers" read books, 2nd 888.'
    df = spark.createDataFrame([(1, text), (2, "")], "id int, text string")
    tokens = df.select(basic_tokens(F.col("text")).alias("w")).first()["w"]
    assert tokens == "i am reading a book now reading books ! readers read books , 2nd 888 .".split()
    assert df.select(digit_split(basic_tokens(F.col("text"))).alias("w")).first()["w"][-5:] == ["2", "8", "8", "8", "."]
    stems = [porter(w) for w in tokens if w not in set(STOP_WORDS)]
    n = Counter(stems)
    out = {r["id"]: r["tokens"] for r in X.preprocess(df, "id", "text").collect()}
    assert out == {1: [s for s in stems if n[s] >= 2], 2: []}


def test_encoding_pads_and_refuses_long_texts(spark):
    df = spark.createDataFrame([(1, ["b", "a"]), (2, []), (3, ["a", "a", "c"])], "id int, tokens array<string>")
    vocabulary = X.special_vocabulary(X.token_rows(df, "id", F.col("tokens")))
    out = {r["id"]: r["ids"] for r in X.encode_pad(df, "id", F.col("tokens"), vocabulary, 6, add_end=True).collect()}
    assert out == {1: [5, 2, 1, 4, 0, 0], 2: [5, 4, 0, 0, 0, 0], 3: [5, 1, 1, 3, 4, 0]}
    with pytest.raises(Exception, match="longer than 3"):
        X.encode_pad(df, "id", F.col("tokens"), vocabulary, 3).collect()


ROWS_ONLY = sorted(set(QUERIES) - set(TWINS))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = df.collect()
    assert rows
    for r in rows[:50]:
        assert all(v is None or not isinstance(v, float) or math.isfinite(v) for v in r)


@pytest.mark.parametrize("name", ["rf_classify", "mlp_classify", "svc_classify"])
def test_classifiers_cover_the_held_out_part(spark, tables, name):
    held_out = QUERIES["knn_classify"](spark, SF_DIR).count()
    assert QUERIES[name](spark, SF_DIR).count() == held_out


def test_tokens_are_encoded_alike_on_both_ways(spark):
    """A broadcast vocabulary and a joined one give the same ids; unknown tokens, nulls and empty lists."""
    rows = [(1, ["b", "a", "b", "zz"]), (2, []), (3, None), (4, ["c"] * 5 + ["a"]), (5, ["zz"]), (6, ["a", None, "b"])]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(3)
    words = spark.createDataFrame([("a", 7), ("b", 8), ("c", 9)], "token string, term_id long")
    few, many = (sorted((r["doc_id"], r["ids"] or []) for r in X.encode(docs, "doc_id", F.col("tokens"), words, n).collect()) for n in (100, 0))
    assert few == many == [(1, [8, 7, 8]), (2, []), (3, []), (4, [9] * 5 + [7]), (5, []), (6, [7, 8])]
    none = X.encode(docs, "doc_id", F.col("tokens"), words.limit(0)).collect()
    assert all(not r["ids"] for r in none)


def test_fixed_length_is_never_cut(spark):
    docs = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "doc_id long, tokens array<string>")
    vocabulary = X.special_vocabulary(X.token_rows(docs, "doc_id", F.col("tokens")))
    fitted = {r["doc_id"]: r["ids"] for r in X.encode_pad(docs, "doc_id", F.col("tokens"), vocabulary, length=4).collect()}
    assert fitted == {1: [4, 1, 2, 0], 2: [4, 0, 0, 0]}
    with pytest.raises(Exception, match="longer than 2"):
        X.encode_pad(docs, "doc_id", F.col("tokens"), vocabulary, length=2).collect()


@pytest.mark.parametrize("least", [1, 2, 3])
def test_rare_tokens_within_documents(spark, least):
    rows = [(1, ["x", "y", "x", "z", "x", "y"]), (2, []), (3, None), (4, ["q", None, "q", None]), (5, ["one"])]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(2)
    got = {r["doc_id"]: r["tokens"] for r in X.drop_rare(docs, "tokens", least).collect()}
    assert got == {i: w if w is None else [v for v in w if w.count(v) >= least] for i, w in rows}


def test_every_word_has_a_place_of_its_own(spark):
    words = [f"word{i}" for i in range(3000)]
    docs = spark.createDataFrame([(1, words), (2, words[::-1] + ["word7"]), (3, ["unknown"]), (4, None)], "doc_id long, tokens array<string>")
    known = X.dictionary(docs, "doc_id", "tokens")
    assert known.count() == 3000
    place = {r["token"]: r["term_id"] for r in known.collect()}
    assert sorted(place.values()) == list(range(3000)) and place["word0"] == 0
    counts = {r["doc_id"]: r["counts"] for r in X.count_vectors(docs, "doc_id", "tokens", known).collect()}
    assert counts[1].size == 3000 and counts[1].numNonzeros() == 3000 and counts[1][place["word7"]] == 1
    assert counts[2][place["word7"]] == 2 and counts[3].numNonzeros() == 0 and counts[4].numNonzeros() == 0


@pytest.mark.parametrize("small_rows", [100, 0])
def test_rare_tokens_of_the_corpus_are_dropped_in_their_rows(spark, capsys, small_rows):
    rows = [(1, ["a", "x", "b", "a"]), (2, []), (3, None), (4, ["y"]), (5, ["b", None, "a"]), (None, ["b", "a"])]
    frame = lambda r: spark.createDataFrame(r, "doc_id long, tokens array<string>").repartition(3)
    df = X.drop_rare_in_corpus(frame(rows), "doc_id", "tokens", 3, small_rows)
    assert {r["doc_id"]: r["tokens"] for r in df.collect()} == {1: ["a", "b", "a"], 5: ["b", "a"], None: ["b", "a"]}
    df.explain()
    assert small_rows == 0 or "Exchange hashpartitioning" not in capsys.readouterr().out
    # Rows of one key are one document, read place by place.
    twice = X.drop_rare_in_corpus(frame([*rows, (1, ["b", "y", "a"]), (None, ["a"])]), "doc_id", "tokens", 3, small_rows)
    assert {r["doc_id"]: r["tokens"] for r in twice.collect()} == {1: ["a", "b", "a", "b", "a"], 5: ["b", "a"], None: ["a", "b", "a"]}


@pytest.mark.parametrize("small_rows", [100, 0])
def test_words_are_counted_in_their_rows(spark, capsys, small_rows):
    frame = lambda r: spark.createDataFrame(r, "doc_id long, tokens array<string>").repartition(3)
    words = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "token string, term_id long")
    rows = [(1, ["b", "a", "b", "zz", None]), (2, []), (3, None), (4, ["c"]), (None, ["a"]), (None, ["b"])]
    made = X.count_vectors(frame(rows), "doc_id", "tokens", words, small_rows=small_rows)
    got = sorted((r["doc_id"] or 0, r["counts"].toArray().tolist()) for r in made.collect())
    assert got == [(0, [0, 0, 0]), (1, [1, 2, 0]), (2, [0, 0, 0]), (3, [0, 0, 0]), (4, [0, 0, 1])]
    made.explain()
    assert small_rows == 0 or "Generate" not in capsys.readouterr().out
    both = X.count_vectors(frame([*rows, (4, ["a", "c"]), (2, [])]), "doc_id", "tokens", words, small_rows=small_rows)
    got = sorted((r["doc_id"] or 0, r["counts"].toArray().tolist()) for r in both.collect())
    assert got == [(0, [0, 0, 0]), (1, [1, 2, 0]), (2, [0, 0, 0]), (3, [0, 0, 0]), (4, [1, 0, 2])]


def test_anova_by_matrix_and_by_gradients(spark):
    """An unbalanced table with an empty cell and disconnected levels, against least squares on all rows."""
    rng = np.random.default_rng(17)
    rows = [(f"a{i}", f"b{j}", float(i + 2 * j + rng.normal())) for i in range(7) for j in range(5) for _ in range(int(rng.integers(0, 5)))]
    rows += [("alone", "apart", 3.0), ("alone", "apart", 4.5)] + [(None, "b1", 1.0), ("a1", None, 2.0), ("a1", "b1", None)]
    df = spark.createDataFrame(rows, "a string, b string, y double")
    full = [r for r in rows if None not in r]
    y = np.array([r[2] for r in full])

    def loss(*keys):
        x = np.hstack([np.ones((len(full), 1))] + [np.array([[k(r) == v for v in sorted({k(s) for s in full})] for r in full], float) for k in keys])
        return ((y - x @ np.linalg.lstsq(x, y, rcond=None)[0]) ** 2).sum()

    a, b, ab = (lambda r: r[0]), (lambda r: r[1]), (lambda r: r[:2])
    none, one, two, both, cells = loss(), loss(a), loss(b), loss(a, b), loss(ab)
    for sequential in (False, True):
        expected = [none - one if sequential else two - both, one - both, both - cells, cells]
        for levels in (64, 0):
            got = {r["source"]: r["sum_sq"] for r in stats.anova_two_way(df, "a", "b", "y", sequential, levels).collect()}
            assert [got[s] for s in ("a", "b", "a:b", "residual")] == pytest.approx(expected, abs=1e-8)
    assert stats.anova_two_way(df.limit(0), "a", "b", "y").count() == 0


def direct_adf(values, order, skip):
    step = np.diff(values)
    at = np.arange(skip, len(step))
    x = np.column_stack([np.ones(len(at)), values[at]] + [step[at - j] for j in range(1, order + 1)])
    beta, *_ = np.linalg.lstsq(x, step[at], rcond=None)
    left = step[at] - x @ beta
    error = np.sqrt(left @ left / (len(at) - x.shape[1]) * np.linalg.pinv(x.T @ x)[1, 1])
    return beta[1] / error, len(at) * np.log(left @ left / len(at)) + 2 * x.shape[1]


def test_unit_root_from_one_matrix(spark):
    """Statistic and lag order of every difference, against a regression of its own for each order."""
    rng = np.random.default_rng(23)
    series = {"walk": np.cumsum(rng.normal(size=90)) + 500, "wave": np.sin(np.arange(70) / 3) * 40 + rng.normal(size=70), "short": rng.normal(size=9)}
    rows = [(n, dt.date(2000 + i // 12, i % 12 + 1, 1), float(v)) for n, x in series.items() for i, v in enumerate(x)] + [("same", dt.date(2000, m, 1), 5.0) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "series_id string, t date, y double")
    got = {(r["series_id"], r["order"]): r for r in TS.adf_first_stationary(df, 2).collect()}
    for n, x in series.items():
        for order in range(3):
            v = x if not order else x[order:] - x[:-order]
            steps = len(v) - 1
            most = min(int(np.ceil(12 * (steps / 100) ** 0.25)), steps // 2 - 3)
            if most < 0:
                assert got[n, order]["statistic"] is None
                continue
            best = min(range(most + 1), key=lambda k: direct_adf(v, k, most)[1])
            assert got[n, order]["statistic"] == pytest.approx(direct_adf(v, best, best)[0], rel=1e-6)
    assert got["same", 0]["statistic"] is None
    fixed = {(r["series_id"], r["lags"]): r["statistic"] for r in TS.unit_root(df.filter("series_id IN ('walk', 'wave')"), [0, 1, 4]).collect()}
    assert all(fixed[n, k] == pytest.approx(direct_adf(series[n], k, k)[0], rel=1e-6) for n in ("walk", "wave") for k in (0, 1, 4))


def test_large_vocabulary_meets_chunks_of_documents(spark, monkeypatch):
    """Repeated and null keys, null and empty lists and unknown words give the same rows on both ways, without token rows in a shuffle."""
    rows = [(i % 40 if i % 7 else None, [f"w{(i * j) % 23}" for j in range(i % 9)] if i % 11 else None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    words = spark.createDataFrame([(f"w{i}", 100 + i) for i in range(0, 23, 2)], "token string, term_id long")
    few = X.encode(docs, "doc_id", F.col("tokens"), words, 100)
    monkeypatch.setattr(X, "CHUNK_TOKENS", 30)
    many = X.encode(docs, "doc_id", F.col("tokens"), words, 0)
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
    assert "collect_list" not in many._jdf.queryExecution().optimizedPlan().toString()


def test_stemmed_lists_keep_nulls_and_order(spark):
    docs = spark.createDataFrame([(1, ["running", "dogs", "running"]), (2, None), (3, [])], "id long, tokens array<string>")
    out = {r["id"]: r["t"] for r in docs.select("id", stem_tokens(F.col("tokens")).alias("t")).collect()}
    assert out == {1: ["run", "dog", "run"], 2: None, 3: []}


def test_words_are_counted_in_their_row(spark):
    """Repeated and null keys are one document each; the tokens of other rows are in no shuffle."""
    rows = [(1, ["a", "b", "a"]), (2, None), (3, []), (4, ["b"]), (4, ["b", "c"]), (None, ["a"]), (None, ["a", "d"]), (5, ["e"] * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    wanted = Counter((k, w) for k, words in rows for w in words or [])
    counts = X.word_counts(docs, "doc_id", "tokens")
    assert {(r["doc_id"], r["token"]): r["n"] for r in counts.collect()} == wanted and counts.count() == len(wanted)
    assert "left_anti" in counts._jdf.queryExecution().optimizedPlan().toString().lower().replace("leftanti", "left_anti")


@pytest.mark.parametrize("classes", [2, 3])
def test_wide_text_model_is_that_of_spark(spark, monkeypatch, classes):
    """Beyond the bound no vector of the fit lies in the driver's heap, and the classes stay those of Spark's model."""
    r = np.random.default_rng(classes)
    rows = [(i, " ".join(f"w{v}" for v in r.integers(0, 300, 40)) + (" good" * (i % classes) if r.random() < 0.8 else "")) for i in range(240)]
    docs = spark.createDataFrame([*rows, rows[5], (None, "w1 w2"), (900, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % classes) for i in range(0, 200)], "doc_id long, quality int")
    t = SimpleNamespace(documents=docs, labels=labels)
    monkeypatch.setattr(texts, "_STEPS", 5)
    expected = {row["doc_id"]: row["quality"] for row in texts.text_classify(t).collect()}
    monkeypatch.setattr(texts, "MOST_WEIGHTS", 0)
    monkeypatch.setattr(texts, "_text_model", None)
    monkeypatch.setattr(linear, "SLICE", 100)
    got = {row["doc_id"]: row["quality"] for row in texts.text_classify(t).collect()}
    assert got == expected and len(set(got.values())) == classes


def test_wide_text_model_of_one_class(spark):
    rows = spark.createDataFrame([(1.0, [(0, 2.0)]), (1.0, [])], "label double, pairs array<struct<i:int,n:double>>")
    assert [r["prediction"] for r in linear.fit_classes(rows, 3, 0.01, 5).predict(rows).collect()] == [1, 1]
