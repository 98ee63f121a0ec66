"""Fill-in-the-middle, importance resampling and the Hamming join against plain versions, with odd rows and clashing names."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F
from test_operators import odd_docs  # noqa: F401

from tidemill.llm import hamming, middle, queries, resample
from tidemill.llm import textbytes as tb

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def clashing(df, names):
    """The same rows with further columns under the names that the operators use inside."""
    for name in names:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("other"))
    return df


# --- op11


@pytest.mark.parametrize("error,longest", [(0, 4), (3, 64), (127, 4096)])
def test_rank_index_is_exact(error, longest):
    rng = np.random.default_rng(5)
    for steps in (rng.integers(0, 9, 5000), rng.choice([0, 1, 100_000], 700), np.zeros(50, np.int64), np.array([7]), np.zeros(0, np.int64)):
        offsets = np.cumsum(steps)
        index = middle.RankIndex(offsets, error, longest)
        assert (index.offsets_at(np.arange(len(offsets))) == offsets).all()
        assert not len(offsets) or np.abs(index.residuals.astype(int)).max() <= error


def test_rank_index_needs_few_segments():
    offsets = np.cumsum(np.random.default_rng(6).integers(1, 12, 100_000))
    assert len(middle.RankIndex(offsets).starts) < 200


TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_rewrite(ident, text, seed=42, percent=50, suffix_first=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return (ident, n, "plain", None, None, text)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(tokens[:lo]), "".join(tokens[lo:hi]), "".join(tokens[hi:])
    if h[3] % 100 < suffix_first:
        return (ident, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}")
    return (ident, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}")


@pytest.mark.parametrize("percent", [50, 100])
def test_fill_in_middle_against_plain_version(spark, odd_docs, monkeypatch, percent):  # noqa: F811
    monkeypatch.setattr(tb, "PIECE_BYTES", 1 << 16)
    marks = spark.createDataFrame([(100 + i, t) for i, t in enumerate(["a <P> b", "x<S>y", "<M>", "<P", "P>", " lead", "trail \n", "\t", "<", "é<é <P <S> x", "x <", "a b c"])], "doc_id long, text string")
    for docs in (table(spark, "documents").select("doc_id", "text"), odd_docs.select("doc_id", "text"), marks, marks.limit(0)):
        made = middle.fill_in_middle(clashing(docs, ["_id", "_text", "_digest", "_h1", "n", "form", "output"]), percent=percent)
        made = made.withColumn("back", middle.restored(F.col("form"), F.col("output")))
        rows = docs.collect()
        assert sorted((tuple(r)[:6] for r in made.collect()), key=str) == sorted((plain_rewrite(*r, percent=percent) for r in rows), key=str)
        assert sorted(str((r["doc_id"], r["back"])) for r in made.collect()) == sorted(str((r[0], r[1] or "")) for r in rows)


def test_fill_in_middle_uses_both_forms(spark):
    forms = Counter(r["form"] for r in middle.fill_in_middle(table(spark, "documents"), percent=100).select("form").collect())
    assert forms["spm"] > forms["psm"] > 0


# --- op12


def test_crc_of_spans():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 20_000).astype(np.uint8)
    cuts = np.unique(rng.integers(0, len(data), 900))
    cuts = np.concatenate([cuts, [len(data) - 1]])
    starts, ends = cuts[:-1], cuts[1:]
    assert resample.span_crcs(data, starts, ends).tolist() == [crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_features(text):
    w = plain_words(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def test_run_buckets():
    texts = ["One two THREE four", None, "", "x" * 100 + " y " + "é" * 70 + " z1,2 b", "solo"]
    piece = next(tb.pieces(pa.array(texts)))
    found, bounds = resample.run_buckets(piece)
    for i, t in enumerate(texts):
        got = [b for f in found for b in f[bounds[i]:bounds[i + 1]].tolist() if b >= 0]
        assert got == [crc32(x.encode()) % 10_000 for x in plain_features(t)]


def plain_resample(docs, target, seed=42, percent=5, least=20):
    bucket = lambda f: crc32(f.encode()) % 10_000
    features = [[bucket(f) for f in plain_features(t)] for _, t in docs]
    s = Counter(b for f in features for b in f)
    t = Counter(bucket(f) for x in target for f in plain_features(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    rows = []
    for (ident, text), f in zip(docs, features, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([ident, len(plain_words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for i, r in enumerate(able[:len(able) * percent // 100]):
        r[5] = i + 1
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("segment_rows", [50_000, 7])
def test_resample_against_plain_version(spark, odd_docs, monkeypatch, segment_rows):  # noqa: F811
    monkeypatch.setattr(resample.ranked_runs, "__defaults__", (segment_rows,))
    target = table(spark, "benchmark")
    names = ["_id", "_text", "_h", "rank", "score", "weight", "n_words", "bucket"]
    for docs, percent, least in ((table(spark, "documents").repartition(5), 5, 20), (table(spark, "documents"), 100, 0), (odd_docs, 60, 1), (odd_docs.limit(0), 5, 20)):
        got = resample.resample(clashing(docs, names), clashing(target, names), percent=percent, least_words=least)
        expected = plain_resample([tuple(r) for r in docs.select("doc_id", "text").collect()], [r["text"] for r in target.collect()], percent=percent, least=least)
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected


def test_resample_without_target(spark):
    docs = table(spark, "documents").select("doc_id", "text")
    got = resample.resample(docs, docs.limit(0))
    assert got.filter("rank IS NOT NULL").count() == got.filter("n_words >= 20").count() * 5 // 100


def test_ranks_of_rows_that_tie(spark):
    """A third of all rows ties in score and id: they fall into different segments and have different ranks."""
    rows = [(1, 30, 5, 9, 7)] * 2000 + [(None, 30, 5, 9, 7)] * 500 + [(i, 30, 5, i, i % 13) for i in range(2, 3502)]
    scored = spark.createDataFrame(rows, "_id long, n_words long, n_features long, weight long, score long").repartition(6)
    got = resample.ranked_runs(scored, 20, 60, segment_rows=100).collect()
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, 3601))
    order = sorted(rows, key=lambda r: (-r[4], r[0] is None, r[0] or 0))[:3600]
    assert [(r["score"], r["_id"]) for r in ranked] == [(r[4], r[0]) for r in order]
    assert len(got) == len(rows)


# --- op13


def sets_of(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def plain_components(ids, texts):
    sets, root = sets_of(texts), list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, s) in enumerate(zip(ids, sets, strict=True)):
        component = least.get(find(i)) if s else d
        out.append((d, len(s), component, component == d))
    return sorted(out, key=str)


def same_as_plain(df):
    rows = df.select("doc_id", "text").collect()
    got = hamming.near_duplicates(df).collect()
    return sorted((tuple(r) for r in got), key=str) == plain_components([r[0] for r in rows], [r[1] for r in rows])


def test_hamming_join_against_brute_force(spark, odd_docs):  # noqa: F811
    assert same_as_plain(table(spark, "documents"))
    assert same_as_plain(clashing(odd_docs, ["_id", "_text", "key", "n", "sign", "cls", "place", "label", "kept"]))
    assert hamming.near_duplicates(odd_docs.limit(0)).count() == 0


def test_all_pairs_within_the_distance_share_a_key():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 16, (400, hamming.LENGTH)).astype(np.uint16)
    other = base.copy()
    for row in other:
        row[rng.choice(hamming.LENGTH, hamming.DISTANCE, replace=False)] ^= np.uint16(1)
    one, two = hamming.file_keys(base), hamming.file_keys(other)
    assert all((a == b).any() for a, b in zip(one, two, strict=True))
    assert len(np.unique(one)) == one.size


def test_smallest_sets_that_can_be_linked(spark):
    """Sets of six n-grams and one more: 100 * 6 >= 85 * 7, so they are linked; five of six are not."""
    words = lambda n, tag: " ".join(f"{tag}{i}" for i in range(n))
    texts = [words(n, tag) for tag in ("a", "b", "c") for n in (11, 10, 9, 12, 13)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert same_as_plain(df)
    found = {r["doc_id"]: r["component_id"] for r in hamming.near_duplicates(df).collect()}
    assert [found[i] for i in range(5)] == [0, 0, 2, 0, 0]


def test_pairs_at_the_threshold_are_next_to_never_lost():
    p = 1 - hamming.NUMERATOR / hamming.DENOMINATOR
    lost = sum(math.comb(hamming.LENGTH, k) * p**k * (1 - p) ** (hamming.LENGTH - k) for k in range(hamming.DISTANCE + 1, hamming.LENGTH + 1))
    assert lost < 1e-10
    rng = np.random.default_rng(5)
    sets = rng.integers(0, 1 << 63, (3000, 200)).astype(np.uint64)  # 184 of 216 shared: 0.852
    one, two = (hamming.signatures(np.ascontiguousarray(part).ravel(), np.full(3000, 200)) for part in (sets, np.concatenate([sets[:, :184], rng.integers(0, 1 << 63, (3000, 16)).astype(np.uint64)], axis=1)))
    wrong = (one != two).sum(axis=1)
    assert (wrong <= hamming.DISTANCE).all() and abs(wrong.mean() / hamming.LENGTH - 32 / 216) < 0.01
    assert all((a == b).any() for a, b in zip(hamming.file_keys(one), hamming.file_keys(two), strict=True))


@pytest.mark.parametrize("small", [2, 16])
def test_families_of_near_copies(spark, monkeypatch, small):
    """Families around a common text, some only chained, strangers with common passages, and regions cut into blocks."""
    rng = np.random.default_rng(9)
    rows = []
    for family in range(3):
        base = [f"f{family}w{i}" for i in range(120)]
        for _ in range(70):
            w = list(base)
            for at in rng.choice(120, rng.integers(0, 4 + family), replace=False):
                w[at] = f"x{rng.integers(1 << 30)}"
            rows.append(" ".join(w))
    base = [f"c{i}" for i in range(200)]
    rows += [" ".join(base[i:i + 100]) for i in range(0, 100, 5)]
    rows += ["the same old words in every one of these texts stand ahead of " * 2 + " ".join(f"s{i}w{j}" for j in range(9)) for i in range(40)]
    ids = np.random.default_rng(1).permutation(len(rows))
    df = spark.createDataFrame([(int(i), t) for i, t in zip(ids, rows, strict=True)], "doc_id long, text string")
    monkeypatch.setattr(hamming, "PAIRS_UPTO", small)
    monkeypatch.setattr(hamming, "BLOCK_GRAMS", 1000)
    monkeypatch.setattr(hamming, "PARTNERS", 8)
    assert same_as_plain(df)


def test_overlapping_keys_of_a_family_are_compared_once(spark, monkeypatch):
    """Near copies of one text share most keys: a class enters the comparisons a few times, not once for each key."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(240):
        w = list(base)
        for at in rng.choice(150, rng.integers(2, 9), replace=False):
            w[at] = f"x{rng.integers(1 << 30)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    met, staged = {}, hamming.stage

    def counting(frame, label="stage"):
        out = staged(frame, label)
        met[label] = out.count()
        return out

    monkeypatch.setattr(hamming, "stage", counting)
    monkeypatch.setattr(hamming, "BLOCK_CLASSES", 50)
    assert same_as_plain(df)
    assert met["regions"] > 10 * 240 and 5 * met["merged"] < met["regions"]


def test_keys_that_share_their_first_class_only_stay_apart(spark):
    rows = [(place, 0, 10, 0, 41) for place in range(8)] + [(place, 100 * place + i, 10, i, 41) for place in range(8) for i in range(1, 41)]
    merged = hamming._merged(spark.createDataFrame(rows, "place long, cls long, n long, label long, m long")).collect()
    assert len(merged) == len(rows) and len({r["place"] for r in merged}) == 8
    assert not any(r["whole"] for r in merged)


def test_new_queries_return_the_contract(spark):
    columns = {
        "op11_fill_in_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
        "op12_importance_resampling": ["doc_id", "n_features", "weight", "score", "rank"], "op13_minhash_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    }
    for name, wanted in columns.items():
        df = queries.QUERIES[name](spark, SF_DIR)
        assert df.columns == wanted and df.count() == table(spark, "documents").count()
