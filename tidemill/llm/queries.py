"""Registered queries of the operators, each on its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import decontam, hamming, jaccard, lines, maintext, middle, mixing, ngram_lm, quality, resample, suffixes, topk, urls

# Host, path and verdict of the rules.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at a Jaccard similarity of 0.75 of five-word shingles."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that strings of 100 bytes cover which start earlier in the corpus."""
    return suffixes.drop_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every 50th one."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and probability of the best grade for every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_on_ratings(docs, table(spark, sf_dir, "labels"), quality.rating_grade())
    return quality.grade_documents(docs.select("doc_id", "text"), model, quality.BEST_GRADE).drop("text")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the longest fitting rule for every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier line but for one word."""
    return lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows cover."""
    found = decontam.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("_id").alias("doc_id"), "n_words", decontam.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        decontam.items_digest().alias("items_sha256"), decontam.contaminated().alias("contaminated"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and language-model log10 probabilities of every document."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return ngram_lm.score_documents(table(spark, sf_dir, "documents"), held_out)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = maintext.extract_main_text(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of documents by source weights of 0.98 of the greatest entropy, no source more than twice as often as another."""
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_tokens", "weight", "epoch", "block", "place")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rewritten for fill-in-the-middle training, and restored, as digests."""
    made = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(middle.restored(F.col("form"), F.col("output"))).alias("restored_sha256"),
    )


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark texts, and the ranks of the 5 % drawn."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at a Jaccard similarity of 0.85 of five-word shingles."""
    return hamming.near_duplicates(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_suffix_array_dedup, op3_exact_top_k, op4_quality_classifier, op5_url_filters, op6_line_dedup, op7_benchmark_decontamination, op8_lm_scoring, op9_html_extraction, op10_source_mixing,
    op11_fill_in_middle, op12_importance_resampling, op13_minhash_near_dedup, pipeline,
)}

_TOPK_SQL = """
    WITH v AS (
        SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
               CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM s QUALIFY rank <= 5
"""

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_URL_SQL = f"""
    WITH u AS (
        SELECT page_id, url, row_number() OVER () AS r, {_LOWER_SQL.format("coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), '')")} AS host,
               coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages
    ), m AS (
        SELECT u.r, h || p AS rule, v AS verdict,
               row_number() OVER (PARTITION BY u.r ORDER BY length(h || p) DESC, length(h) DESC, v DESC) AS n
        FROM u JOIN (VALUES {_RULES_SQL}) AS rules(h, p, v) ON (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(u.path, p)
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN m ON u.r = m.r AND m.n = 1
"""

_LINES_SQL = rf"""
    WITH l AS (
        SELECT doc_id, CAST(n - 1 AS INTEGER) AS line_no, line, list_filter(string_split_regex(lower(line), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents WHERE doc_id IS NOT NULL)
    ), d AS (
        SELECT words, min((doc_id, line_no)) AS first FROM l WHERE len(words) >= {lines.MIN_WORDS} GROUP BY words
    ), v AS (
        SELECT words, first, place, CASE WHEN place = 0 THEN words ELSE list_concat(words[1:place - 1], words[place + 1:]) END AS key
        FROM (SELECT words, first, unnest(range(0, len(words) + 1)) AS place FROM d)
    ), k AS (
        SELECT key, min(first) AS any_first, min(first) FILTER (place = 0) AS whole_first FROM v GROUP BY key
    ), p AS (
        SELECT key, place, min(first) AS same_first FROM v GROUP BY key, place
    ), near AS (
        SELECT DISTINCT v.words FROM v JOIN k ON v.key = k.key JOIN p ON v.key = p.key AND v.place = p.place
        WHERE CASE WHEN v.place = 0 THEN any_first < first ELSE least(same_first, coalesce(whole_first, same_first)) < first END
    ), j AS (
        SELECT l.doc_id, l.line_no, l.line, d.words IS NOT NULL AND ((l.doc_id, l.line_no) <> d.first OR near.words IS NOT NULL) AS gone
        FROM l LEFT JOIN d ON l.words = d.words LEFT JOIN near ON l.words = near.words
    ), g AS (
        SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS text, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
        FROM j GROUP BY doc_id
    )
    SELECT x.doc_id, g.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed FROM documents x LEFT JOIN g ON x.doc_id = g.doc_id
"""

_WORDS_SQL = r"regexp_extract_all(" + _LOWER_SQL.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DECONTAM_SQL = f"""
    WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
    i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
    iw AS (
        SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS win
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM i WHERE len(w) > 0)
    ), sizes AS (SELECT DISTINCT size FROM iw),
    dw AS (
        SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS win
        FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)
    ), m AS (SELECT doc_id, s, dw.size, item FROM dw JOIN iw ON dw.win = iw.win AND dw.size = iw.size),
    h AS (SELECT doc_id, count(DISTINCT spot) AS n FROM (SELECT doc_id, unnest(range(s, s + size)) AS spot FROM m) GROUP BY doc_id),
    n AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(n.n, 0) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
           coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
"""

_FIM_SQL = r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t,
               sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
    ), u AS (
        SELECT *, len(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
               ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d
    ), c AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u
    ), p AS (
        SELECT doc_id, text, n, form, array_to_string(t[1:lo], '') AS pre, array_to_string(t[lo + 1:hi], '') AS mid, array_to_string(t[hi + 1:], '') AS suf FROM c
    )
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(text) AS restored_sha256 FROM p
"""

SQL = {"op11_fill_in_middle": _FIM_SQL, "op3_exact_top_k": _TOPK_SQL, "op5_url_filters": _URL_SQL, "op6_line_dedup": _LINES_SQL, "op7_benchmark_decontamination": _DECONTAM_SQL}
