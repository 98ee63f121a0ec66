"""Text jobs over the documents; token lists are shown by their number and a digest of the whole list."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF
from pyspark.sql import functions as F

from tidemill.functions import tokens as K
from tidemill.operators import text as X
from tidemill.operators.linear import fit_classes
from tidemill.plans.registry import query
from tidemill.session import spread, stage

_TOKENS = f"SELECT doc_id, {K.BASIC_TOKENS_SQL} AS w FROM documents"
_STOP = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in K.STOP_WORDS) + ")"
_DIGEST = "len(w)::INTEGER AS n_tokens, md5(array_to_string(w, ' ')) AS digest"


def digest(tokens):
    return [F.size(tokens).alias("n_tokens"), F.md5(F.array_join(tokens, " ")).alias("digest")]


def used_ids():
    return F.size(F.filter("ids", lambda i: i != 0))


def ids_digest():
    """Digest of all ids as text; the padding behind the used ones is written as a run."""
    body = F.array_join(F.slice("ids", F.lit(1), used_ids()).cast("array<string>"), ",")
    return F.md5(F.concat(body, F.repeat(F.lit(",0"), F.size("ids") - used_ids()))).alias("digest")


def basic(t):
    return spread(t.documents.select("doc_id", "text")).select("doc_id", K.basic_tokens(F.col("text")).alias("tokens"))


@query("tokenize_basic", f"SELECT doc_id, {_DIGEST} FROM ({_TOKENS})")
def tokenize_basic(t):
    return basic(t).select("doc_id", *digest("tokens"))


@query("remove_stopwords", f"SELECT doc_id, {_DIGEST} FROM (SELECT doc_id, list_filter(w, lambda x: x NOT IN {_STOP}) AS w FROM ({_TOKENS}))")
def remove_stopwords(t):
    kept = basic(t).select("doc_id", K.without_stop_words(F.col("tokens")).alias("tokens"))
    return kept.select("doc_id", *digest("tokens"))


@query("stem_vocabulary")
def stem_vocabulary(t):
    """Both stems of every distinct token."""
    rows = X.token_rows(basic(t), "doc_id", F.col("tokens"))
    words = spread(stage(rows.select("token").distinct(), "words"))
    return X.stem_vocabulary(X.stem_vocabulary(words, "porter", "porter"), "snowball", "snowball")


_ROWS = f"SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM ({_TOKENS})"
_GATHER = "len(list(token))::INTEGER AS n_tokens, md5(string_agg(token, ' ' ORDER BY pos)) AS digest"


@query("drop_rare_tokens", f"""
    SELECT doc_id, coalesce(n_tokens, 0) AS n_tokens, coalesce(digest, md5('')) AS digest FROM documents LEFT JOIN
      (SELECT doc_id, {_GATHER} FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, token) AS n FROM ({_ROWS})) WHERE n >= 2 GROUP BY 1) USING (doc_id)""")
def drop_rare_tokens(t):
    return X.drop_rare(basic(t), "tokens", 2).select("doc_id", *digest("tokens"))


@query("drop_rare_in_corpus", f"""
    SELECT doc_id, {_GATHER} FROM (SELECT *, count(*) OVER (PARTITION BY token) AS n FROM ({_ROWS})) WHERE n >= 10 GROUP BY 1""")
def drop_rare_in_corpus(t):
    return X.drop_rare_in_corpus(basic(t), "doc_id", "tokens", 10).select("doc_id", *digest("tokens"))


@query("preprocess_text")
def preprocess_text(t):
    return X.preprocess(spread(t.documents.select("doc_id", "text")), "doc_id", "text", 2).select("doc_id", *digest("tokens"))


_WORDS = f"SELECT doc_id, regexp_extract_all(lower(text), '{K.WORD}') AS w FROM documents"


@query("bag_of_words", f"""
    WITH r AS (SELECT doc_id, unnest(w) AS token FROM ({_WORDS})), v AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS term_id FROM (SELECT DISTINCT token FROM r))
    SELECT doc_id, term_id::BIGINT AS term_id, count(*) AS n FROM r JOIN v USING (token) GROUP BY 1, 2""")
def bag_of_words(t):
    docs = spread(t.documents.select("doc_id", "text")).select("doc_id", K.word_tokens(F.col("text")).alias("tokens"))
    counts = stage(X.word_counts(docs, "doc_id", "tokens"), "counts")
    return X.bag_of_words(counts, "doc_id", X.sorted_vocabulary(counts))


_VOCABULARY = f"""
    r AS ({_ROWS}), w AS (SELECT token, row_number() OVER (ORDER BY token) AS term_id FROM (SELECT DISTINCT token FROM r)),
    v AS (SELECT token, term_id FROM w UNION ALL SELECT '', 0 UNION ALL SELECT '[END]', max(term_id) + 1 FROM w UNION ALL SELECT '[START]', max(term_id) + 2 FROM w)"""


@query("build_vocabulary", f"WITH {_VOCABULARY} SELECT token, term_id::BIGINT AS term_id FROM v")
def build_vocabulary(t):
    return X.special_vocabulary(X.token_rows(basic(t), "doc_id", F.col("tokens")))


#: Tokens of a turn with its start mark.
_FIXED = 512


@query("encode_pad", f"""
    WITH {_VOCABULARY},
    e AS (SELECT doc_id, list(term_id ORDER BY pos) AS ids FROM r JOIN v USING (token) GROUP BY 1),
    m AS (SELECT doc_id, list_concat([(SELECT term_id FROM v WHERE token = '[START]')], coalesce(ids, []), [(SELECT term_id FROM v WHERE token = '[END]')]) AS ids
          FROM documents LEFT JOIN e USING (doc_id)),
    n AS (SELECT max(len(ids)) AS n FROM m)
    SELECT doc_id, n::INTEGER AS length, md5(array_to_string(ids, ',') || repeat(',0', n - len(ids))) AS digest FROM m, n""")
def encode_pad(t):
    tokens = stage(basic(t), "tokens")
    vocabulary = stage(X.special_vocabulary(X.token_rows(tokens, "doc_id", F.col("tokens"))), "vocabulary")
    encoded = X.encode_pad(tokens, "doc_id", F.col("tokens"), vocabulary, add_end=True)
    return encoded.select("doc_id", F.size("ids").alias("length"), ids_digest())


@query("distinct_tokens_per_doc", f"""
    SELECT doc_id, len(list_distinct(w))::BIGINT AS n_distinct FROM ({_TOKENS})
    UNION ALL SELECT -1, count(DISTINCT token) FROM ({_ROWS})""")
def distinct_tokens_per_doc(t):
    docs = basic(t)
    per_doc = docs.select("doc_id", F.size(F.array_distinct("tokens")).cast("long").alias("n_distinct"))
    corpus = docs.select(F.explode("tokens").alias("token")).distinct().agg(F.count(F.lit(1)))
    return per_doc.unionAll(corpus.select(F.lit(-1).cast("long"), "count(1)"))


@query("digit_split_tokens", f"""
    SELECT doc_id, {_DIGEST} FROM (SELECT doc_id, flatten(list_transform(w, lambda x: CASE WHEN regexp_matches(x, '[0-9]')
      THEN regexp_extract_all(x, '[0-9]') ELSE [x] END)) AS w FROM ({_TOKENS}))""")
def digit_split_tokens(t):
    split = basic(t).select("doc_id", K.digit_split(F.col("tokens")).alias("tokens"))
    return split.select("doc_id", *digest("tokens"))


_TURNS = f"SELECT conv_id || ':' || turn AS turn_id, {K.BASIC_TOKENS_SQL} AS w FROM conversations"


@query("encode_fixed_length", f"""
    WITH t AS ({_TURNS}), r AS (SELECT turn_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM t),
    v AS (SELECT token, row_number() OVER (ORDER BY token) AS term_id FROM (SELECT DISTINCT token FROM r)),
    e AS (SELECT turn_id, list(term_id ORDER BY pos) AS ids FROM r JOIN v USING (token) GROUP BY 1),
    m AS (SELECT turn_id, list_concat([(SELECT max(term_id) + 2 FROM v)], coalesce(ids, [])) AS ids FROM t LEFT JOIN e USING (turn_id))
    SELECT turn_id, {_FIXED} AS length, len(ids)::INTEGER AS used, md5(array_to_string(ids, ',') || repeat(',0', {_FIXED} - len(ids))) AS digest FROM m""")
def encode_fixed_length(t):
    """Turns of conversations in the decoder's form: start mark, no end mark, one stated length; a longer turn is an error."""
    turns = t.conversations.select(F.concat_ws(":", "conv_id", "turn").alias("turn_id"), K.basic_tokens(F.col("text")).alias("tokens"))
    tokens = stage(spread(turns), "tokens")
    vocabulary = stage(X.special_vocabulary(X.token_rows(tokens, "turn_id", F.col("tokens"))), "vocabulary")
    encoded = X.encode_pad(tokens, "turn_id", F.col("tokens"), vocabulary, length=_FIXED)
    return encoded.select("turn_id", F.size("ids").alias("length"), used_ids().alias("used"), ids_digest())


#: Weights, words times classes, of a model whose fit may keep its vectors in the driver's heap.
MOST_WEIGHTS = 1_000_000
_STEPS, _PENALTY = 20, 0.01


def _classified(t, others=True):
    """doc_id and prediction of the documents, by a linear model on the counts of the labelled ones' words.

    Without ``others`` only labelled documents are tokenised, counted and returned, with their label.
    """
    labels = t.labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    docs = spread(t.documents.select("doc_id", "text"))
    docs = docs if others else docs.join(labels, "doc_id", "left_semi")
    tokens = stage(docs.select("doc_id", K.word_tokens(F.coalesce("text", F.lit(""))).alias("tokens")), "tokens")
    words = stage(X.dictionary(tokens.join(labels, "doc_id", "left_semi"), "doc_id", "tokens"), "words")
    n_words, top = words.count(), labels.agg(F.max("label")).first()[0]
    if n_words * ((top or 0) + 1) <= MOST_WEIGHTS:
        counts = stage(X.count_vectors(tokens, "doc_id", "tokens", words), "counts")
        model = _text_model(counts.join(labels, "doc_id"))
        judged = model.transform(counts if others else counts.join(labels, "doc_id"))
        return judged.drop("counts", "features", "rawPrediction", "probability").withColumn("prediction", F.col("prediction").cast("int"))
    counts = stage(X.placed_counts(tokens, "doc_id", "tokens", words), "counts")
    labelled = counts.join(labels, "doc_id")
    return fit_classes(labelled.select("label", "pairs"), n_words, _PENALTY, _STEPS).predict(counts if others else labelled)


def _text_model(labelled):
    return Pipeline(stages=[IDF(inputCol="counts", outputCol="features"), LogisticRegression(family="multinomial", maxIter=_STEPS, regParam=_PENALTY)]).fit(labelled)


@query("text_classify")
def text_classify(t):
    """Quality predicted for every document by a linear model on the counts of the labelled ones' words."""
    return _classified(t).select("doc_id", F.col("prediction").alias("quality"))


@query("text_classify_check", """
    WITH l AS (SELECT doc_id, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
    c AS (SELECT q, count(*) AS n FROM l WHERE doc_id IN (SELECT doc_id FROM documents) GROUP BY 1)
    SELECT sum(n)::BIGINT AS n_labelled, round(max(n) / sum(n), 6) AS majority, true AS better FROM c""")
def text_classify_check(t):
    """Share of the larger class among the labelled documents, and whether the fitted model is right on more of them."""
    judged = _classified(t, others=False).select("label", (F.col("label") == F.col("prediction")).cast("double").alias("hit"))
    per = judged.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("hit").alias("hits"))
    share = F.max("n") / F.sum("n")
    return per.agg(F.sum("n").alias("n_labelled"), F.round(share, 6).alias("majority"), (F.sum("hits") / F.sum("n") > share).alias("better"))
