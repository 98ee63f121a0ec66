"""Pipeline over documents: quality, repeated lines, near duplicates, benchmark passages, mixture of sources.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for
the next one. All stages but the last return the columns of documents; the last adds where each reading of a
document stands in the mixture. Nulls, empty texts and tables, repeated rows and further columns are handled as
the operators' docstrings say. SQL cannot express the fitted classifier, so there is none for the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import decontam, jaccard, lines, mixing, quality
from tidemill.session import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose best grade is the likelier outcome; the model is fitted on the rated ones."""
    model = quality.fit_on_ratings(docs, _table(spark, sf_dir, "labels"), quality.rating_grade())
    graded = quality.grade_documents(docs, model, quality.BEST_GRADE)
    return graded.filter("accepted").select(*[F.col(f"`{c}`") for c in docs.columns])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier in the corpus; n_chars counts what is left."""
    kept = lines.drop_repeated_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    return jaccard.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark windows don't contaminate."""
    return decontam.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Readings of the documents by source weights, in blocks; no document is left out."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
