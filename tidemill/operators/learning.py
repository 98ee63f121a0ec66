"""Encoding, splitting, resampling and scoring of labelled tables."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.hashing import unit_hash
from tidemill.operators.joins import bounded
from tidemill.operators.neighbors import nearest
from tidemill.operators.ordering import global_row_number, keyed_row_number
from tidemill.session import stage


#: Levels that may become columns or classes of a model.
MOST_LEVELS = 10_000


def label_codes(df: DataFrame, column: str, first_seen: list[str] | None = None) -> DataFrame:
    """Code 0, 1, ... of each distinct label, in sorted order or by first appearance in the order ``first_seen``."""
    if first_seen is None:
        return global_row_number(df.select(column).distinct(), [column], "code", 0)
    firsts = df.groupBy(column).agg(F.min(F.struct(*first_seen)).alias("_first"))
    return global_row_number(firsts, ["_first", column], "code", 0).drop("_first")


def levels_of(df: DataFrame, column: str) -> list:
    """Values of a column in order, without nulls; each becomes a column or class, so more than ``MOST_LEVELS`` are an error."""
    found = [row[0] for row in df.select(column).dropna().distinct().orderBy(column).limit(MOST_LEVELS + 1).collect()]
    if len(found) > MOST_LEVELS:
        raise ValueError(f"{column} has more than {MOST_LEVELS} levels")
    return found


def one_hot(df: DataFrame, column: str, levels: list[str] | None = None) -> DataFrame:
    """One 0/1 column per level, by default for each one found; a null has none.

    Columns are named after their level in lower case. Where that would name two columns alike - levels that differ
    in case only, or an existing column - the later one, in order of the levels, gets its place as a suffix. At most
    ``MOST_LEVELS`` levels become columns; more are an error before they are fetched.
    """
    levels = levels_of(df, column) if levels is None else levels
    taken, flags = {c.lower() for c in df.columns}, {}
    for place, v in enumerate(levels):
        name = f"{column}_{str(v).lower()}"
        name = name if name.lower() not in taken else f"{name}_{place}"
        taken.add(name.lower())
        flags[name] = F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("int")
    return df.withColumns(flags)


def hash_split(df: DataFrame, key: str, shares: dict[str, float], seed: str) -> DataFrame:
    """Assign each key to a part by its hash; stable under repartitioning and new rows."""
    u = unit_hash(seed, F.col(key))
    edge, part = 0.0, None
    for name, share in shares.items():
        edge += share
        part = F.when(u < edge, name) if part is None else part.when(u < edge, name)
    return df.withColumn("part", part.otherwise(list(shares)[-1]))


def shuffle_split(df: DataFrame, key: str, n_splits: int, test_size: float, seed: str) -> DataFrame:
    """Independent random train/validation splits, one copy of the keys per split."""
    copies = df.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    u = unit_hash(seed, F.col(key), F.col("split"))
    return copies.withColumn("part", F.when(u < test_size, "validation").otherwise("train"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Inverse class frequency n / (k * count), scaled to sum to one."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()
    raw = F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n"))
    return counts.withColumn("_raw", raw).withColumn("weight", F.col("_raw") / F.sum("_raw").over(whole)).drop("_raw")


def near_miss(majority: DataFrame, minority: DataFrame, n_keep: int, k: int = 3, **kwargs) -> DataFrame:
    """Majority rows (id, vec) with the lowest mean distance to their ``k`` nearest minority rows."""
    pairs = nearest(
        majority.select(F.col("id").alias("qid"), F.col("vec").alias("qvec")),
        minority.select(F.col("id").alias("iid"), F.col("vec").alias("ivec")), k, **kwargs,
    )
    means = pairs.groupBy("qid").agg(F.round(F.avg("dist"), 9).alias("mean_dist"))
    ranked = global_row_number(means, ["mean_dist", "qid"], "place")
    return ranked.filter(F.col("place") <= n_keep).select(F.col("qid").alias("id"), "mean_dist")


def smote(minority: DataFrame, n_new: int, seed: str, k: int = 5, **kwargs) -> DataFrame:
    """``n_new`` synthetic rows, each on the line from a hash-chosen row to one of its ``k`` nearest; raises where no row has a neighbour."""
    pairs = nearest(
        minority.select(F.col("id").alias("qid"), F.col("vec").alias("qvec")),
        minority.select(F.col("id").alias("iid"), F.col("vec").alias("ivec")), k, skip_same=True, **kwargs,
    )
    pairs = stage(pairs.select("qid", "iid", "rank"), "neighbors")
    size = minority.count()
    found = min(k, size - 1)
    if n_new and found < 1:
        raise ValueError("synthetic rows need at least two rows to lie between")
    numbered = global_row_number(minority.select("id", "vec"), ["id"], "place")
    new = minority.sparkSession.range(n_new).select(
        F.col("id").alias("new_id"),
        (F.floor(unit_hash(seed + "b", F.col("id")) * size) + 1).alias("place"),
        (F.floor(unit_hash(seed + "n", F.col("id")) * found) + 1).alias("rank"),
        unit_hash(seed + "g", F.col("id")).alias("gap"),
    )
    based = new.join(bounded(numbered), "place").select("new_id", "rank", "gap", F.col("id").alias("qid"), F.col("vec").alias("base"))
    others = minority.select(F.col("id").alias("iid"), F.col("vec").alias("other"))
    chosen = based.join(bounded(pairs), ["qid", "rank"]).join(bounded(others), "iid")
    line = F.zip_with("base", "other", lambda b, o: b + F.col("gap") * (o - b))
    return chosen.select("new_id", F.col("qid").alias("base_id"), F.col("iid").alias("neighbor_id"), "gap", line.alias("vec"))


def oversample(df: DataFrame, key: str, label: str) -> DataFrame:
    """Repeat rows until every class has as many as the largest; copies go round the class in key order."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    sizes = stage(counts.withColumn("_max", F.max("_n").over(Window.partitionBy())), "sizes")
    numbered = keyed_row_number(df, [label], [key], "_rn").join(bounded(sizes), label)
    times = F.floor(F.col("_max") / F.col("_n")) + (F.col("_rn") <= F.col("_max") % F.col("_n")).cast("long")
    return repeat_rows(numbered.withColumn("_times", times), key, "_times").drop("_n", "_max", "_rn")


def repeat_rows(df: DataFrame, key: str, times: str, out: str = "copy", chunk: int = 65_536) -> DataFrame:
    """Each row as often as its ``times`` says, numbered from 1; long repeats are spread over tasks in chunks."""
    last = F.floor((F.col(times) - 1) / chunk)
    chunks = df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition(key, "_chunk")
    start, end = F.col("_chunk") * chunk + 1, F.least((F.col("_chunk") + 1) * chunk, F.col(times))
    return chunks.withColumn(out, F.explode(F.sequence(start, end))).drop("_chunk", times)


def fit_predict(train: DataFrame, test: DataFrame, estimator: Estimator) -> DataFrame:
    """Predictions for (id, vec, label) rows from a model on standardised features.

    The training rows are written once, since the fit passes over them many times.
    """
    train = stage(train, "train")
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True)
    model = Pipeline(stages=[scaler, estimator]).fit(train.withColumn("raw", array_to_vector("vec")))
    scored = model.transform(test.withColumn("raw", array_to_vector("vec")))
    return scored.select("id", "label", F.col("prediction").cast("int").alias("prediction"))


def accuracy(df: DataFrame, label: str, prediction: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def accuracy_summary(folds: DataFrame, by: str) -> DataFrame:
    """Median, mean and standard deviation of the accuracies over the folds."""
    return folds.groupBy(by).agg(
        F.percentile("accuracy", 0.5).alias("median"), F.avg("accuracy").alias("mean"), F.stddev_samp("accuracy").alias("std")
    )


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts per true and predicted class and their share of the true class."""
    counts = df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(label)))


def random_guess(df: DataFrame, key: str, label: str, seed: str) -> DataFrame:
    """Accuracy of a hash-chosen class of the data per row."""
    classes = levels_of(df, label)
    guess = F.element_at(F.array(*[F.lit(c) for c in classes]), (F.floor(unit_hash(seed, F.col(key)) * len(classes)) + 1).cast("int"))
    return df.agg(F.avg((guess == F.col(label)).cast("double")).alias("accuracy"))


def avg_pool(vec: Column, size: int, parts: int) -> Column:
    """Means of ``parts`` equal stretches of an array of ``size`` numbers."""
    width = size // parts

    def mean_of(i: Column) -> Column:
        window = F.slice(vec, i * width + 1, width)
        return F.aggregate(window, F.lit(0.0), lambda acc, v: acc + v) / width

    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), mean_of)
