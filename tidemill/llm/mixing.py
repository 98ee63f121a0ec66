"""Mixing of sources by temperature: weights proportional to (token share)^a, realised as permuted blocks.

The exponent a lies between 0 (all sources alike) and 1 (as found). It is found by bisection on sums over the
table of sources, several candidates at a time, so that the mixture reaches a target entropy, and raised as far
as a limit on repetition asks for. The budget of a source is its weight times the token budget: whole passes
over its documents, and one more pass that ends where the budget is used up. A pass visits the documents in a
pseudo-random order; where the last pass ends is found from token sums over hash ranges, so no source is
gathered or sorted as a whole.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.joins import bounded
from tidemill.session import stage

RANGES = 4096
STEPS, ROUNDS = 32, 6


def token_count(text) -> F.Column:
    """Words between white space; null and blank texts have none."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))
    return words.cast("long")


def source_totals(docs: DataFrame, source_col: str, tokens_col: str) -> DataFrame:
    return docs.groupBy(F.col(source_col).alias("src")).agg(F.sum(tokens_col).alias("total"))


def find_exponent(totals: DataFrame, entropy: float | None, repetitions: float | None, budget: float | None) -> float:
    """The largest a at which the mixture's entropy reaches ``entropy`` times that of equal weights, raised until no
    source is read more than ``repetitions`` times; 1 without targets. Each round is one row from the sources' table."""
    filled = totals.filter("total > 0").select(F.col("total").cast("double").alias("t"))
    facts = filled.agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("all"), F.max("t").alias("top")).first()
    if facts["n"] < 2:
        return 1.0
    all_tokens, top = facts["all"], facts["top"]

    def met(exponents: list[float]) -> list[tuple[float, float]]:
        """Entropy over its greatest value, and most repetitions, by exponent."""
        share = F.col("t") / top
        sums = filled.agg(*[
            e.alias(f"{n}{i}") for i, a in enumerate(exponents) for n, e in (
                ("z", F.sum(F.pow(share, F.lit(a)))), ("l", F.sum(F.pow(share, F.lit(a)) * F.log(share) * a)),
                ("r", F.max(F.pow(share, F.lit(a)) / F.col("t"))), ("s", F.min(F.pow(share, F.lit(a)) / F.col("t"))))
        ]).first()
        out = []
        for i in range(len(exponents)):
            z, l, r, s = (sums[f"{n}{i}"] for n in "zlrs")
            out.append(((math.log(z) - l / z) / math.log(facts["n"]), r / s if budget is None else r / z * budget))
        return out

    def bisect(good) -> float:
        """Last exponent at which ``good`` holds, if it holds from 0 up to some point."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * i / STEPS for i in range(STEPS + 1)]
            flags = [good(x) for x in met(grid)]
            if all(flags):
                return high
            first = flags.index(False)
            if first == 0:
                return low
            low, high = grid[first - 1], grid[first]
        return low

    a = 1.0 if entropy is None else bisect(lambda x: x[0] >= entropy)
    if repetitions is not None and met([a])[0][1] > repetitions:
        a = 1.0 if met([1.0])[0][1] > repetitions else bisect(lambda x: x[1] > repetitions) + 1.0 / STEPS**ROUNDS
    return min(a, 1.0)




def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", entropy: float | None = 0.98, repetitions: float | None = 2.0,
    budget: float | None = None, blocks: int = 64, seed: int = 11,
) -> DataFrame:
    """The columns of ``docs`` with n_tokens, weight (of the source), epoch (from 1), block (from 0) and place, one row per reading of a document.

    Without ``budget`` it is the least number of tokens at which every source is read once as a whole, so that no
    document is left out. Within a block rows are read in order of place. The null source is a source of its own;
    documents without words belong to their source's passes and cost nothing. Repeated rows are documents of their
    own. A source without any words is read once. Columns of the added names are replaced, others stay whatever their
    names; an empty table stays empty.
    """
    added = ["n_tokens", "weight", "epoch", "block", "place"]
    # The row travels as one value, so that no column of it meets a name used here.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).alias("_row")
    sized = docs.select(row, F.col(f"`{source_col}`").alias("src"), token_count(F.col(f"`{text_col}`")).alias("n_tokens"), F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("_h"))
    sizes = stage(sized.select("src", "n_tokens", "_h"), "sizes")
    totals = stage(source_totals(sizes, "src", "n_tokens"), "sources")
    a = find_exponent(totals, entropy, repetitions, budget)
    facts = totals.filter("total > 0").agg(F.sum("total").alias("all"), F.sum(F.pow(F.col("total").cast("double"), F.lit(a))).alias("z"), F.max(F.pow(F.col("total").cast("double"), F.lit(1 - a))).alias("full")).first()
    z, tokens = facts["z"] or 1.0, budget if budget is not None else (facts["z"] or 0.0) * (facts["full"] or 0.0)
    quota = F.col("weight") * tokens
    # Rounding must not cost the largest source its last document.
    passes = F.when(F.col("total") == 0, F.lit(1.0)).otherwise(F.round(quota / F.col("total"), 9))
    plan = totals.withColumn("weight", F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.pow(F.col("total").cast("double"), F.lit(a)) / z)).select(
        "src", "total", "weight", F.floor(passes).alias("whole"), F.floor((passes - F.floor(passes)) * F.col("total")).cast("long").alias("rest"), passes.alias("passes")
    )
    plan = stage(plan, "plan")

    # Where the last pass ends: first the hash range, then the place inside it.
    width = (1 << 64) // RANGES
    range_of = F.floor(F.col("_h") / F.lit(float(width))).cast("int")
    ranged = sizes.withColumn("_range", range_of).groupBy("src", "_range").agg(F.sum("n_tokens").alias("sum"))
    upto = Window.partitionBy("src").orderBy("_range")  # at most RANGES + 1 rows a source
    placed = ranged.withColumn("_before", F.sum("sum").over(upto) - F.col("sum"))
    same_src = F.col("src").eqNullSafe(F.col("p_src"))
    wanted = bounded(plan.select(F.col("src").alias("p_src"), "rest"))
    edge = placed.join(wanted, same_src).filter("_before <= rest").groupBy("src").agg(F.max(F.struct("_range", "_before", "rest")).alias("e"))
    edge = stage(edge.select(F.col("src").alias("p_src"), F.col("e._range").alias("_edge"), "e._before", "e.rest"), "edges")
    inside = sizes.join(bounded(edge), same_src & (range_of == F.col("_edge"))).select("src", "_h", "n_tokens", "_before", "rest")
    by_hash = inside.groupBy("src", "_h").agg(F.sum("n_tokens").alias("sum"), F.first("_before").alias("_before"), F.first("rest").alias("rest"))
    run = Window.partitionBy("src").orderBy("_h")  # one hash range in RANGES of a source
    cuts = by_hash.withColumn("_upto", F.col("_before") + F.sum("sum").over(run)).filter("_upto <= rest").groupBy("src").agg(F.max("_h").alias("cut"))
    lows = edge.select("p_src", F.col("_edge").alias("low"))
    limits = plan.join(cuts.withColumnRenamed("src", "c_src"), F.col("src").eqNullSafe(F.col("c_src")), "left").drop("c_src").join(lows, same_src, "left").select(
        F.col("src").alias("p_src"), "weight", "whole", "rest", "passes", "cut", "low"
    )
    limits = bounded(stage(limits, "limits"))
    joined = sized.join(limits, same_src, "left")
    again = (F.col("rest") > 0) & F.coalesce((F.col("cut").isNotNull() & (F.col("_h") <= F.col("cut"))) | (range_of < F.col("low")), F.lit(False))
    copies = (F.col("whole") + again.cast("long")).cast("int")
    read = joined.withColumn("epoch", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
    # A pass is spread over its share of the blocks in the order of its own hash.
    unit = F.pmod(F.when(F.col("epoch") > F.col("whole"), F.col("_h").cast("double") / 2.0**64 + 0.5).otherwise(F.xxhash64("_h", "epoch").cast("double") / 2.0**64 + 0.5), F.lit(1.0))
    block = F.least(F.floor((F.col("epoch") - 1 + unit) / F.greatest("passes", F.lit(1e-9)) * blocks), F.lit(blocks - 1)).cast("int")
    return read.select("_row.*", "n_tokens", "weight", "epoch", block.alias("block"), F.xxhash64(F.lit(seed + 1), "_h", "epoch").alias("place"))
