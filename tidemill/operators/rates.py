"""The batch job from text measures to typed, checked and enriched rows."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.quality import add_sanity_flag
from tidemill.operators.windows import add_rates
from tidemill.session import stage
from tidemill.sources.files import read_csv_inferred, row_counts, write_csv

MEASURES = ["cases", "deaths", "recoveries"]


def extract_wide(spark: SparkSession, paths: dict[str, str], key: str = "country", variable: str = "date") -> tuple[DataFrame, DataFrame]:
    """Wide CSV files, one per measure with a column for each date, as one long table; and their row counts.

    Column types are inferred. Files of different length are reported by a warning and by the counts, and joined as
    they are: a key and date stay if every file has them. Each file is unpivoted by itself, so the only shuffle is that
    of the joins.
    """
    wide = {measure: read_csv_inferred(spark, path) for measure, path in paths.items()}
    counts = stage(row_counts(wide), "counts")
    if not counts.filter("NOT all_equal").isEmpty():
        warnings.warn(f"the input files differ in length: {', '.join(paths)}", stacklevel=2)
    long = []
    for measure, df in wide.items():
        dates = [c for c in df.columns if c != key]
        kinds = {df.schema[c].dataType for c in dates}
        # One malformed value makes its whole column text; then all of them are taken as text and checked later.
        values = df if len(kinds) < 2 else df.select(key, *[F.col(f"`{c}`").cast("string").alias(c) for c in dates])
        long.append(values.unpivot([key], dates, variable, measure))
    return reduce(lambda a, b: a.join(b, [key, variable]), long), counts


def parse_measures(df: DataFrame) -> DataFrame:
    """Upper-case country, typed date and counts; a flag tells whether every check passed."""
    typed = df.select(
        F.upper("country").alias("country"),
        F.col("date").alias("_text"),
        F.try_to_date("date", "yyyy-MM-dd").alias("date"),
        *[F.col(m).try_cast("int").alias(m) for m in MEASURES],
    )
    checks = [
        F.col("country").isNotNull(),
        F.col("_text").rlike(r"^\d{4}-\d{2}-\d{2}$"),
        F.col("date").isNotNull(),
        *[F.col(m).isNotNull() for m in MEASURES],
    ]
    return add_sanity_flag(typed, checks).drop("_text")


def rates_pipeline(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parse, de-duplicate, add rates and their changes, drop incomplete rows; and a report of processed and failed rows.

    The report is a DataFrame of its own: an ``Observation`` would tie the session to state that
    keeps fitted models with a training summary from being sent to tasks.
    """
    rows = parse_measures(df).dropDuplicates()
    report = rows.agg(F.count(F.lit(1)).alias("processed"), F.count_if(~F.col("sanity_check")).alias("failed"))
    done = add_rates(rows, "country", "date", "cases", {"deaths": "mortality_rate", "recoveries": "recovery_rate"})
    return done.na.drop(), report


def rates_job(spark: SparkSession, paths: dict[str, str], target: str) -> DataFrame:
    """The whole job: three wide files to the ordered CSV table at ``target``; returns its report (one row).

    The long table is written once and read by the report and by the output, so the files are scanned once.
    """
    long, counts = extract_wide(spark, paths)
    done, report = rates_pipeline(stage(long, "rates"))
    write_csv(done.orderBy("country", "date"), target)
    return report.join(counts.agg(F.bool_and("all_equal").alias("all_equal")))
