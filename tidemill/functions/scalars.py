"""Scalar expressions as plain Column functions (all inlined by Catalyst)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: number formats of the price feed
VOLUME_FORMAT = "990,990,990,990,990"
PRICE_FORMAT = "990,990,990,990,990.9999"

# fixed values: half-open class bands [low, high) per air-quality index; first match wins, anything else is class 6
AQI_BANDS = {
    "overall": [(0, 20), (20, 40), (40, 60), (60, 80), (80, 100)],
    "pm2_5": [(0, 10), (10, 20), (20, 35), (25, 50), (50, 75)],
    "pm10": [(0, 20), (20, 40), (40, 50), (50, 100), (100, 150)],
    "nitrogen_dioxide": [(0, 40), (40, 90), (90, 120), (120, 230), (230, 340)],
    "ozone": [(0, 50), (50, 100), (100, 130), (130, 240), (240, 380)],
    "sulphur_dioxide": [(0, 100), (100, 200), (200, 350), (350, 500), (500, 750)],
}


def clean_text(c: Column) -> Column:
    return F.lower(F.trim(c))


def money(c: Column) -> Column:
    return c.cast("decimal(10,2)")


def clean_string(c: Column) -> Column:
    """Drop double quotes, then surrounding blanks."""
    return F.trim(F.replace(c, F.lit('"'), F.lit("")))


def mmss(minutes: Column, seconds: Column) -> Column:
    return F.format_string("%02d:%02d", minutes, seconds)


def suffix_class(c: Column, rules: dict[str, str], default: str) -> Column:
    """Label of the first suffix that ``c`` ends with."""
    picks = [F.when(c.endswith(suffix), label) for suffix, label in rules.items()]
    return F.coalesce(*picks, F.lit(default))


def word_count(c: Column) -> Column:
    """Blanks inside the trimmed text plus one; an empty text counts as one word."""
    trimmed = F.trim(c)
    return (F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1).cast("int")


def tenure_days(start: Column, end: Column, as_of: str) -> Column:
    """Days from start to end, an open end counting up to ``as_of``."""
    return F.datediff(F.coalesce(end.cast("date"), F.lit(as_of).cast("date")), start.cast("date"))


def century_label(c: Column, exact: bool = False) -> Column:
    """First two digits of the year plus one, always with "th"; ``exact`` gives the calendar century and suffix."""
    if not exact:
        return F.concat((F.substring(F.year(c).cast("string"), 1, 2).cast("int") + 1).cast("string"), F.lit("th Century"))
    number = F.ceil(F.year(c) / 100).cast("int")
    return F.concat(number.cast("string"), ordinal_suffix(number), F.lit(" Century"))


def ordinal_suffix(n: Column) -> Column:
    teen = (n % 100).between(11, 13)
    last = n % 10
    return (
        F.when(teen, "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    )


def ordinal_date(c: Column, exact: bool = False) -> Column:
    """Weekday, day with suffix, month and year; only days 1 to 3 are special unless ``exact``."""
    day = F.dayofmonth(c)
    plain = F.when(day == 1, "st").when(day == 2, "nd").when(day == 3, "rd").otherwise("th")
    suffix = ordinal_suffix(day) if exact else plain
    return F.concat_ws(
        " ",
        F.date_format(c, "EEEE"),
        F.concat(day.cast("string"), suffix),
        F.date_format(c, "MMMM"),
        F.year(c).cast("string"),
    )


def era_label(c: Column) -> Column:
    year = F.year(c)
    # The three label texts.
    return (
        F.when(year < 1900, "19th century and earlier").when(year < 2000, "20th century").otherwise("21th century")
    )


def parse_us_date(c: Column) -> Column:
    """Month/day/year with or without leading zeros; anything else becomes null."""
    return F.try_to_date(c, "M/d/yyyy")


def parse_grouped(c: Column, fmt: str) -> Column:
    """Grouped-digit text to decimal; "n/a", empty and malformed text become null."""
    present = F.when((c != "n/a") & (c != ""), c)
    return F.try_to_number(present, F.lit(fmt))


def parse_volume(c: Column) -> Column:
    return parse_grouped(c, VOLUME_FORMAT)


def parse_price(c: Column) -> Column:
    return F.round(parse_grouped(c, PRICE_FORMAT), 2)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def band_class(c: Column, bands: list[tuple[float, float]], null_class: int | None = 6) -> Column:
    """1-based place of the first half-open band holding ``c``; values outside all bands get the last class."""
    tests = [F.when((c >= low) & (c < high), F.lit(i)) for i, (low, high) in enumerate(bands, 1)]
    classed = F.coalesce(*tests, F.lit(len(bands) + 1))
    if null_class is None:
        return F.when(c.isNotNull(), classed)
    return F.when(c.isNull(), F.lit(null_class)).otherwise(classed)


def upper_bound_class(c: Column, cuts: list[Column], labels: list[str]) -> Column:
    """Label of the first cut that is >= ``c``; the last label for anything above all cuts."""
    chain = reduce(
        lambda acc, pair: F.when(c <= pair[0], pair[1]) if acc is None else acc.when(c <= pair[0], pair[1]),
        zip(cuts, labels[:-1]),
        None,
    )
    return chain.otherwise(labels[-1])


def pad2(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


SQL_FUNCTIONS = {
    "tenure_days": "(start_day DATE, end_day DATE, as_of DATE) RETURNS INT "
    "RETURN datediff(coalesce(end_day, as_of), start_day)",
    "clean_string": "(s STRING) RETURNS STRING RETURN trim(replace(s, '\"', ''))",
    "mmss": "(minutes INT, seconds INT) RETURNS STRING "
    "RETURN concat(lpad(minutes, 2, '0'), ':', lpad(seconds, 2, '0'))",
    "suffix_class": "(s STRING, a STRING, b STRING) RETURNS STRING "
    "RETURN CASE WHEN endswith(s, a) THEN a WHEN endswith(s, b) THEN b ELSE 'other' END",
    "century_label": "(d DATE) RETURNS STRING "
    "RETURN concat(cast(left(cast(year(d) AS STRING), 2) AS INT) + 1, 'th Century')",
    "word_count": "(s STRING) RETURNS INT "
    "RETURN length(trim(s)) - length(replace(trim(s), ' ', '')) + 1",
}

# Counts in another table, which has to be a view of that name.
COUNTING_FUNCTIONS = {
    "line_count": "(wanted BIGINT) RETURNS BIGINT RETURN (SELECT count(*) FROM order_lines WHERE l_orderkey = wanted)",
    "flagged_count": "(wanted BIGINT, flag STRING) RETURNS BIGINT RETURN (SELECT count(*) FROM order_lines WHERE l_orderkey = wanted AND l_returnflag = flag)",
}


def register_sql_functions(spark: SparkSession, views: dict[str, DataFrame] | None = None) -> None:
    """Temporary SQL functions; Catalyst inlines their bodies into the calling query. With the views that they count in,
    the counting functions too: their correlated subqueries become joins with a grouped table."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    for name, body in (SQL_FUNCTIONS | (COUNTING_FUNCTIONS if views else {})).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")


def drop_sql_functions(spark: SparkSession, views: list[str]) -> None:
    """Take functions and views out of the session again; queries analysed before go on working."""
    for name in SQL_FUNCTIONS | COUNTING_FUNCTIONS:
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
    for name in views:
        spark.catalog.dropTempView(name)
