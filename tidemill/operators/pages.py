"""Fields from stored HTML by position and pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: patterns of the page fields
LANG = 'lang="([a-z-]+)"'
TITLE = "<title>([^<]*)</title>"
HEADLINE = "<h1>([^<]*)</h1>"
LINK = '<a href="([^"]*)"'
UNIT_VALUE = "track\\(([0-9]+)\\)"


def first_match(html: Column, pattern: str) -> Column:
    """First group of the first match, null when there is none."""
    return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))


def all_matches(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def number_of(c: Column, unit: str = "°") -> Column:
    """Whole number of a text after its unit has been removed."""
    return F.trim(F.replace(c, F.lit(unit), F.lit(""))).try_cast("int")


def page_fields(pages: DataFrame) -> DataFrame:
    html = F.col("html")
    links = all_matches(html, LINK)
    return pages.select(
        "page_id",
        first_match(html, LANG).alias("lang"),
        first_match(html, TITLE).alias("title"),
        F.trim(F.regexp_replace(first_match(html, HEADLINE), "[*#%$]+", "")).alias("headline"),
        F.size(links).alias("n_links"),
        F.try_element_at(links, F.lit(3)).alias("third_link"),
        number_of(F.concat(first_match(html, UNIT_VALUE), F.lit("°"))).alias("value"),
    )


def with_daily_band(hourly: DataFrame, day: str, value: str) -> DataFrame:
    """Each row next to the lowest and highest value of its day."""
    band = hourly.groupBy(day).agg(F.min(value).alias("day_min"), F.max(value).alias("day_max"))
    return hourly.join(band, day)
