"""Stored web pages and hourly readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import pages as P
from tidemill.plans.registry import query
from tidemill.sources.tables import day_text


@query("page_fields", f"""
    SELECT page_id, nullif(regexp_extract(html, '{P.LANG}', 1), '') AS lang, nullif(regexp_extract(html, '{P.TITLE}', 1), '') AS title,
      trim(regexp_replace(nullif(regexp_extract(html, '{P.HEADLINE}', 1), ''), '[*#%$]+', '', 'g')) AS headline,
      len(regexp_extract_all(html, '{P.LINK}', 1))::INTEGER AS n_links, regexp_extract_all(html, '{P.LINK}', 1)[3] AS third_link,
      TRY_CAST(regexp_extract(html, '{P.UNIT_VALUE.replace(chr(92) * 2, chr(92))}', 1) AS INTEGER) AS value FROM pages""")
def page_fields(t):
    return P.page_fields(t.pages)


@query("hourly_with_daily_band", """
    WITH h AS (SELECT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:00') AS hour, round(avg(value), 6) AS value FROM events GROUP BY 1, 2)
    SELECT day, hour, value, day_min, day_max FROM h JOIN (SELECT day, min(value) AS day_min, max(value) AS day_max FROM h GROUP BY 1) USING (day)""")
def hourly_with_daily_band(t):
    hourly = t.events.groupBy(day_text("ts").alias("day"), F.date_format("ts", "HH:00").alias("hour")).agg(
        F.round(F.avg("value"), 6).alias("value")
    )
    return P.with_daily_band(hourly, "day", "value")
