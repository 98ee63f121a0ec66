"""Small golden cases for semantics that are easy to lose."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemill.functions import scalars as S
from tidemill.operators import edits, loads, quality, summaries
from tidemill.operators import risk as R
from tidemill.operators import windows as W
from tidemill.operators.rates import rates_pipeline
from tidemill.plans.joins import order_payments
from tidemill.plans.sets import observed_and_predicted


def test_rate_change_drops_first_row_and_zero_rates(spark):
    rows = [("A", d, c, x, x) for d, c, x in ((1, 10, 1), (2, 10, 2), (3, 0, 1), (4, 10, 0), (5, 10, 5), (6, 10, 10))]
    df = spark.createDataFrame(rows, "country string, day int, cases int, deaths int, recoveries int")
    kept = W.add_rates(df, "country", "day", "cases", {"deaths": "m", "recoveries": "r"}).na.drop().collect()
    assert [(r["day"], r["m_change"]) for r in kept] == [(2, 1.0), (6, 1.0)]


def test_bands_first_match_wins_and_null_is_six(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 24.9, 25.0, 34.9, 35.0, 49.9, 75.0, None)], "v double")
    strict = S.band_class(F.col("v"), S.AQI_BANDS["pm2_5"], null_class=None)
    out = df.select(S.band_class(F.col("v"), S.AQI_BANDS["pm2_5"]).alias("c"), strict.alias("s")).collect()
    assert [r["c"] for r in out] == [6, 1, 3, 3, 3, 4, 4, 6, 6]
    assert out[-1]["s"] is None


def test_predictions_need_a_new_day_and_a_new_hour(spark):
    observed = spark.createDataFrame([("d1", "11:00", 1.0)], "day string, hour string, v double")
    predicted = spark.createDataFrame([("d1", "23:00", 2.0), ("d2", "11:00", 3.0), ("d2", "23:00", 4.0)], observed.schema)
    assert {r["v"] for r in observed_and_predicted(observed, predicted).collect()} == {1.0, 4.0}
    assert {r["v"] for r in observed_and_predicted(observed, predicted, exact_hours=True).collect()} == {1.0, 2.0, 3.0, 4.0}


def test_half_day_frame_has_thirteen_rows(spark):
    rows = [(dt.date(2024, 1, 1), f"{h:02d}:00", float(h)) for h in range(24)]
    out = W.half_day_averages(spark.createDataFrame(rows, "day date, hour string, v double"), ["v"]).orderBy("hour").collect()
    assert [(r["hour"], r["avg_v"]) for r in out] == [("11:00", 5.5), ("23:00", 17.0)]


def test_ordinals_and_centuries(spark):
    days = [dt.date(2024, 3, d) for d in (1, 2, 3, 11, 21, 22, 23, 31)] + [dt.date(1900, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    c = F.col("d")
    out = df.select(S.ordinal_date(c).alias("o"), S.ordinal_date(c, True).alias("e"), S.century_label(c).alias("c"), S.century_label(c, True).alias("x")).collect()
    assert out[0]["o"] == "Friday 1st March 2024"
    assert [r["o"].split()[1] for r in out[3:8]] == ["11th", "21th", "22th", "23th", "31th"]
    assert [r["e"].split()[1] for r in out[3:8]] == ["11th", "21st", "22nd", "23rd", "31st"]
    assert (out[0]["c"], out[0]["x"], out[8]["c"], out[8]["x"]) == ("21th Century", "21st Century", "20th Century", "19th Century")


def test_text_numbers_and_dates(spark):
    texts = ["285,875", "67,175,000", "12", "n/a", "", "1234", "-5", "1.23456", None]
    df = spark.createDataFrame([(v,) for v in texts], "v string")
    volumes = [r[0] for r in df.select(S.parse_volume(F.col("v"))).collect()]
    assert volumes[:3] == [Decimal(285875), Decimal(67175000), Decimal(12)] and volumes[3:] == [None] * 6
    assert df.select(S.parse_volume(F.col("v")).alias("a")).schema["a"].dataType.simpleString() == "decimal(15,0)"
    assert df.select(S.parse_price(F.col("v")).alias("a")).schema["a"].dataType.simpleString() == "decimal(18,2)"
    dates = spark.createDataFrame([(v,) for v in ("1/2/2024", "1/12/2024", "11/2/2024", "11/12/2024", "2024-01-02", "x11/12/2024")], "v string")
    parsed = [r[0] for r in dates.select(S.parse_us_date(F.col("v"))).collect()]
    assert parsed == [dt.date(2024, 1, 2), dt.date(2024, 1, 12), dt.date(2024, 11, 2), dt.date(2024, 11, 12), None, None]


def test_word_count_and_cleaning(spark):
    df = spark.createDataFrame([("",), (" one ",), ("a  b",), ('"x" y',)], "v string")
    out = df.select(S.word_count(F.col("v")).alias("n"), S.clean_string(F.col("v")).alias("c")).collect()
    assert [r["n"] for r in out] == [1, 1, 3, 2]
    assert out[3]["c"] == "x y"


def test_updates_run_in_sequence_and_unknown_rows_stay(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, s string")
    out = edits.update_where(df, [(F.col("s") == "a", {"s": F.lit("b")}), (F.col("s") == "b", {"s": F.lit("c")})])
    assert {r["id"]: r["s"] for r in out.collect()} == {1: "c", 2: "c", 3: None}
    assert {r["id"] for r in edits.delete_where(df, F.col("s") == "a").collect()} == {2, 3}


def test_upsert_and_partial_observations(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    staged = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert {(r["k"], r["v"]) for r in loads.upsert(target, staged, "k").collect()} == {(1, "a"), (2, "B"), (3, "C")}
    assert {(r["k"], r["v"]) for r in loads.insert_ignore(target, staged, "k").collect()} == {(1, "a"), (2, "b"), (3, "C")}
    seen = spark.createDataFrame([("d", 1, "5", None), ("d", 2, None, "7")], "day string, at int, open string, close string")
    merged = loads.merge_observations(seen, ["day"], ["at"], ["open", "close"]).first()
    assert (merged["open"], merged["close"]) == ("5", "7")


@pytest.mark.parametrize("now,logical,days", [
    ("2024-01-10 00:00:00", "2024-01-10 00:00:00", 1), ("2024-01-10 05:00:00", "2024-01-08 06:00:00", 2),
    ("2024-01-10 00:00:00", "2024-01-20 00:00:00", 0), ("2024-12-31 00:00:00", "2024-01-01 00:00:00", 92),
])
def test_lookback_is_clamped(spark, now, logical, days):
    c = loads.lookback_days(F.lit(now).cast("timestamp_ntz"), F.lit(logical).cast("timestamp_ntz"))
    assert spark.range(1).select(c).first()[0] == days


def test_sanity_flag_needs_every_check(spark):
    df = spark.createDataFrame([("2024-01-02",), ("x2024-01-02",), (None,)], "d string")
    checks = [F.col("d").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date("d", "yyyy-MM-dd").isNotNull()]
    assert [r["sanity_check"] for r in quality.add_sanity_flag(df, checks).collect()] == [True, False, False]


def test_payments_default_to_zero(spark):
    orders = spark.createDataFrame([(1, Decimal("10.00")), (2, Decimal("5.00"))], "order_id int, total_amount decimal(10,2)")
    paid = spark.createDataFrame([(1, Decimal("4.00")), (1, Decimal("6.00"))], "order_id int, amount decimal(10,2)")
    out = {r["order_id"]: r for r in order_payments(orders, paid).collect()}
    assert out[1]["is_fully_paid"] and out[1]["payment_count"] == 2
    assert not out[2]["is_fully_paid"] and out[2]["outstanding_amount"] == Decimal("5.00")


def test_risk_responses(spark):
    risks = spark.createDataFrame([("Market", "Likely", "Moderate"), ("Rules", "Possible", "Major"), ("Tech", "Unlikely", "Minor"), ("Rivals", "Likely", "Minor")],
                                  "risk string, likelihood string, impact string")
    responses = spark.createDataFrame([("Tech", "avoid", None, None), ("Rules", "transfer", None, None), ("Market", "mitigate", "Possible", None), ("Rivals", "accept", None, None)],
                                      "risk string, action string, new_likelihood string, new_impact string")
    out = {r["risk"]: (r["score"], r["response"]) for r in R.apply_responses(risks, responses).collect()}
    assert out == {"Market": (9, None), "Rules": (12, "Transferred"), "Rivals": (8, "Accepted")}


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 0, 10)], "v double")
    assert [r["n"] for r in summaries.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 1]


def test_rates_job_reports_failed_rows(spark):
    rows = [("a", "2024-01-01", "10", "1", "1"), ("a", "2024-01-02", "10", "2", "4"), ("a", "2024-01-02", "10", "2", "4"), ("a", "x2024-01-03", "n/a", "1", "1")]
    done, report = rates_pipeline(spark.createDataFrame(rows, "country string, date string, cases string, deaths string, recoveries string"))
    assert [(r["country"], r["mortality_rate_change"], r["recovery_rate_change"]) for r in done.collect()] == [("A", 1.0, 3.0)]
    assert tuple(report.first()) == (3, 1)
