"""Calendar projections: leap and common February, December to January."""

import datetime as dt

from pyspark.sql import functions as F

from areacast.functions import calendar as cal


def _row(spark, d):
    df = spark.createDataFrame([(d,)], "d date")
    return df.select(
        cal.month_start("d").alias("ms"), cal.days_in_month("d").alias("days"),
        cal.forecast_day("d").alias("x0"), cal.next_month_start("d").alias("nxt"),
        cal.month_index0("d").alias("i0"), cal.month_number("d").alias("m"),
        cal.month_name_upper("d").alias("up"), cal.month_abbr("d").alias("ab"),
        cal.month_label_it("d").alias("it"), cal.day_of_month("d").alias("dom"),
    ).collect()[0]


def test_february_leap_and_common(spark):
    leap, common = _row(spark, dt.date(2020, 2, 10)), _row(spark, dt.date(2021, 2, 10))
    assert (leap.days, leap.x0) == (29, 30)
    assert (common.days, common.x0) == (28, 29)
    assert common.nxt == dt.date(2021, 3, 1)


def test_december_rolls_to_next_year(spark):
    r = _row(spark, dt.date(2021, 12, 31))
    assert (r.ms, r.nxt, r.days, r.i0, r.m) == (dt.date(2021, 12, 1), dt.date(2022, 1, 1), 31, 11, 12)
    assert (r.up, r.ab, r.it, r.dom) == ("DECEMBER", "Dec", "Dicembre", 31)


def test_all_month_labels(spark):
    df = spark.range(1, 13).select(F.make_date(F.lit(2021), F.col("id").cast("int"), F.lit(1)).alias("d"))
    got = [r.it for r in df.select(cal.month_label_it("d").alias("it")).collect()]
    assert got == ["Gennaio", "Febbraio", "Marzo", "Aprile", "Maggio", "Giugno", "Luglio",
                   "Agosto", "Settembre", "Ottobre", "Novembre", "Dicembre"]


def test_single_day_month_has_no_fit(spark):
    """A month with one day of data cannot be fitted: the forecast is null."""
    from areacast.operators.trend import forecast_next_month, trend_moments
    df = spark.createDataFrame([(dt.date(2021, 4, 30), "ABR", "20-29", 7)],
                               "date date, area string, age_band string, doses bigint")
    out = forecast_next_month(trend_moments(df)).collect()
    assert out[0].forecast is None and out[0].date == dt.date(2021, 5, 1)


def test_forecast_uses_true_february_length(spark):
    """Points (1, 10), (2, 12): the line 8 + 2x is evaluated at day 30 in a
    leap February (68) and at day 29 in a common one (66)."""
    from areacast.plans.queries import forecast_ranking
    rows = [(dt.date(y, 2, d), "P", "ABR", "b", v) for y in (2020, 2021) for d, v in ((1, 10), (2, 12))]
    df = spark.createDataFrame(rows, "date date, supplier string, area string, age_band string, doses bigint")
    got = {r.date: r.forecast for r in forecast_ranking(df).collect()}
    assert got == {dt.date(2020, 3, 1): 68, dt.date(2021, 3, 1): 66}


def test_december_forecast_lands_in_next_year(spark):
    from areacast.plans.queries import forecast_ranking
    rows = [(dt.date(2021, 12, d), "P", "ABR", "b", v) for d, v in ((30, 5), (31, 6))]
    df = spark.createDataFrame(rows, "date date, supplier string, area string, age_band string, doses bigint")
    got = [(r.date, r.forecast) for r in forecast_ranking(df).collect()]
    assert got == [(dt.date(2022, 1, 1), 7)]   # line -25 + x at day 32
