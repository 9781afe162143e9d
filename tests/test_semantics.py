"""Decisions D1-D16 of the survey that the fixtures do not already pin down."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from areacast.operators.aggregates import centre_counts, daily_total, row_count
from areacast.operators.export import MONTHLY_HEADER
from areacast.operators.trend import active_day_semi_join, active_keys, fit_trend, trend_moments
from areacast.plans.queries import monthly_avg_per_centre
from areacast.sources import write_report


def test_duplicate_centre_names_are_counted_twice(spark):
    """Rows are counted, not distinct names."""
    df = spark.createDataFrame([("ABR", "C1"), ("ABR", "C1"), ("ABR", None)], "area string, centre string")
    r = centre_counts(df).collect()[0]
    assert (r.n_centres, r.n_named_centres) == (3, 2)


def test_sums_beyond_32_bits_do_not_wrap(spark):
    """3 x 2^30 overflows an int but not a bigint."""
    big = 2 ** 30
    summary = spark.createDataFrame([(dt.date(2021, 3, d), "ABR", big) for d in (2, 3, 4)],
                                    "date date, area string, total bigint")
    centres = spark.createDataFrame([("ABR", "C1")], "area string, centre string")
    out = monthly_avg_per_centre(centres, summary, "2021-01-01", "2021-05-31").collect()
    assert out[0].avg_per_centre == 3 * big // 31


def test_writer_errors_raise(spark, tmp_path):
    """A failing write is not swallowed."""
    blocker = tmp_path / "file"
    blocker.write_text("x")
    lines = spark.createDataFrame([("(ABR,Gennaio)", "1")], "label string, value string")
    with pytest.raises(Exception):
        write_report(lines, str(blocker / "under-a-file"), MONTHLY_HEADER)


def test_active_days_count_only_positive_days_but_fit_uses_all(spark):
    """D6 / D7 on the operators: one positive day and one zero day is not
    enough; two positive days plus a zero day fit three points."""
    rows = [(dt.date(2021, 2, 1), "CAL", "b", 5), (dt.date(2021, 2, 2), "CAL", "b", 0),
            (dt.date(2021, 2, 3), "CAL", "b", 5), (dt.date(2021, 2, 1), "BAS", "b", 10),
            (dt.date(2021, 2, 5), "BAS", "b", 0)]
    df = spark.createDataFrame(rows, "date date, area string, age_band string, doses bigint")
    keys = {r.area: r.active_days for r in active_keys(df).collect()}
    assert keys == {"CAL": 2}
    kept = {r.area for r in active_day_semi_join(df).collect()}
    assert kept == {"CAL"}
    m = trend_moments(df).where("area = 'CAL'").collect()[0]
    assert (m.n, m.sx, m.sy, m.sxy, m.sxx) == (3, 6, 10, 20, 14)
    fit = fit_trend(trend_moments(df).where("area = 'CAL'")).collect()[0]
    assert (fit.slope, fit.intercept) == (0.0, 10 / 3)


def test_daily_total_sums_suppliers(spark):
    rows = [(dt.date(2021, 2, 1), "P", "ABR", "b", 10), (dt.date(2021, 2, 1), "M", "ABR", "b", 2)]
    df = spark.createDataFrame(rows, "date date, supplier string, area string, age_band string, doses bigint")
    assert daily_total(df).collect()[0].doses == 12
    assert row_count(df).collect()[0].n_rows == 2


def test_negative_forecast_truncates_toward_zero(spark):
    """Negative forecasts are kept and truncate toward zero (-0.5 gives 0)."""
    from areacast.functions.arithmetic import exact_forecast
    # points (1, 3), (2, 1): slope -2, intercept 5; at x0 = 29: -53
    df = spark.createDataFrame([(2, 3, 4, 5, 5, 29)], "n long, sx long, sy long, sxy long, sxx long, x0 int")
    assert df.select(exact_forecast("n", "sx", "sy", "sxy", "sxx", "x0")).collect()[0][0] == -53
    # (1,0),(3,1): slope 1/2, intercept -1/2; at x0=0 -> -0.5 -> 0 (toward zero)
    df2 = spark.createDataFrame([(2, 4, 1, 3, 10, 0)], "n long, sx long, sy long, sxy long, sxx long, x0 int")
    assert df2.select(exact_forecast("n", "sx", "sy", "sxy", "sxx", "x0")).collect()[0][0] == 0
    assert df2.select(F.lit(-7).cast("bigint").alias("a")).select(
        F.call_function("div", "a", F.lit(2))).collect()[0][0] == -3
