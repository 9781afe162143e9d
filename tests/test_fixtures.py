"""The three queries on the hand-computed fixtures, read from CSV."""

import datetime as dt

import pytest
from fixtures import (
    C1_EXPECTED,
    C2_EXPECTED,
    C2_FULL_RANKING,
    C3_EXPECTED,
    CENTRES_CSV,
    DETAIL_CSV,
    SUMMARY_CSV,
)

from areacast.plans.queries import (
    forecast_ranking,
    forecast_top5,
    monthly_avg_per_centre,
    monthly_avg_per_centre_sql,
)
from areacast.sources import read_centres, read_daily_detail, read_daily_summary


@pytest.fixture
def inputs(spark, write_text):
    return (read_centres(spark, write_text("a/centres.csv", CENTRES_CSV)),
            read_daily_summary(spark, write_text("b/summary.csv", SUMMARY_CSV)),
            read_daily_detail(spark, write_text("c/detail.csv", DETAIL_CSV)))


def test_c1_open_window_integer_average(inputs):
    centres, summary, _ = inputs
    out = monthly_avg_per_centre(centres, summary, "2021-01-01", "2021-05-31")
    assert out.columns == ["area", "month", "avg_per_centre"]
    assert [tuple(r) for r in out.collect()] == C1_EXPECTED  # also checks the order
    assert dict(out.dtypes) == {"area": "string", "month": "int", "avg_per_centre": "bigint"}


def test_c3_closed_window_real_average(spark, inputs):
    centres, summary, _ = inputs
    out = monthly_avg_per_centre_sql(spark, centres, summary, "2021-01-01", "2021-05-31")
    got = {(r.area, r.month): round(r.avg_per_centre, 6) for r in out.collect()}
    assert got == C3_EXPECTED
    assert dict(out.dtypes)["avg_per_centre"] == "double"


def test_c2_forecast_top5(inputs):
    _, _, detail = inputs
    out = forecast_top5(detail, "2021-01-31", "2021-06-01")
    got = [(str(r.date), r.age_band, [(e.forecast, e.area) for e in r.top]) for r in out.collect()]
    assert got == C2_EXPECTED


def test_c2_full_ranking_and_prefix(inputs):
    _, _, detail = inputs
    full = forecast_ranking(detail, "2021-01-31", "2021-06-01", k=100)
    by_date = {}
    for r in full.orderBy("date", "rank").collect():
        by_date.setdefault(str(r.date), []).append((r.forecast, r.area))
    assert by_date == C2_FULL_RANKING
    top = forecast_top5(detail, "2021-01-31", "2021-06-01").collect()
    for r in top:  # top-k is a prefix of the full ranking
        assert [(e.forecast, e.area) for e in r.top] == by_date[str(r.date)][:5]


def test_c2_without_the_decoy_column(spark, inputs):
    """Column 4 must not be read: ABR's first day sums to 12, not 12 + 6."""
    _, _, detail = inputs
    assert "other" not in detail.columns
    day = detail.where("area = 'ABR' and date = date'2021-02-01'").groupBy().sum("doses")
    assert day.collect()[0][0] == 12


def test_c1_is_floor_of_real_average_on_same_measure(spark, inputs):
    """For non-negative totals and the same window and centre measure, the
    integer average equals the floor of the real one."""
    centres, summary, _ = inputs
    c1 = {(r.area, r.month): r.avg_per_centre
          for r in monthly_avg_per_centre(centres, summary, "2021-01-01", "2021-05-31",
                                          closed=True).collect()}
    c3 = monthly_avg_per_centre_sql(spark, centres, summary, "2021-01-01", "2021-05-31")
    month_no = {dt.date(2021, m, 1).strftime("%b"): m for m in range(1, 13)}
    for r in c3.collect():
        assert c1[(r.area, month_no[r.month])] == int(r.avg_per_centre)
