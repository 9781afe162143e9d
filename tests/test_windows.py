"""C1, C2 and C3 over other windows (mid-month bounds, a leap February,
spans across year ends) against DuckDB SQL for the same windows."""

import datetime as dt

import pytest
from oracle import compare, duck

from areacast.plans import queries as q
from areacast.plans.oracles import _BASE
from areacast.sources import tables

SF = "/root/testdata/sf0.01"
WINDOWS = [(dt.date(1996, 1, 15), dt.date(1996, 3, 10)),     # leap February
           (dt.date(1997, 11, 12), dt.date(1998, 11, 27)),   # across a year end
           (dt.date(2000, 2, 1), dt.date(2000, 3, 1)),       # leap February only
           (dt.date(1999, 12, 31), dt.date(2000, 1, 2))]     # two-day window


def c1_sql(lo, hi):
    return _BASE + f"""
SELECT m.area, CAST(month(m.ms) AS INTEGER) AS month,
       CAST((m.t // c.n_centres) // dayofmonth(last_day(m.ms)) AS BIGINT) AS avg_per_centre
FROM (SELECT area, CAST(date_trunc('month', date) AS DATE) ms, CAST(SUM(total) AS BIGINT) t
      FROM summary WHERE date > DATE '{lo}' AND date < DATE '{hi}' GROUP BY 1, 2) m
JOIN centre_counts c ON m.area = c.area"""


def c3_sql(lo, hi):
    return _BASE + f"""
SELECT m.area, strftime(m.ms, '%b') AS month,
       (m.t / c.n_named_centres) / dayofmonth(last_day(m.ms)) AS avg_per_centre
FROM (SELECT area, CAST(date_trunc('month', date) AS DATE) ms, CAST(SUM(total) AS BIGINT) t
      FROM summary WHERE date >= DATE '{lo}' AND date <= DATE '{hi}' GROUP BY 1, 2) m
JOIN centre_counts c ON m.area = c.area"""


def c2_sql(lo, hi):
    return _BASE + f"""
SELECT date, age_band, list({{'forecast': forecast, 'area': area}} ORDER BY rk) AS top
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, age_band ORDER BY forecast DESC, area) rk
      FROM (SELECT CAST(ms + INTERVAL 1 MONTH AS DATE) AS date, area, age_band,
                   ((n * sxx - sx * sx) * sy
                    + (n * sxy - sx * sy) * (n * (dayofmonth(last_day(ms)) + 1) - sx))
                   // (n * (n * sxx - sx * sx)) AS forecast
            FROM (SELECT CAST(date_trunc('month', date) AS DATE) ms, area, age_band,
                         COUNT(*) FILTER (WHERE doses > 0) ad, COUNT(*) n,
                         CAST(SUM(dayofmonth(date)) AS BIGINT) sx, CAST(SUM(doses) AS BIGINT) sy,
                         CAST(SUM(dayofmonth(date) * doses) AS BIGINT) sxy,
                         CAST(SUM(dayofmonth(date) * dayofmonth(date)) AS BIGINT) sxx
                  FROM (SELECT date, area, age_band, CAST(SUM(doses) AS BIGINT) doses FROM detail
                        WHERE date > DATE '{lo}' AND date < DATE '{hi}' GROUP BY 1, 2, 3)
                  GROUP BY 1, 2, 3)
            WHERE ad >= 2))
WHERE rk <= 5 GROUP BY date, age_band"""


@pytest.fixture(scope="module")
def inputs(spark):
    return (tables.centres_from_tables(spark, SF), tables.daily_summary_from_tables(spark, SF),
            tables.daily_detail_from_tables(spark, SF), duck(SF))


@pytest.mark.parametrize("lo,hi", WINDOWS)
def test_queries_over_other_windows(spark, inputs, lo, hi):
    centres, summary, detail, con = inputs
    assert compare(q.monthly_avg_per_centre(centres, summary, lo, hi), con, c1_sql(lo, hi)) is None
    assert compare(q.monthly_avg_per_centre_sql(spark, centres, summary, lo, hi), con,
                   c3_sql(lo, hi)) is None
    assert compare(q.forecast_top5(detail, lo, hi), con, c2_sql(lo, hi)) is None
