"""The three composed queries.

C1  monthly_avg_per_centre      average daily count per centre, by area and
                                month, as an integer (open date window)
C3  monthly_avg_per_centre_sql  the same average in Spark SQL, as a real number
                                (closed date window, non-null centre names)
C2  forecast_top5               per (first day of next month, age band): the
                                five areas with the highest trend forecast

Each returns a lazy DataFrame; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacast.functions.calendar import month_number
from areacast.operators.aggregates import centre_counts, daily_total, monthly_total
from areacast.operators.filters import DateLike, as_date, within
from areacast.operators.joins import per_centre_average
from areacast.operators.ranking import ranked_list, top_k_per_group
from areacast.operators.trend import forecast_next_month, keep_active, trend_moments


def monthly_avg_per_centre(centres: DataFrame, daily: DataFrame, lo: DateLike,
                           hi: DateLike, closed: bool = False) -> DataFrame:
    """``total div centres div days_in_month`` per (area, month).

    ``centres`` is (area, centre), counted by rows; ``daily`` is (date, area,
    total). Rows with ``lo < date < hi`` are used (both ends included when
    ``closed``). Totals are summed per (area, month) before the join, so the
    join sees one row per (area, month) against one row per area. Areas with
    no centre, and centres with no counts, drop out. Sorted by area, then
    month start (chronological across a year end).
    Columns: area, month (1-12), avg_per_centre (bigint).
    """
    totals = monthly_total(within(daily, "date", lo, hi, closed))
    averages = per_centre_average(totals, centre_counts(centres))
    return (averages.orderBy("area", "month_start")
                    .select("area", month_number("month_start").alias("month"), "avg_per_centre"))


MONTHLY_AVG_SQL = """
WITH monthly AS (
  SELECT area, trunc(date, 'MM') AS month_start, sum(total) AS total
  FROM {daily}
  WHERE date >= :lo AND date <= :hi
  GROUP BY area, trunc(date, 'MM')
),
centres_per_area AS (
  SELECT area, count(centre) AS n_centres
  FROM {centres}
  GROUP BY area
)
SELECT m.area AS area,
       date_format(m.month_start, 'MMM') AS month,
       try_divide(m.total, c.n_centres) / day(last_day(m.month_start)) AS avg_per_centre
FROM monthly m
JOIN centres_per_area c ON m.area = c.area
"""


def monthly_avg_per_centre_sql(spark: SparkSession, centres: DataFrame, daily: DataFrame,
                               lo: DateLike, hi: DateLike) -> DataFrame:
    """Per (area, month) the sum of the day totals divided by the number of
    non-null centre names, divided by the days of the month, as a double.

    Both window ends are included. ``sum(total / c) = sum(total) / c`` since c
    is fixed per area, so the totals are summed before the join. A zero count
    gives null. Unordered. Columns: area, month (``Jan``), avg_per_centre.
    """
    return spark.sql(MONTHLY_AVG_SQL, args={"lo": as_date(lo), "hi": as_date(hi)},
                     daily=daily.select("date", "area",
                                        F.col("total").cast("bigint").alias("total")),
                     centres=centres.select("area", "centre"))


def forecast_top5(detail: DataFrame, lo: DateLike, hi: DateLike, k: int = 5,
                  min_active_days: int = 2) -> DataFrame:
    """For each (first day of next month, age band), the ``k`` areas with
    the highest forecast, as an array of struct(forecast, area).

    ``detail`` is (date, supplier, area, age_band, doses). Rows with
    ``lo < date < hi`` are summed over suppliers per day, area and band; a
    (month, area, band) group needs ``min_active_days`` days with a positive
    sum; its least-squares line over (day of month, sum), all its days
    included, is evaluated at day ``days in month + 1`` and truncated. Ties
    rank by area ascending. Sorted by date, age_band.
    """
    top = forecast_ranking(detail, lo, hi, k, min_active_days)
    return (ranked_list(top, ["date", "age_band"], "rank", ["forecast", "area"], k, out="top")
            .orderBy("date", "age_band"))


def forecast_ranking(detail: DataFrame, lo: DateLike | None = None, hi: DateLike | None = None,
                     k: int = 5, min_active_days: int = 2) -> DataFrame:
    """C2 before grouping into lists: (date, age_band, rank, forecast, area).
    Without bounds every date is used."""
    rows = detail if lo is None else within(detail, "date", lo, hi)
    per_day = daily_total(rows, ("date", "area", "age_band"), "doses")
    moments = keep_active(trend_moments(per_day, ("area", "age_band")), min_active_days)
    forecasts = forecast_next_month(moments, ("area", "age_band"))
    return top_k_per_group(forecasts, ["date", "age_band"],
                           [F.desc("forecast"), F.asc("area")], k).select(
        "date", "age_band", "rank", "forecast", "area")
