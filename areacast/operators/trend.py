"""Per-group linear trend over the days of a month, and its next-month forecast.

The least-squares fit is mergeable: it only needs the moment sums
``n, sum(x), sum(y), sum(x*y), sum(x*x)``, which Spark aggregates partially on
each task before the shuffle and merges after it. With integer x (day of
month) and y (daily count) the sums are exact bigints, so the forecast is an
exact rational that is truncated once (see ``exact_forecast``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.functions.arithmetic import exact_forecast, exact_intercept, exact_slope, required
from areacast.functions.calendar import forecast_day, month_start, next_month_start
from areacast.operators.joins import semi_join

MOMENTS = ("n", "sx", "sy", "sxy", "sxx")


def trend_moments(daily: DataFrame, keys: Sequence[str] = ("area", "age_band"),
                  date: str = "date", value: str = "doses") -> DataFrame:
    """One row per (month_start, *keys): the moment sums of the points
    (day of month, value) and ``active_days``, the number of points with a
    positive value. Every point enters the fit, zeros included; days without a
    row are not filled in. A null value raises. Expects one row per date and
    key (``daily_total``)."""
    x = F.dayofmonth(F.col(date)).cast("bigint")
    y = required(value)
    return daily.groupBy(month_start(date).alias("month_start"), *keys).agg(
        F.count_if(y > 0).alias("active_days"),
        F.count(F.lit(1)).alias("n"),
        F.sum(x).alias("sx"),
        F.sum(y).alias("sy"),
        F.sum(x * y).alias("sxy"),
        F.sum(x * x).alias("sxx"),
    )


def keep_active(moments: DataFrame, min_days: int = 2) -> DataFrame:
    """Groups with at least ``min_days`` days of positive value (HAVING)."""
    return moments.where(F.col("active_days") >= min_days)


def active_keys(daily: DataFrame, keys: Sequence[str] = ("area", "age_band"),
                date: str = "date", value: str = "doses", min_days: int = 2) -> DataFrame:
    """(month_start, *keys) with at least ``min_days`` days of positive value."""
    counted = daily.groupBy(month_start(date).alias("month_start"), *keys).agg(
        F.count_if(required(value) > 0).alias("active_days"))
    return counted.where(F.col("active_days") >= min_days)


def active_day_semi_join(daily: DataFrame, keys: Sequence[str] = ("area", "age_band"),
                         date: str = "date", value: str = "doses",
                         min_days: int = 2) -> DataFrame:
    """Rows of ``daily`` whose (month, *keys) group has at least ``min_days``
    active days, as a left semi join against the qualifying keys."""
    with_month = daily.withColumn("month_start", month_start(date))
    kept = semi_join(with_month, active_keys(daily, keys, date, value, min_days),
                     ["month_start", *keys])
    return kept.drop("month_start")


def fit_trend(moments: DataFrame, keys: Sequence[str] = ("area", "age_band")) -> DataFrame:
    """Slope and intercept per group, each one division of exact integers."""
    m = [F.col(c) for c in MOMENTS]
    return moments.select(
        "month_start", *keys, "n",
        exact_slope(*m).alias("slope"),
        exact_intercept(*m).alias("intercept"),
    )


def forecast_next_month(moments: DataFrame,
                        keys: Sequence[str] = ("area", "age_band")) -> DataFrame:
    """Prediction for the first day of the next month, taken as day
    ``last day of month + 1`` on the fitted line, truncated toward zero.
    Negative forecasts are kept. Columns: date, *keys, forecast."""
    m = [F.col(c) for c in MOMENTS]
    return moments.select(
        next_month_start("month_start").alias("date"),
        *keys,
        exact_forecast(*m, forecast_day("month_start")).alias("forecast"),
    )
