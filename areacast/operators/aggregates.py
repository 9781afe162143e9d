"""Grouped aggregates. Each is one ``groupBy().agg()``: Spark runs a partial
aggregate before the shuffle and a final one after, so a hot key is reduced
map-side before it reaches a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.functions.arithmetic import required
from areacast.functions.calendar import month_start


def monthly_total(df: DataFrame, key: str = "area", date: str = "date",
                  value: str = "total", out: str = "total") -> DataFrame:
    """Sum of ``value`` per (key, month); a null value raises. Columns: key, month_start, out."""
    return (df.groupBy(F.col(key), month_start(date).alias("month_start"))
              .agg(F.sum(required(value)).alias(out)))


def centre_counts(df: DataFrame, key: str = "area", name: str = "centre") -> DataFrame:
    """Centres per area: ``n_centres`` counts rows, ``n_named_centres`` counts
    non-null names. Neither is a distinct count."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_centres"),
        F.count(F.col(name)).alias("n_named_centres"),
    )


def daily_total(df: DataFrame, keys: Sequence[str] = ("date", "area", "age_band"),
                value: str = "doses", out: str = "doses") -> DataFrame:
    """Sum of ``value`` over the rows sharing ``keys`` (e.g. over suppliers); a
    null value raises."""
    return df.groupBy(*keys).agg(F.sum(required(value)).alias(out))


def count_by_key(df: DataFrame, keys: Sequence[str], out: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def key_count(df: DataFrame, keys: Sequence[str], out: str = "n_keys") -> DataFrame:
    """One-row frame with the number of distinct ``keys`` (distinct, then a
    global count; both aggregate partially before their shuffle)."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias(out))


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    """One-row frame with the row count (global aggregate, partial per task)."""
    return df.agg(F.count(F.lit(1)).alias(out))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()
