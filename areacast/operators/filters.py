"""Row filters. Plain column predicates, so Catalyst pushes them to the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DateLike = str | dt.date


def as_date(v: DateLike) -> dt.date:
    """A window bound as a date: ISO text, a date, or a datetime (its day)."""
    if isinstance(v, dt.datetime):
        return v.date()
    return v if isinstance(v, dt.date) else dt.date.fromisoformat(v)


def _date(v: DateLike):
    return F.lit(as_date(v))


def within(df: DataFrame, column: str, lo: DateLike, hi: DateLike,
           closed: bool = False) -> DataFrame:
    """Rows with ``lo < column < hi`` (open) or ``lo <= column <= hi`` (closed)."""
    c = F.col(column)
    if closed:
        cond = (c >= _date(lo)) & (c <= _date(hi))
    else:
        cond = (c > _date(lo)) & (c < _date(hi))
    return df.where(cond)


def not_contains(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose ``column`` does not contain ``text`` (a null does
    not contain it, so its row is kept)."""
    return df.where(~F.coalesce(F.col(column).contains(text), F.lit(False)))


def equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) > 0)
