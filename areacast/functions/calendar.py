"""Calendar projections of a date column.

Months are keyed by their first day (``trunc(d, 'MM')``), so a key carries its
year and every length is taken from the true calendar.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from areacast.functions._cols import ColumnOrName, col

# Month labels of the monthly report, January first.
ITALIAN_MONTHS = (
    "Gennaio", "Febbraio", "Marzo", "Aprile", "Maggio", "Giugno",
    "Luglio", "Agosto", "Settembre", "Ottobre", "Novembre", "Dicembre",
)


def month_start(d: ColumnOrName) -> Column:
    """First day of the month of ``d`` (a date)."""
    return F.trunc(col(d), "MM")


def month_number(d: ColumnOrName) -> Column:
    """Month of the year, 1 to 12."""
    return F.month(col(d))


def month_index0(d: ColumnOrName) -> Column:
    """Month of the year, 0 to 11."""
    return F.month(col(d)) - F.lit(1)


def month_name_upper(d: ColumnOrName) -> Column:
    """English month name in upper case, e.g. ``JANUARY``."""
    return F.upper(F.date_format(col(d), "MMMM"))


def month_abbr(d: ColumnOrName) -> Column:
    """Short English month name, e.g. ``Jan``."""
    return F.date_format(col(d), "MMM")


def month_label_it(d: ColumnOrName) -> Column:
    """Italian month name used by the monthly report."""
    names = F.array(*[F.lit(n) for n in ITALIAN_MONTHS])
    return F.element_at(names, F.month(col(d)))


def days_in_month(d: ColumnOrName) -> Column:
    """Number of days in the month of ``d``, true calendar (leap years too)."""
    return F.dayofmonth(F.last_day(col(d)))


def day_of_month(d: ColumnOrName) -> Column:
    return F.dayofmonth(col(d))


def forecast_day(d: ColumnOrName) -> Column:
    """The x of the first day of the next month: last day of the month + 1."""
    return days_in_month(d) + F.lit(1)


def next_month_start(d: ColumnOrName) -> Column:
    """First day of the month after the month of ``d``."""
    return F.add_months(month_start(d), 1)
