"""Exact integer arithmetic on bigint columns.

``div`` truncates toward zero, like an integer cast of a quotient. Under ANSI
mode an overflow raises instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from areacast.functions._cols import ColumnOrName, col


def idiv(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Integral division truncating toward zero (SQL ``a div b``)."""
    return F.call_function("div", col(a), col(b))


def int_div_average(total: ColumnOrName, centres: ColumnOrName,
                    days: ColumnOrName) -> Column:
    """``(total div centres) div days``: two truncating divisions."""
    return idiv(idiv(total, centres), days)


def exact_forecast(n: ColumnOrName, sx: ColumnOrName, sy: ColumnOrName,
                   sxy: ColumnOrName, sxx: ColumnOrName, x0: ColumnOrName) -> Column:
    """Least-squares line through the points, evaluated at ``x0`` and truncated.

    With ``D = n*sxx - sx^2`` and ``N = n*sxy - sx*sy`` the prediction is the
    rational ``(D*sy + N*(n*x0 - sx)) / (n*D)``; it is computed exactly in
    bigint and truncated toward zero. Null when all x are equal (``D = 0``).
    """
    n, sx, sy, sxy, sxx, x0 = (col(c) for c in (n, sx, sy, sxy, sxx, x0))
    d = n * sxx - sx * sx
    num = d * sy + (n * sxy - sx * sy) * (n * x0.cast("bigint") - sx)
    return F.when(d > 0, idiv(num, n * d))


def exact_slope(n: ColumnOrName, sx: ColumnOrName, sy: ColumnOrName,
                sxy: ColumnOrName, sxx: ColumnOrName) -> Column:
    """Slope ``N / D`` as one double division of exact integers."""
    n, sx, sy, sxy, sxx = (col(c) for c in (n, sx, sy, sxy, sxx))
    d = n * sxx - sx * sx
    return F.when(d > 0, (n * sxy - sx * sy) / d)


def exact_intercept(n: ColumnOrName, sx: ColumnOrName, sy: ColumnOrName,
                    sxy: ColumnOrName, sxx: ColumnOrName) -> Column:
    """Intercept ``(D*sy - N*sx) / (n*D)`` as one double division."""
    n, sx, sy, sxy, sxx = (col(c) for c in (n, sx, sy, sxy, sxx))
    d = n * sxx - sx * sx
    return F.when(d > 0, (d * sy - (n * sxy - sx * sy) * sx) / (n * d))


def required(name: str) -> Column:
    """A count as bigint; a null raises, so that it cannot vanish in a sum."""
    missing = F.raise_error(F.lit(f"null in the count column {name}")).cast("bigint")
    return F.coalesce(F.col(name).cast("bigint"), missing)
