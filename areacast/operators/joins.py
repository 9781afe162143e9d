"""Joins. No broadcast hints: the planner broadcasts a side only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-plans from the measured shuffle size (turning a sort-merge join into a
broadcast join once the aggregated side is known to be small, and splitting
skewed partitions otherwise)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.functions.arithmetic import int_div_average
from areacast.functions.calendar import days_in_month


def join_centres(totals: DataFrame, counts: DataFrame, key: str = "area") -> DataFrame:
    """Inner equi-join of per-(area, month) totals with per-area centre counts.
    Areas without centres, and centres without totals, drop out. Keys compare
    null-safe, as groups do: a null area has the centres without an area."""
    named = counts.withColumnRenamed(key, f"_{key}")
    return totals.join(named, totals[key].eqNullSafe(named[f"_{key}"]), "inner").drop(f"_{key}")


def per_centre_average(totals: DataFrame, counts: DataFrame, key: str = "area",
                       centres: str = "n_centres") -> DataFrame:
    """Join per-(area, month) totals with per-area centre counts and take the
    integer average per centre and day: ``total div centres div days``.
    Columns: key, month_start, avg_per_centre (bigint)."""
    return join_centres(totals, counts.select(key, centres), key).select(
        key, "month_start",
        int_div_average("total", centres, days_in_month("month_start")).alias("avg_per_centre"))


def semi_join(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_df`` (left semi join), with
    the columns of ``df`` in their order. Keys compare null-safe: a null key
    part equals a null, as it does in a group."""
    keys = keys_df.select(*(F.col(c).alias(f"_key_{i}") for i, c in enumerate(on)))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_key_{i}")) for i, c in enumerate(on)))
    return df.join(keys, on=same, how="left_semi")
