"""Ordering, top-k per group and ordered lists.

``top_k_per_group`` is ``row_number() <= k`` over a window: Spark plans a
partial ``WindowGroupLimit`` before the shuffle, so each task sends at most k
rows per group and a hot group never reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OrderCol = Column | str


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[OrderCol],
                    k: int, rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group by ``order_cols`` (ties broken by
    the later order columns), with their 1-based rank."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def ranked_list(df: DataFrame, group_cols: Sequence[str], rank_col: str,
                fields: Sequence[str], k: int, out: str = "top") -> DataFrame:
    """One row per group with an array of struct(fields) in rank order, for
    the rows ranked 1 to ``k`` (the rank is a ``row_number`` from
    ``top_k_per_group``), so a list never holds more than ``k`` entries."""
    ranked = df.where(F.col(rank_col) <= k)
    entries = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("_rank"),
                                                   *[F.col(f) for f in fields])))
    as_fields = F.transform(entries, lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    element = T.StructType([T.StructField(f, df.schema[f].dataType, True) for f in fields])
    return ranked.groupBy(*group_cols).agg(
        as_fields.cast(T.ArrayType(element, containsNull=True)).alias(out))


def sort_by(df: DataFrame, *cols: OrderCol) -> DataFrame:
    """Global sort (range-partitioned, each partition sorted)."""
    return df.orderBy(*cols)


def first_row(df: DataFrame, *order: OrderCol) -> DataFrame:
    """The first row by ``order`` (a one-row frame, empty if ``df`` is)."""
    return df.orderBy(*order).limit(1)


def preview(df: DataFrame, n: int, *order: OrderCol) -> DataFrame:
    """The first ``n`` rows by ``order``: per-task top-n, merged once."""
    return df.orderBy(*order).limit(n)
