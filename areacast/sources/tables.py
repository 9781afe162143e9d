"""Adaptors from the warehouse tables (Parquet) to the three inputs.

    centres        supplier x nation       area = n_name, centre = s_name
    daily summary  lineitem x supplier x nation, one row per line item:
                   date = to_date(l_shipdate), total = l_quantity
    daily detail   the same rows with supplier = l_suppkey,
                   age_band = l_returnflag, doses = l_quantity

The queries sum these rows themselves, so the adaptors do not pre-aggregate:
an extra per-day aggregate would add a stage without changing any result.

Scans read only the needed columns; date filters applied later reach the
lineitem scan as timestamp range filters. The lineitem-to-supplier join is a
plain equi-join: a small supplier table is broadcast by the planner's size
check, a large one is sort-merge joined, with AQE splitting a hot supplier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supplier_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(suppkey, centre, area) for every supplier with a known nation."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey, "inner")
               .select(F.col("s_suppkey").alias("suppkey"),
                       F.col("s_name").alias("centre"),
                       F.col("n_name").alias("area")))


def centres_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_areas(spark, sf_dir).select("area", "centre")


def _lines_with_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the area of their supplier, joined in star order (fact
    to supplier, then to nation) so each join's build side is a dimension."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("area"))
    return (li.join(sup, li.l_suppkey == sup.s_suppkey, "inner")
              .join(nat, sup.s_nationkey == nat.n_nationkey, "inner"))


def daily_summary_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, area, total), one row per line item."""
    return _lines_with_area(spark, sf_dir).select(
        F.to_date("l_shipdate").alias("date"),
        F.col("area"),
        F.col("l_quantity").cast("bigint").alias("total"),
    )


def daily_detail_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, supplier, area, age_band, doses), one row per line item."""
    return _lines_with_area(spark, sf_dir).select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_suppkey").alias("supplier"),
        F.col("area"),
        F.col("l_returnflag").alias("age_band"),
        F.col("l_quantity").cast("bigint").alias("doses"),
    )
