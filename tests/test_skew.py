"""A supplier holding a third of all line items: with the supplier table too
large to broadcast, AQE splits the hot partition of the sort-merge join, and
the results do not change."""

import re

import pytest
from pyspark.sql import functions as F

from areacast.plans.queries import forecast_top5, monthly_avg_per_centre, monthly_avg_per_centre_sql
from areacast.sources import tables

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skewed"))
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    hot = li.withColumn("l_suppkey",
                        F.when(F.rand(7) < 0.34, F.lit(1)).otherwise(F.col("l_suppkey")))
    hot.repartition(8).write.parquet(f"{d}/lineitem.parquet")
    for t in ("supplier", "nation"):
        spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    return d


def _c1(spark, d):
    return monthly_avg_per_centre(tables.centres_from_tables(spark, d),
                                  tables.daily_summary_from_tables(spark, d),
                                  "1997-01-01", "1997-05-31")


def _c2(spark, d):
    return forecast_top5(tables.daily_detail_from_tables(spark, d), "1997-01-31", "1997-06-01")


def _c3(spark, d):
    return monthly_avg_per_centre_sql(spark, tables.centres_from_tables(spark, d),
                                      tables.daily_summary_from_tables(spark, d),
                                      "1997-01-01", "1997-05-31")


@pytest.mark.parametrize("build", [_c1, _c2, _c3])
def test_hot_supplier_is_split_and_results_hold(spark, skewed_dir, build):
    expected = sorted(tuple(r) for r in build(spark, skewed_dir).collect())
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = build(spark, skewed_dir)
        got = sorted(tuple(r) for r in df.collect())
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert re.search(r"(SortMergeJoin|ShuffledHashJoin)\(skew=true\) \[l_suppkey", final), final
    assert got == expected
