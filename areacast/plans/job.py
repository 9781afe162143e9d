"""Batch job: run the three queries in one session and write the reports.

    spark-submit areacast/plans/job.py --centres A.csv --summary B.csv \\
        --detail C.csv --out hdfs:///results
    spark-submit areacast/plans/job.py --tables /path/to/parquet --out ...

C1 is written as ``<out>/monthly_avg_per_centre``, C2 as ``<out>/forecast_top5``
(semicolon-separated, with the report headers); C3 as
``<out>/monthly_avg_per_centre_sql``, of which the first rows are also printed.
Elapsed time per query is printed too.
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from functools import reduce

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from areacast.operators.aggregates import daily_total  # noqa: E402
from areacast.operators.export import (  # noqa: E402
    MONTHLY_HEADER,
    TOP5_HEADER,
    monthly_lines,
    top5_lines,
)
from areacast.operators.filters import as_date  # noqa: E402
from areacast.plans import registry  # noqa: E402
from areacast.plans.queries import (  # noqa: E402
    forecast_top5,
    monthly_avg_per_centre,
    monthly_avg_per_centre_sql,
)
from areacast.session import RECOMMENDED_CONF, shared_dir  # noqa: E402
from areacast.sources import (  # noqa: E402
    centres_from_tables,
    daily_detail_from_tables,
    read_centres,
    read_daily_detail,
    read_daily_summary,
    write_csv,
    write_report,
)

# Campaign windows of the CSV inputs.
CSV_C1_WINDOW = ("2021-01-01", "2021-05-31")
CSV_C3_WINDOW = ("2021-01-01", "2021-05-31")
CSV_C2_WINDOW = ("2021-01-31", "2021-06-01")


def parse_args(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder with the warehouse Parquet tables")
    src.add_argument("--centres", help="centres CSV (file or folder)")
    p.add_argument("--summary", help="daily summary CSV (file or folder)")
    p.add_argument("--detail", help="daily detail CSV (file or folder)")
    p.add_argument("--out", required=True, help="output folder for the two reports")
    p.add_argument("--c1-window", nargs=2, metavar=("LO", "HI"))
    p.add_argument("--c2-window", nargs=2, metavar=("LO", "HI"))
    p.add_argument("--c3-window", nargs=2, metavar=("LO", "HI"))
    p.add_argument("--show", type=int, default=20, help="rows of C3 to preview")
    p.add_argument("--lazy-checks", action="store_true",
                   help="CSV inputs: parse a count only on rows inside the windows (faster; "
                        "by default every row is checked and any bad row raises)")
    p.add_argument("--shuffle-partitions", type=int,
                   help="partitions of the big join's shuffle (AQE coalesces the small "
                        "stages); size it so one partition is about 128-256 MB")
    p.add_argument("--max-partition-bytes",
                   help="spark.sql.files.maxPartitionBytes for the scans, e.g. 256m")
    args = p.parse_args(argv)
    if args.centres and not (args.summary and args.detail):
        p.error("--centres needs --summary and --detail")
    return args


def shared_daily_totals(spark: SparkSession, tables_dir: str, windows) -> DataFrame:
    """Per (date, area, age band) totals over the union of the windows,
    computed once and cut from their lineage with a reliable checkpoint.

    On the tables the summary and the detail are the same line items, so the
    one expensive step (line items joined to suppliers) runs once for all
    three queries instead of three times; what is kept is small (days x
    areas x bands). Each query still applies its own window.
    """
    inside = reduce(lambda a, b: a | b, (F.col("date").between(F.lit(as_date(lo)), F.lit(as_date(hi)))
                                         for lo, hi in windows))
    rows = daily_detail_from_tables(spark, tables_dir).where(inside)
    shared_dir(spark)
    return daily_total(rows, ("date", "area", "age_band"), "doses").checkpoint(eager=True)


def run(spark: SparkSession, args) -> dict[str, float]:
    if args.tables:
        w1, w2, w3 = registry.C1_WINDOW, registry.C2_WINDOW, registry.C3_WINDOW
    else:
        w1, w2, w3 = CSV_C1_WINDOW, CSV_C2_WINDOW, CSV_C3_WINDOW
    w1, w2, w3 = args.c1_window or w1, args.c2_window or w2, args.c3_window or w3
    if args.tables:
        centres = centres_from_tables(spark, args.tables)
        per_day = shared_daily_totals(spark, args.tables, (w1, w2, w3))
        summary = per_day.select("date", "area", F.col("doses").alias("total"))
        detail = per_day
    else:
        centres = read_centres(spark, args.centres, check_all=not args.lazy_checks)
        summary = read_daily_summary(spark, args.summary, check_all=not args.lazy_checks)
        detail = read_daily_detail(spark, args.detail, check_all=not args.lazy_checks)
    out = args.out.rstrip("/")
    steps = {
        "C1": lambda: write_report(monthly_lines(monthly_avg_per_centre(centres, summary, *w1)),
                                   f"{out}/monthly_avg_per_centre", MONTHLY_HEADER),
        "C2": lambda: write_report(top5_lines(forecast_top5(detail, *w2)),
                                   f"{out}/forecast_top5", TOP5_HEADER),
        "C3": lambda: write_csv(monthly_avg_per_centre_sql(spark, centres, summary, *w3),
                                f"{out}/monthly_avg_per_centre_sql", sep=";"),
    }
    elapsed = {}
    for name, step in steps.items():
        spark.sparkContext.setJobDescription(f"areacast {name}")   # labels its jobs in event logs
        t0 = time.perf_counter()
        step()
        elapsed[name] = time.perf_counter() - t0
    spark.sparkContext.setJobDescription(None)
    if args.show:
        print(f"C3, first {args.show} rows of {out}/monthly_avg_per_centre_sql:")
        (spark.read.option("sep", ";").option("header", True)
         .csv(f"{out}/monthly_avg_per_centre_sql").show(args.show, truncate=False))
    return elapsed


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = (SparkSession.builder.appName("areacast-job")
             .config("spark.ui.enabled", "false").getOrCreate())
    submitted = spark.sparkContext.getConf()
    for key, value in RECOMMENDED_CONF.items():
        if not submitted.contains(key):   # a value set at submit time wins
            spark.conf.set(key, value)
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    if args.max_partition_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", args.max_partition_bytes)
    try:
        for name, sec in run(spark, args).items():
            print(f"{name} elapsed: {sec * 1000:.0f} ms")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
