"""Print the physical plans of the headline queries.

    python -m areacast.plans.explain --tables /root/testdata/sf0.1 [--final] [name ...]

Without ``--final`` each plan is Spark's formatted explain of the initial
adaptive plan (with scan details such as ``PushedFilters`` and
``ReadSchema``). With ``--final`` the query runs first and ``explain()``
then shows the plan it finished with (joins AQE turned into broadcasts or
hash joins, coalesced and skew-split shuffle reads). The final mode collects
the result, so it is limited to the headline queries, whose results are a
few hundred rows.
"""

from __future__ import annotations

import argparse

from areacast.plans.registry import QUERIES
from areacast.session import local_session

HEADLINE = ("monthly_avg_per_centre", "forecast_top5", "monthly_avg_per_centre_sql")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--tables", required=True, help="folder with the Parquet tables")
    p.add_argument("--final", action="store_true", help="run first, print the final plan")
    p.add_argument("names", nargs="*", help="registered query names (default: headline)")
    args = p.parse_args(argv)
    names = args.names or list(HEADLINE)
    if args.final and set(names) - set(HEADLINE):
        p.error("--final runs the query and collects it: headline queries only")
    spark = local_session()
    for name in names:
        df = QUERIES[name](spark, args.tables)
        print(f"==== {name} ====", flush=True)
        if args.final:
            df.collect()          # runs this DataFrame's own plan to its final form
            df.explain()
        else:
            df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
