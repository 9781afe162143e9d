"""Benchmark the headline queries.

Runs C1 (monthly_avg_per_centre), C2 (forecast_top5) and C3
(monthly_avg_per_centre_sql) on the tables in $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] (default 8): $BENCH_WARMUP
(default 3) warm-up runs, then the median wall time of $BENCH_REPS (default
5) runs, each writing the full result to Spark's no-op sink. Prints one JSON
line on stdout (``queries``: whole times; ``build`` and ``run``: their parts) and
the single times, build + run, on stderr.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from areacast.plans.registry import QUERIES  # noqa: E402
from areacast.session import local_session  # noqa: E402

HEADLINE = ("monthly_avg_per_centre", "forecast_top5", "monthly_avg_per_centre_sql")


def _sf_of(path: str) -> float | str:
    tail = os.path.basename(path.rstrip("/"))
    try:
        return float(tail.removeprefix("sf"))
    except ValueError:
        return tail


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    warmup = int(os.environ.get("BENCH_WARMUP", "3"))
    spark = local_session(cpus, shuffle_partitions=cpus, app_name="areacast-bench")

    medians, builds, runs = {}, {}, {}
    for name in HEADLINE:
        def run():
            t0 = time.perf_counter()   # file listing and footer reads of the build count too
            df = QUERIES[name](spark, sf_dir)
            t1 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            return t1 - t0, time.perf_counter() - t1

        for _ in range(warmup):   # JIT of generated code, file listing, dimension reads
            run()
        times = [run() for _ in range(reps)]
        medians[name] = round(statistics.median(map(sum, times)), 4)
        builds[name], runs[name] = (round(statistics.median(t), 4) for t in zip(*times))
        print(f"{name}: " + " ".join(f"{b:.3f}+{r:.3f}" for b, r in times), file=sys.stderr)

    print(json.dumps({
        "metric": "headline_queries_median_sum",
        "value": round(sum(medians.values()), 4),
        "unit": "sec",
        "queries": medians,
        "build": builds,
        "run": runs,
        "sf": _sf_of(sf_dir),
        "cpus": cpus,
        "reps": reps,
        "warmup": warmup,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
