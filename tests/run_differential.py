"""Run every registered query against its DuckDB oracle and report.

    python tests/run_differential.py [sf_dir] [name ...] [--json PATH]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck, types_of  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from areacast.session import local_session  # noqa: E402


def main() -> int:
    argv = sys.argv[1:]
    json_path = None
    if "--json" in argv:
        i = argv.index("--json")
        json_path = argv[i + 1]
        argv = argv[:i] + argv[i + 2:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    report = {}
    spark = local_session(8)
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in ((k, f) for k, f in entry.queries().items() if k in oracles):
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        sql = oracles.get(name)
        if sql is None:
            print(f"{name:30s} rows-only {df.count()}")
            continue
        reason = compare(df, con, sql)
        s_types, d_types = types_of(df, con, sql)
        type_note = "" if s_types == d_types else f" TYPES spark={s_types} duckdb={d_types}"
        status = "OK " if reason is None else "BAD"
        bad += reason is not None
        report[name] = {"match": reason is None, "reason": reason,
                        "types_match": s_types == d_types, "sec": round(time.time() - t0, 2)}
        print(f"{name:30s} {status} {time.time() - t0:5.1f}s {reason or ''}{type_note}")
    print("mismatches:", bad)
    if json_path:
        with open(json_path, "w", encoding="utf-8") as fh:
            json.dump({"sf_dir": sf_dir, "queries": report}, fh, indent=1)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
