"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"monthly_avg_per_centre", "forecast_top5",
                                   "monthly_avg_per_centre_sql"}
    assert set(rec["build"]) == set(rec["run"]) == set(rec["queries"])
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-3


def test_explain_tool_prints_final_plan():
    out = subprocess.run([sys.executable, "-m", "areacast.plans.explain", "--tables",
                          "/root/testdata/sf0.001", "--final", "monthly_avg_per_centre"],
                         cwd=ROOT, capture_output=True, text=True, timeout=600, check=True).stdout
    assert "==== monthly_avg_per_centre ====" in out and "isFinalPlan=true" in out
