"""The batch job end to end on the CSV fixtures."""

import os

import pytest

from fixtures import CENTRES_CSV, DETAIL_CSV, SUMMARY_CSV

from areacast.plans import job


def _read(folder):
    part = [f for f in os.listdir(folder) if f.startswith("part-")][0]
    with open(os.path.join(folder, part), encoding="utf-8") as fh:
        return fh.read()


def test_job_writes_both_reports(spark, write_text, tmp_path, capsys):
    args = job.parse_args([
        "--centres", write_text("a/c.csv", CENTRES_CSV),
        "--summary", write_text("b/s.csv", SUMMARY_CSV),
        "--detail", write_text("c/d.csv", DETAIL_CSV),
        "--out", str(tmp_path / "results"),
    ])
    elapsed = job.run(spark, args)
    assert set(elapsed) == {"C1", "C2", "C3"}
    q1 = _read(str(tmp_path / "results" / "monthly_avg_per_centre"))
    q2 = _read(str(tmp_path / "results" / "forecast_top5"))
    assert q1.splitlines()[1] == "(ABR,Gennaio);20"
    assert q2.splitlines()[2] == "(2021-04-01,20-29);[(62,ABR)]"
    assert "36.29032258" in capsys.readouterr().out


def test_shared_dir_prefers_configured_checkpoint_dir(spark, tmp_path):
    from areacast.session import fresh_path, shared_dir
    here = shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == here
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a != b and a.startswith(here.rstrip("/"))


def test_job_on_tables_matches_direct_queries(spark, tmp_path, capsys):
    """The shared, checkpointed per-day totals give the same reports as the
    queries run directly on the tables."""
    from areacast.operators.export import monthly_lines, top5_lines
    from areacast.plans import registry

    d = "/root/testdata/sf0.01"
    out = tmp_path / "tables-results"
    job.run(spark, job.parse_args(["--tables", d, "--out", str(out)]))
    direct1 = [f"{r.label};{r.value}" for r in
               monthly_lines(registry.monthly_avg_per_centre(spark, d)).collect()]
    direct2 = [f"{r.label};{r.value}" for r in
               top5_lines(registry.forecast_top5(spark, d)).collect()]
    assert _read(str(out / "monthly_avg_per_centre")).splitlines()[1:] == direct1
    assert _read(str(out / "forecast_top5")).splitlines()[1:] == direct2
    c3_direct = {(r.area, r.month, r.avg_per_centre)
                 for r in registry.monthly_avg_per_centre_sql(spark, d).collect()}
    written = spark.read.option("sep", ";").option("header", True).csv(str(out / "monthly_avg_per_centre_sql"))
    assert {(r.area, r.month, float(r.avg_per_centre)) for r in written.collect()} == c3_direct
    assert len(c3_direct) == 125
    assert "first 20 rows" in capsys.readouterr().out


def test_job_command_line(write_text, tmp_path):
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = tmp_path / "cli"
    cmd = [sys.executable, os.path.join(root, "areacast", "plans", "job.py"),
           "--centres", write_text("a/c.csv", CENTRES_CSV),
           "--summary", write_text("b/s.csv", SUMMARY_CSV),
           "--detail", write_text("c/d.csv", DETAIL_CSV),
           "--out", str(out), "--shuffle-partitions", "4"]
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[2] pyspark-shell")
    res = subprocess.run(cmd, capture_output=True, text=True, timeout=600, env=env)
    assert res.returncode == 0, res.stderr[-2000:]
    assert "C1 elapsed" in res.stdout and "C3 elapsed" in res.stdout
    assert _read(str(out / "monthly_avg_per_centre")).splitlines()[1] == "(ABR,Gennaio);20"


def test_shared_totals_cut_the_lineage(spark):
    """After the checkpoint, the three queries read the saved totals: none of
    their plans scans the line items again."""
    from areacast.plans import registry
    from areacast.plans.queries import forecast_top5, monthly_avg_per_centre

    d = "/root/testdata/sf0.001"
    per_day = job.shared_daily_totals(spark, d, (registry.C1_WINDOW, registry.C2_WINDOW,
                                                 registry.C3_WINDOW))
    summary = per_day.selectExpr("date", "area", "doses as total")
    centres = spark.createDataFrame([("NATION_3", "x")], "area string, centre string")
    for df in (forecast_top5(per_day, *registry.C2_WINDOW),
               monthly_avg_per_centre(centres, summary, *registry.C1_WINDOW)):
        assert "lineitem" not in df._jdf.queryExecution().executedPlan().toString()


def test_job_window_flags(spark, write_text, tmp_path):
    out = tmp_path / "windows"
    args = job.parse_args([
        "--centres", write_text("wa/c.csv", CENTRES_CSV),
        "--summary", write_text("wb/s.csv", SUMMARY_CSV),
        "--detail", write_text("wc/d.csv", DETAIL_CSV),
        "--out", str(out), "--c1-window", "2021-01-01", "2021-02-28",
        "--c2-window", "2021-02-28", "2021-04-01",
    ])
    job.run(spark, args)
    assert _read(str(out / "monthly_avg_per_centre")).splitlines()[1:] == [
        "(ABR,Gennaio);20", "(BAS,Febbraio);3"]
    # only March is left for the forecast: ABR's two March days give 62 on April 1st
    assert _read(str(out / "forecast_top5")).splitlines()[1:] == ["(2021-04-01,20-29);[(62,ABR)]"]


def test_job_checks_every_row_unless_lazy(spark, write_text, tmp_path):
    from pyspark.errors import PySparkException
    summary = SUMMARY_CSV + "2021-08-01,ABR,oops,x\n"     # outside every window
    base = ["--centres", write_text("ka/c.csv", CENTRES_CSV),
            "--summary", write_text("kb/s.csv", summary),
            "--detail", write_text("kc/d.csv", DETAIL_CSV)]
    with pytest.raises(PySparkException, match="cannot parse total"):
        job.run(spark, job.parse_args(base + ["--out", str(tmp_path / "strict")]))
    job.run(spark, job.parse_args(base + ["--out", str(tmp_path / "lazy"), "--lazy-checks"]))


def test_shared_dir_refuses_a_local_folder_on_a_cluster():
    """Without spark.checkpoint.dir a cluster run must fail instead of using
    a folder only the driver can see (stand-in session, no cluster needed)."""
    from areacast.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
