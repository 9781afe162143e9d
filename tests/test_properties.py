"""Properties against brute force on small generated inputs.

The queries are checked against plain-Python computations (exact fractions
for the least-squares forecast), and must not depend on partitioning or row
order.
"""

import calendar
import datetime as dt
from collections import defaultdict
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from areacast.operators.trend import trend_moments
from areacast.plans.queries import forecast_ranking, forecast_top5, monthly_avg_per_centre

AREAS = ["ABR", "BAS", "CAL", "LAZ", "MOL", "PIE", "VEN"]
BANDS = ["20-29", "90+"]
LO2, HI2 = dt.date(2021, 1, 31), dt.date(2021, 6, 1)

dates = st.dates(min_value=dt.date(2021, 1, 25), max_value=dt.date(2021, 6, 5))
detail_rows = st.lists(
    st.tuples(dates, st.sampled_from(["P", "M"]), st.sampled_from(AREAS),
              st.sampled_from(BANDS), st.integers(min_value=0, max_value=400)),
    min_size=0, max_size=60)
SLOW = settings(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture,
                                       HealthCheck.too_slow])


def _next_month(m):
    return dt.date(m.year + (m.month == 12), m.month % 12 + 1, 1)


def brute_forecasts(rows, lo, hi):
    per_day = defaultdict(int)
    for d, _s, a, b, v in rows:
        if lo < d < hi:
            per_day[(d, a, b)] += v
    groups = defaultdict(list)
    for (d, a, b), v in per_day.items():
        groups[(d.replace(day=1), a, b)].append((d.day, v))
    out = []
    for (m, a, b), pts in groups.items():
        if sum(1 for _, v in pts if v > 0) < 2:
            continue
        n = len(pts)
        sx = sum(x for x, _ in pts)
        sy = sum(y for _, y in pts)
        sxy = sum(x * y for x, y in pts)
        sxx = sum(x * x for x, _ in pts)
        slope = Fraction(n * sxy - sx * sy, n * sxx - sx * sx)
        x0 = calendar.monthrange(m.year, m.month)[1] + 1
        pred = (Fraction(sy) - slope * sx) / n + slope * x0
        out.append((_next_month(m), b, int(pred), a))   # int() truncates toward 0
    return out


def brute_top(rows, lo, hi, k):
    by_key = defaultdict(list)
    for d, b, f, a in brute_forecasts(rows, lo, hi):
        by_key[(d, b)].append((f, a))
    return {key: sorted(v, key=lambda t: (-t[0], t[1]))[:k] for key, v in by_key.items()}


def _detail_df(spark, rows, partitions=None):
    df = spark.createDataFrame(rows, "date date, supplier string, area string, age_band string, doses bigint")
    return df.repartition(partitions) if partitions else df


@SLOW
@given(rows=detail_rows, parts=st.sampled_from([None, 1, 3, 7]))
def test_forecast_top5_matches_brute_force(spark, rows, parts):
    out = forecast_top5(_detail_df(spark, rows, parts), LO2, HI2, k=5).collect()
    got = {(r.date, r.age_band): [(e.forecast, e.area) for e in r.top] for r in out}
    assert got == brute_top(rows, LO2, HI2, 5)


@SLOW
@given(rows=detail_rows, k=st.integers(min_value=1, max_value=4))
def test_ranking_is_prefix_of_full_ranking(spark, rows, k):
    df = _detail_df(spark, rows)
    full = defaultdict(list)
    for r in forecast_ranking(df, LO2, HI2, k=1000).orderBy("rank").collect():
        full[(r.date, r.age_band)].append((r.forecast, r.area))
    cut = defaultdict(list)
    for r in forecast_ranking(df, LO2, HI2, k=k).orderBy("rank").collect():
        cut[(r.date, r.age_band)].append((r.forecast, r.area))
    assert {key: v[:k] for key, v in full.items()} == dict(cut)


@SLOW
@given(rows=detail_rows, split=st.integers(min_value=0, max_value=60))
def test_moments_merge_over_a_split(spark, rows, split):
    """Fitting two halves and adding the moment sums equals fitting the whole."""
    keys = ["month_start", "area", "age_band"]
    # one row per (date, area, band), as trend_moments expects
    per_day = defaultdict(int)
    for d, _s, a, b, v in rows:
        per_day[(d, a, b)] += v
    pts = [(d, a, b, v) for (d, a, b), v in per_day.items()]
    schema = "date date, area string, age_band string, doses bigint"
    whole = trend_moments(spark.createDataFrame(pts, schema))
    a = trend_moments(spark.createDataFrame(pts[:split], schema))
    b = trend_moments(spark.createDataFrame(pts[split:], schema))
    merged = a.unionByName(b).groupBy(*keys).sum("active_days", "n", "sx", "sy", "sxy", "sxx")
    as_dict = lambda df, cols: {tuple(r[k] for k in keys): tuple(r[c] for c in cols)
                                for r in df.collect()}
    cols = ["active_days", "n", "sx", "sy", "sxy", "sxx"]
    assert as_dict(whole, cols) == as_dict(merged, [f"sum({c})" for c in cols])


summary_rows = st.lists(
    st.tuples(st.dates(min_value=dt.date(2020, 12, 25), max_value=dt.date(2021, 6, 5)),
              st.sampled_from(AREAS), st.integers(min_value=0, max_value=5000)),
    max_size=40)
centre_rows = st.lists(st.tuples(st.sampled_from(AREAS), st.sampled_from(["C1", "C2", None])),
                       max_size=12)


@SLOW
@given(summary=summary_rows, centres=centre_rows, parts=st.sampled_from([None, 2, 5]))
def test_monthly_average_matches_brute_force(spark, summary, centres, parts):
    lo, hi = dt.date(2021, 1, 1), dt.date(2021, 5, 31)
    counts = defaultdict(int)
    for a, _c in centres:
        counts[a] += 1
    totals = defaultdict(int)
    for d, a, t in summary:
        if lo < d < hi:
            totals[(a, d.replace(day=1))] += t
    expected = sorted((a, m.month, t // counts[a] // calendar.monthrange(m.year, m.month)[1])
                      for (a, m), t in totals.items() if counts[a])
    s_df = spark.createDataFrame(summary, "date date, area string, total bigint")
    c_df = spark.createDataFrame(centres, "area string, centre string")
    if parts:
        s_df, c_df = s_df.repartition(parts), c_df.repartition(parts)
    got = [tuple(r) for r in monthly_avg_per_centre(c_df, s_df, lo, hi).collect()]
    assert got == expected   # sorted by area, month


@SLOW
@given(summary=summary_rows, centres=centre_rows)
def test_sql_average_matches_brute_force(spark, summary, centres):
    from areacast.plans.queries import monthly_avg_per_centre_sql
    lo, hi = dt.date(2021, 1, 1), dt.date(2021, 5, 31)
    named = defaultdict(int)
    present = set()
    for a, c in centres:
        present.add(a)
        named[a] += c is not None
    totals = defaultdict(int)
    for d, a, t in summary:
        if lo <= d <= hi:
            totals[(a, d.replace(day=1))] += t
    expected = {}
    for (a, m), t in totals.items():
        if a in present:
            days = calendar.monthrange(m.year, m.month)[1]
            expected[(a, m.strftime("%b"))] = None if named[a] == 0 else round(t / named[a] / days, 9)
    s_df = spark.createDataFrame(summary, "date date, area string, total bigint")
    c_df = spark.createDataFrame(centres, "area string, centre string")
    got = {(r.area, r.month): None if r.avg_per_centre is None else round(r.avg_per_centre, 9)
           for r in monthly_avg_per_centre_sql(spark, c_df, s_df, lo, hi).collect()}
    assert got == expected


year_rows = st.lists(
    st.tuples(st.dates(min_value=dt.date(2020, 11, 25), max_value=dt.date(2021, 3, 5)),
              st.sampled_from(["P", "M"]), st.sampled_from(AREAS), st.sampled_from(BANDS),
              st.integers(min_value=0, max_value=400)),
    max_size=60)


@SLOW
@given(rows=year_rows)
def test_forecast_across_a_year_boundary(spark, rows):
    lo, hi = dt.date(2020, 11, 30), dt.date(2021, 3, 1)
    out = forecast_top5(_detail_df(spark, rows), lo, hi, k=5).collect()
    got = {(r.date, r.age_band): [(e.forecast, e.area) for e in r.top] for r in out}
    assert got == brute_top(rows, lo, hi, 5)
