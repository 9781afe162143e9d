"""Row counts of the composed queries at the three driver scales
(FIXTURES.md section 6), and the headline queries against DuckDB at sf0.01."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry
from areacast.plans import queries as q
from areacast.plans import registry
from areacast.sources import tables

SCALES = {"0.001": (50, 60), "0.01": (125, 60), "0.1": (125, 60)}


@pytest.mark.parametrize("sf", sorted(SCALES))
def test_window_row_counts(spark, sf):
    d = f"/root/testdata/sf{sf}"
    c1_rows, c2_rows = SCALES[sf]
    assert registry.monthly_avg_per_centre(spark, d).count() == c1_rows
    ranking = q.forecast_ranking(tables.daily_detail_from_tables(spark, d), *registry.C2_WINDOW)
    assert ranking.count() == c2_rows
    assert registry.forecast_top5(spark, d).count() == c2_rows // 5


@pytest.mark.parametrize("name", ["monthly_avg_per_centre", "forecast_top5",
                                  "monthly_avg_per_centre_sql"])
def test_headline_matches_oracle_at_sf001(spark, name):
    d = "/root/testdata/sf0.01"
    assert compare(entry.queries()[name](spark, d), duck(d), entry.oracle_sql()[name]) is None
