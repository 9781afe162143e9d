"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry
from areacast.plans.oracles import ORACLE_SQL
from areacast.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, con, ORACLE_SQL[name]) is None


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["area", "month", "avg_per_centre"]
    assert df.count() == 50


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_schema_is_stable_across_scales(spark, name):
    small = QUERIES[name](spark, SF).schema
    larger = QUERIES[name](spark, "/root/testdata/sf0.01").schema
    assert small == larger
