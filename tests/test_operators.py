"""Each operator on a tiny hand-made input."""

import datetime as dt

from pyspark.sql import functions as F

from areacast.functions.text import pair_label, row_to_line, top_list_text
from areacast.operators import aggregates as agg
from areacast.operators import filters, joins, ranking

D = dt.date


def _summary(spark):
    rows = [(D(2021, 1, 1), "ABR", 10), (D(2021, 1, 2), "ABR", 20), (D(2021, 1, 2), "BAS", 5),
            (D(2021, 2, 1), "ABR", 7), (D(2021, 5, 31), "BAS", 1)]
    return spark.createDataFrame(rows, "date date, area string, total bigint")


def test_within_open_and_closed(spark):
    df = _summary(spark)
    open_ = filters.within(df, "date", "2021-01-01", "2021-05-31").count()
    closed = filters.within(df, "date", D(2021, 1, 1), D(2021, 5, 31), closed=True).count()
    assert (open_, closed) == (3, 5)


def test_not_contains_and_equals(spark):
    df = spark.createDataFrame([("a", "x7"), ("b", "y"), ("c", None)], "k string, v string")
    assert [r.k for r in filters.not_contains(df, "v", "7").collect()] == ["b", "c"]
    assert [r.k for r in filters.equals(df, "v", "y").collect()] == ["b"]
    assert filters.positive(spark.range(-2, 3), "id").count() == 2


def test_monthly_total_keys_on_month_start(spark):
    got = {(r.area, r.month_start): r.total for r in agg.monthly_total(_summary(spark)).collect()}
    assert got == {("ABR", D(2021, 1, 1)): 30, ("BAS", D(2021, 1, 1)): 5,
                   ("ABR", D(2021, 2, 1)): 7, ("BAS", D(2021, 5, 1)): 1}


def test_count_by_key_row_count_distinct(spark):
    df = _summary(spark)
    assert {r.area: r.n_rows for r in agg.count_by_key(df, ["area"]).collect()} == {"ABR": 3, "BAS": 2}
    assert agg.row_count(df).collect()[0].n_rows == 5
    assert agg.row_count(df.limit(0)).collect()[0].n_rows == 0
    assert agg.distinct_keys(df, ["area"]).count() == 2


def test_join_centres_is_inner(spark):
    totals = agg.monthly_total(_summary(spark))
    counts = spark.createDataFrame([("ABR", 2), ("XXX", 1)], "area string, n_centres bigint")
    got = joins.join_centres(totals, counts).collect()
    assert sorted((r.area, r.month_start, r.total, r.n_centres) for r in got) == [
        ("ABR", D(2021, 1, 1), 30, 2), ("ABR", D(2021, 2, 1), 7, 2)]


def test_semi_join_keeps_left_columns_only(spark):
    left = _summary(spark)
    keys = spark.createDataFrame([("BAS", 1)], "area string, other int")
    out = joins.semi_join(left, keys, ["area"])
    assert out.columns == left.columns and out.count() == 2


def test_top_k_ties_break_by_later_columns(spark):
    df = spark.createDataFrame([("g", 5, "b"), ("g", 5, "a"), ("g", 9, "z"), ("h", 1, "q")],
                               "g string, v bigint, name string")
    top = ranking.top_k_per_group(df, ["g"], [F.desc("v"), F.asc("name")], 2)
    got = sorted((r.g, r.rank, r.v, r.name) for r in top.collect())
    assert got == [("g", 1, 9, "z"), ("g", 2, 5, "a"), ("h", 1, 1, "q")]
    lists = ranking.ranked_list(top, ["g"], "rank", ["v", "name"], 2).collect()
    assert {r.g: [(e.v, e.name) for e in r.top] for r in lists} == {
        "g": [(9, "z"), (5, "a")], "h": [(1, "q")]}


def test_sort_first_row_and_preview(spark):
    df = _summary(spark).repartition(3)
    assert [tuple(r) for r in ranking.sort_by(df, "date", "area").select("area", "total").collect()] == [
        ("ABR", 10), ("ABR", 20), ("BAS", 5), ("ABR", 7), ("BAS", 1)]
    assert [r.total for r in ranking.first_row(df, "date", "area").collect()] == [10]
    assert [r.total for r in ranking.preview(df, 2, F.desc("total")).collect()] == [20, 10]


def test_text_functions(spark):
    df = spark.createDataFrame([("ABR", None, 3)], "a string, b string, n bigint")
    r = df.select(row_to_line(["a", "b", "n"]).alias("line"),
                  pair_label("a", "n").alias("label")).collect()[0]
    assert (r.line, r.label) == ("ABR,null,3", "(ABR,3)")
    arr = spark.sql("select array(named_struct('forecast', 6L, 'area', 'LAZ'), "
                    "named_struct('forecast', -1L, 'area', 'PUG')) as top")
    assert arr.select(top_list_text("top")).collect()[0][0] == "[(6,LAZ), (-1,PUG)]"
    empty = spark.sql("select cast(array() as array<struct<forecast:bigint,area:string>>) as top")
    assert empty.select(top_list_text("top")).collect()[0][0] == "[]"


def test_window_bounds_accept_text_dates_and_datetimes(spark):
    df = _summary(spark)
    a = filters.within(df, "date", "2021-01-01", "2021-02-01", closed=True).count()
    b = filters.within(df, "date", dt.datetime(2021, 1, 1, 23, 0), D(2021, 2, 1), closed=True).count()
    assert a == b == 4


def test_key_count(spark):
    df = _summary(spark)
    assert agg.key_count(df, ["area"]).collect()[0].n_keys == 2
    assert agg.key_count(df.limit(0), ["area"]).collect()[0].n_keys == 0
