"""Every operator of the inventory as a query over the warehouse tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``oracles.ORACLE_SQL[name]`` is
the same result in plain SQL over the tables (for a differential check with
another engine). Column names and types agree between the two.

Inputs come from the tables (see ``areacast.sources.tables``). The two CSV scans
read files that a fixture step derives from a table, once for each state of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areacast.functions import calendar as cal
from areacast.functions.text import row_to_line
from areacast.operators import aggregates as agg
from areacast.operators import export, filters, joins, ranking, trend
from areacast.plans import queries as q
from areacast.session import fresh_path
from areacast.sources import csv_files, tables
from areacast.schemas import CENTRES_FIELDS, DAILY_DETAIL_FIELDS

# Campaign windows on the table data (1997 is a common year).
C1_WINDOW = ("1997-01-01", "1997-05-31")   # open: both ends excluded
C3_WINDOW = ("1997-01-01", "1997-05-31")   # closed: both ends included
C2_WINDOW = ("1997-01-31", "1997-06-01")   # open: February to May
FILTER_AREA = "NATION_3"
NOT_CONTAINED = "7"
PREVIEW_ROWS = 10
TOP_K = 5

Query = Callable[[SparkSession, str], DataFrame]


def _centres(spark, d):
    return tables.centres_from_tables(spark, d)


def _summary(spark, d):
    return tables.daily_summary_from_tables(spark, d)


def _detail(spark, d):
    return tables.daily_detail_from_tables(spark, d)


def _per_day(spark, d):
    return agg.daily_total(_detail(spark, d), ("date", "area", "age_band"), "doses")


def _active_moments(spark, d):
    return trend.keep_active(trend.trend_moments(_per_day(spark, d)))


# ---- composed queries -------------------------------------------------------

def monthly_avg_per_centre(spark, d):
    """C1 (F1, A1, A2, J1, P7, P12, O1)."""
    return q.monthly_avg_per_centre(_centres(spark, d), _summary(spark, d), *C1_WINDOW)


def monthly_avg_per_centre_sql(spark, d):
    """C3 (S6, S7, F3, A3, J2, P6, P8, P13, A10)."""
    return q.monthly_avg_per_centre_sql(spark, _centres(spark, d), _summary(spark, d), *C3_WINDOW)


def forecast_top5(spark, d):
    """C2 (F2, A4, A5, F5, A6, P10, P15, P14, P11, O3, O5, A7)."""
    return q.forecast_top5(_detail(spark, d), *C2_WINDOW, k=TOP_K)


def forecast_top5_ranked(spark, d):
    """C2 before grouping into lists: one row per (date, band, rank) in the
    campaign window."""
    return q.forecast_ranking(_detail(spark, d), *C2_WINDOW, k=TOP_K)


def monthly_avg_per_centre_closed(spark, d):
    """C1 with both window ends included."""
    return q.monthly_avg_per_centre(_centres(spark, d), _summary(spark, d), *C3_WINDOW,
                                    closed=True)


def forecast_top3_three_days(spark, d):
    """C2 ranking with k = 3 and at least three active days per group."""
    return q.forecast_ranking(_detail(spark, d), *C2_WINDOW, k=3, min_active_days=3)


# ---- sources ----------------------------------------------------------------

_FIXTURES: dict[tuple[str, str, str], tuple[list, str]] = {}


def _folder(spark, path):
    """The file system and Hadoop path of a file or folder."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder


def _versions(spark, table):
    """Name, length and modification time of each file of a table."""
    out = []
    for name in sorted(table.inputFiles()):
        files, path = _folder(spark, name)
        status = files.getFileStatus(path)
        out.append((name, status.getLen(), status.getModificationTime()))
    return out


def _remove(spark, path):
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def csv_fixture(spark, d, name, table, rows, header):
    """Fixture step of the CSV queries: writes ``rows``, derived from ``table``, as
    CSV files below the shared folder; `remove_csv_fixtures` ends them. They
    stand for one state of the table's files: if any was rewritten, added or
    removed since, they are written anew and the old ones removed."""
    key = (spark.sparkContext.applicationId, d, name)
    versions = _versions(spark, table)
    found, path = _FIXTURES.get(key, (None, None))
    if path is not None:
        files, folder = _folder(spark, path)
        if found == versions and files.exists(folder):
            return path
        _remove(spark, path)
    path = fresh_path(spark, f"{name}-csv")
    csv_files.write_csv(rows, path, header=header)
    _FIXTURES[key] = (versions, path)
    return path


def remove_csv_fixtures(spark):
    """Removes this session's CSV fixtures; queries built on them cannot run again."""
    for key in [k for k in _FIXTURES if k[0] == spark.sparkContext.applicationId]:
        _remove(spark, _FIXTURES.pop(key)[1])


def _line_fields(lines):
    """Line items as text fields; no join is needed for them."""
    return lines.select(
        F.to_date("l_shipdate").cast("string").alias("date"), F.col("l_suppkey").cast("string").alias("supplier"),
        "l_linestatus", "l_returnflag", F.col("l_quantity").cast("bigint").cast("string").alias("quantity"))


def scan_csv_positional(spark, d):
    """Dates, flags and quantities without header, with a trailing unused
    column, read by position."""
    lines = tables.table(spark, d, "lineitem")
    rows = _line_fields(lines).select("date", "l_returnflag", "quantity", F.lit("-"))
    path = csv_fixture(spark, d, "positional", lines, rows, header=False)
    fields = ((0, "date", "date"), (1, "flag", "string"), (2, "quantity", "bigint"))
    return csv_files.read_csv(spark, path, fields, header=False)


def scan_csv_header(spark, d):
    """Suppliers with a header line in each file and an extra column."""
    suppliers = tables.table(spark, d, "supplier")
    rows = suppliers.select(
        F.col("s_nationkey").cast("string").alias("area"), F.col("s_name").alias("centre"),
        F.col("s_suppkey").cast("string").alias("code"))
    path = csv_fixture(spark, d, "headed", suppliers, rows, header=True)
    return csv_files.read_csv(spark, path, CENTRES_FIELDS, header=True)


def parse_typed_fields(spark, d):
    """Lines of six text fields (the fifth a decoy), strictly parsed into
    date / string / bigint. The lines are made in the query; no file is written."""
    fields = _line_fields(tables.table(spark, d, "lineitem"))
    lines = fields.select(F.to_csv(F.struct(
        "date", "supplier", F.col("l_linestatus").alias("area"), F.col("l_returnflag").alias("age_band"),
        F.lit("1.5x").alias("other"), F.col("quantity").alias("doses"))).alias("line"))
    return csv_files.parse_lines(lines, "line", DAILY_DETAIL_FIELDS)


def row_to_line_query(spark, d):
    """S3: a row as one delimited line, nulls as ``null``."""
    areas = tables.supplier_areas(spark, d)
    return areas.select(row_to_line(["area", "centre", "suppkey"]).alias("line"))


# ---- projections -------------------------------------------------------------

def project_columns(spark, d):
    """Column pruning."""
    return _detail(spark, d).select("date", "area", "age_band", "doses")


def _ship_dates(spark, d):
    """The dates of the line items; no join is needed for them."""
    return tables.table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date"))


def month_labels(spark, d):
    """Month names and numbers."""
    months = agg.distinct_keys(_ship_dates(spark, d).select(cal.month_start("date").alias("month_start")), ["month_start"])
    return months.select(
        "month_start",
        cal.month_name_upper("month_start").alias("month_upper"),
        cal.month_index0("month_start").alias("month_index0"),
        cal.month_label_it("month_start").alias("month_it"),
        cal.month_abbr("month_start").alias("month_abbr"),
    )


def calendar_days(spark, d):
    """Day counts and forecast days."""
    dates = agg.distinct_keys(_ship_dates(spark, d), ["date"])
    return dates.select(
        "date",
        cal.month_start("date").alias("month_start"),
        cal.days_in_month("date").alias("days_in_month"),
        cal.day_of_month("date").alias("day_of_month"),
        cal.forecast_day("date").alias("forecast_x"),
        cal.next_month_start("date").alias("next_month_start"),
    )


def int_div_average_query(spark, d):
    """Integer average per centre and day."""
    return joins.per_centre_average(agg.monthly_total(_summary(spark, d)),
                                    agg.centre_counts(_centres(spark, d)))


def trend_forecast(spark, d):
    """Truncated next-month forecast."""
    return trend.forecast_next_month(_active_moments(spark, d))


def topk_per_group(spark, d):
    """Top 5 per (date, band)."""
    return q.forecast_ranking(_detail(spark, d), k=TOP_K)


# ---- filters -----------------------------------------------------------------

def filter_closed_interval(spark, d):
    """Closed date window."""
    return filters.within(_summary(spark, d), "date", *C3_WINDOW, closed=True)


def filter_open_interval(spark, d):
    """open date window."""
    return filters.within(_summary(spark, d), "date", *C1_WINDOW)


def active_day_filter(spark, d):
    """Groups with two active days."""
    return trend.active_keys(_per_day(spark, d))


def filter_not_contains(spark, d):
    """negated substring test."""
    return filters.not_contains(_centres(spark, d), "centre", NOT_CONTAINED)


def filter_equals(spark, d):
    """equality filter."""
    return filters.equals(_per_day(spark, d), "area", FILTER_AREA)


def active_day_semi_join(spark, d):
    """Rows of the active groups (left semi join)."""
    return trend.active_day_semi_join(_per_day(spark, d))


# ---- joins and aggregates ------------------------------------------------------

def join_centres(spark, d):
    """Totals joined to centre counts."""
    return joins.join_centres(agg.monthly_total(_summary(spark, d)),
                              agg.centre_counts(_centres(spark, d)))


def monthly_total(spark, d):
    """Sum per (area, month)."""
    return agg.monthly_total(_summary(spark, d))


def total_over_supplier(spark, d):
    """Sum over suppliers per (date, area, band)."""
    return _per_day(spark, d)


def count_centres(spark, d):
    """A2, A3: centres per area, by rows and by names."""
    return agg.centre_counts(_centres(spark, d))


def trend_fit(spark, d):
    """Least-squares slope and intercept."""
    return trend.fit_trend(_active_moments(spark, d))


def topk_list(spark, d):
    """Ordered top-5 lists."""
    ranked = q.forecast_ranking(_detail(spark, d), k=TOP_K)
    return ranking.ranked_list(ranked, ["date", "age_band"], "rank", ["forecast", "area"], TOP_K)


def distinct_keys(spark, d):
    """Distinct (area, month)."""
    keyed = _summary(spark, d).select("area", cal.month_start("date").alias("month_start"))
    return agg.distinct_keys(keyed, ["area", "month_start"])


def count_by_key(spark, d):
    """Rows per key."""
    return agg.count_by_key(_detail(spark, d), ["date", "area", "age_band"])


def key_count(spark, d):
    """Number of (month, area, band) groups with two active days."""
    return agg.key_count(trend.active_keys(_per_day(spark, d)), ["month_start", "area", "age_band"])


def row_count(spark, d):
    """Row count."""
    return agg.row_count(tables.table(spark, d, "lineitem"))


# ---- ordering ------------------------------------------------------------------

def sort_composite(spark, d):
    """Composite sort."""
    return ranking.sort_by(_per_day(spark, d), "date", "area", "age_band")


def first_row(spark, d):
    """First row by a total order."""
    return ranking.first_row(_summary(spark, d), "date", "area", "total")


def limit_preview(spark, d):
    """First 10 rows by a total order."""
    return ranking.preview(_summary(spark, d), PREVIEW_ROWS, "date", "area", "total")


# ---- sinks ---------------------------------------------------------------------

def _read_report(spark, path):
    """The report's lines, with its header."""
    lines = spark.read.option("sep", ";").option("header", True).csv(path)
    return lines.toDF("label", "value").withColumn("header", F.lit(";".join(lines.columns)))


def export_monthly_lines(spark, d):
    """K1, K3: C1 report written (overwrite) and read back."""
    path = fresh_path(spark, "monthly-report")
    earlier = agg.distinct_keys(_centres(spark, d), ["area", "centre"])
    csv_files.write_report(earlier, path, ("to be", "replaced"))
    csv_files.write_report(export.monthly_lines(monthly_avg_per_centre(spark, d)), path,
                           export.MONTHLY_HEADER)
    return _read_report(spark, path)


def export_top5_lines(spark, d):
    """K2: C2 report written and read back."""
    path = fresh_path(spark, "top5-report")
    csv_files.write_report(export.top5_lines(forecast_top5(spark, d)), path,
                           export.TOP5_HEADER)
    return _read_report(spark, path)


QUERIES: dict[str, Query] = {
    "monthly_avg_per_centre": monthly_avg_per_centre,
    "monthly_avg_per_centre_sql": monthly_avg_per_centre_sql,
    "forecast_top5": forecast_top5,
    "forecast_top5_ranked": forecast_top5_ranked,
    "monthly_avg_per_centre_closed": monthly_avg_per_centre_closed,
    "forecast_top3_three_days": forecast_top3_three_days,
    "scan_csv_positional": scan_csv_positional,
    "scan_csv_header": scan_csv_header,
    "parse_typed_fields": parse_typed_fields,
    "row_to_line": row_to_line_query,
    "project_columns": project_columns,
    "month_labels": month_labels,
    "calendar_days": calendar_days,
    "int_div_average": int_div_average_query,
    "trend_forecast": trend_forecast,
    "topk_per_group": topk_per_group,
    "filter_closed_interval": filter_closed_interval,
    "filter_open_interval": filter_open_interval,
    "active_day_filter": active_day_filter,
    "filter_not_contains": filter_not_contains,
    "filter_equals": filter_equals,
    "active_day_semi_join": active_day_semi_join,
    "join_centres": join_centres,
    "monthly_total": monthly_total,
    "total_over_supplier": total_over_supplier,
    "count_centres": count_centres,
    "trend_fit": trend_fit,
    "topk_list": topk_list,
    "distinct_keys": distinct_keys,
    "count_by_key": count_by_key,
    "key_count": key_count,
    "row_count": row_count,
    "sort_composite": sort_composite,
    "first_row": first_row,
    "limit_preview": limit_preview,
    "export_monthly_lines": export_monthly_lines,
    "export_top5_lines": export_top5_lines,
}
