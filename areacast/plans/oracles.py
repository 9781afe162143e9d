"""The registered queries as plain SQL over the warehouse tables.

One statement per ``registry.QUERIES`` key, for a differential check with
another SQL engine (DuckDB dialect: ``//`` is integer division truncating
toward zero, ``list(...)`` builds the ordered top-k list). Names and types of
the columns agree with the Spark results.
"""

from __future__ import annotations

_BASE = """
WITH centres AS (
  SELECT n.n_name AS area, s.s_name AS centre, s.s_suppkey AS suppkey
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
),
detail AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date, l.l_suppkey AS supplier, n.n_name AS area,
         l.l_returnflag AS age_band, CAST(l.l_quantity AS BIGINT) AS doses
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
),
summary AS (SELECT date, area, doses AS total FROM detail),
per_day AS (
  SELECT date, area, age_band, CAST(SUM(doses) AS BIGINT) AS doses
  FROM detail GROUP BY date, area, age_band
),
centre_counts AS (
  SELECT area, COUNT(*) AS n_centres, COUNT(centre) AS n_named_centres
  FROM centres GROUP BY area
),
monthly AS (
  SELECT area, CAST(date_trunc('month', date) AS DATE) AS month_start,
         CAST(SUM(total) AS BIGINT) AS total
  FROM summary GROUP BY 1, 2
),
moments AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, area, age_band,
         COUNT(*) FILTER (WHERE doses > 0) AS active_days,
         COUNT(*) AS n,
         CAST(SUM(dayofmonth(date)) AS BIGINT) AS sx,
         CAST(SUM(doses) AS BIGINT) AS sy,
         CAST(SUM(dayofmonth(date) * doses) AS BIGINT) AS sxy,
         CAST(SUM(dayofmonth(date) * dayofmonth(date)) AS BIGINT) AS sxx
  FROM per_day GROUP BY 1, 2, 3
),
active AS (SELECT * FROM moments WHERE active_days >= 2),
forecasts AS (
  SELECT CAST(month_start + INTERVAL 1 MONTH AS DATE) AS date, area, age_band,
         ((n * sxx - sx * sx) * sy
          + (n * sxy - sx * sy) * (n * (dayofmonth(last_day(month_start)) + 1) - sx))
         // (n * (n * sxx - sx * sx)) AS forecast
  FROM active
),
ranking AS (
  SELECT date, age_band, CAST(rank AS INTEGER) AS rank, forecast, area FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY date, age_band
                                 ORDER BY forecast DESC, area ASC) AS rank
    FROM forecasts) WHERE rank <= 5
),
c2_window AS (
  SELECT date, area, age_band, CAST(SUM(doses) AS BIGINT) AS doses
  FROM detail WHERE date > DATE '1997-01-31' AND date < DATE '1997-06-01'
  GROUP BY date, area, age_band
),
c2_forecasts AS (
  SELECT CAST(month_start + INTERVAL 1 MONTH AS DATE) AS date, area, age_band,
         ((n * sxx - sx * sx) * sy
          + (n * sxy - sx * sy) * (n * (dayofmonth(last_day(month_start)) + 1) - sx))
         // (n * (n * sxx - sx * sx)) AS forecast
  FROM (
    SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, area, age_band,
           COUNT(*) FILTER (WHERE doses > 0) AS active_days, COUNT(*) AS n,
           CAST(SUM(dayofmonth(date)) AS BIGINT) AS sx, CAST(SUM(doses) AS BIGINT) AS sy,
           CAST(SUM(dayofmonth(date) * doses) AS BIGINT) AS sxy,
           CAST(SUM(dayofmonth(date) * dayofmonth(date)) AS BIGINT) AS sxx
    FROM c2_window GROUP BY 1, 2, 3) WHERE active_days >= 2
),
c2 AS (
  SELECT date, age_band,
         list({'forecast': forecast, 'area': area} ORDER BY rank) AS top
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, age_band
                                     ORDER BY forecast DESC, area ASC) AS rank
        FROM c2_forecasts)
  WHERE rank <= 5 GROUP BY date, age_band
),
c1 AS (
  SELECT m.area, CAST(month(m.month_start) AS INTEGER) AS month,
         CAST((m.total // c.n_centres) // dayofmonth(last_day(m.month_start)) AS BIGINT)
           AS avg_per_centre
  FROM (SELECT area, CAST(date_trunc('month', date) AS DATE) AS month_start,
               CAST(SUM(total) AS BIGINT) AS total
        FROM summary WHERE date > DATE '1997-01-01' AND date < DATE '1997-05-31'
        GROUP BY 1, 2) m
  JOIN centre_counts c ON m.area = c.area
)
"""

# Fixed values, written out here so that they check the library's own list.
_IT_MONTHS = """['Gennaio', 'Febbraio', 'Marzo', 'Aprile', 'Maggio', 'Giugno',
 'Luglio', 'Agosto', 'Settembre', 'Ottobre', 'Novembre', 'Dicembre']"""

_ORACLE_TAIL = {
    "monthly_avg_per_centre": "SELECT * FROM c1 ORDER BY area, month",
    "monthly_avg_per_centre_sql": """
SELECT m.area, strftime(m.month_start, '%b') AS month,
       (CASE WHEN c.n_named_centres = 0 THEN NULL ELSE m.total / c.n_named_centres END)
         / dayofmonth(last_day(m.month_start)) AS avg_per_centre
FROM (SELECT area, CAST(date_trunc('month', date) AS DATE) AS month_start,
             CAST(SUM(total) AS BIGINT) AS total
      FROM summary WHERE date >= DATE '1997-01-01' AND date <= DATE '1997-05-31'
      GROUP BY 1, 2) m
JOIN centre_counts c ON m.area = c.area""",
    "forecast_top5": "SELECT * FROM c2 ORDER BY date, age_band",
    "forecast_top5_ranked": """
SELECT date, age_band, CAST(rank AS INTEGER) AS rank, forecast, area
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, age_band
                                   ORDER BY forecast DESC, area ASC) AS rank
      FROM c2_forecasts)
WHERE rank <= 5""",
    "monthly_avg_per_centre_closed": """
SELECT m.area, CAST(month(m.month_start) AS INTEGER) AS month,
       CAST((m.total // c.n_centres) // dayofmonth(last_day(m.month_start)) AS BIGINT)
         AS avg_per_centre
FROM (SELECT area, CAST(date_trunc('month', date) AS DATE) AS month_start,
             CAST(SUM(total) AS BIGINT) AS total
      FROM summary WHERE date >= DATE '1997-01-01' AND date <= DATE '1997-05-31'
      GROUP BY 1, 2) m
JOIN centre_counts c ON m.area = c.area
ORDER BY area, month""",
    "forecast_top3_three_days": """
SELECT date, age_band, CAST(rank AS INTEGER) AS rank, forecast, area
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, age_band
                                   ORDER BY forecast DESC, area ASC) AS rank
      FROM (SELECT CAST(month_start + INTERVAL 1 MONTH AS DATE) AS date, area, age_band,
                   ((n * sxx - sx * sx) * sy
                    + (n * sxy - sx * sy) * (n * (dayofmonth(last_day(month_start)) + 1) - sx))
                   // (n * (n * sxx - sx * sx)) AS forecast
            FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, area, age_band,
                         COUNT(*) FILTER (WHERE doses > 0) AS active_days, COUNT(*) AS n,
                         CAST(SUM(dayofmonth(date)) AS BIGINT) AS sx,
                         CAST(SUM(doses) AS BIGINT) AS sy,
                         CAST(SUM(dayofmonth(date) * doses) AS BIGINT) AS sxy,
                         CAST(SUM(dayofmonth(date) * dayofmonth(date)) AS BIGINT) AS sxx
                  FROM c2_window GROUP BY 1, 2, 3)
            WHERE active_days >= 3))
WHERE rank <= 3""",
    "scan_csv_positional": """
SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS flag, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem""",
    "scan_csv_header": "SELECT CAST(s_nationkey AS VARCHAR) AS area, s_name AS centre FROM supplier",
    "parse_typed_fields": """
SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_suppkey AS VARCHAR) AS supplier, l_linestatus AS area,
       l_returnflag AS age_band, CAST(l_quantity AS BIGINT) AS doses FROM lineitem""",
    "row_to_line": """
SELECT concat_ws(',', coalesce(area, 'null'), coalesce(centre, 'null'),
                 coalesce(CAST(suppkey AS VARCHAR), 'null')) AS line FROM centres""",
    "project_columns": "SELECT date, area, age_band, doses FROM detail",
    "month_labels": f"""
SELECT month_start,
       upper(strftime(month_start, '%B')) AS month_upper,
       CAST(month(month_start) - 1 AS INTEGER) AS month_index0,
       {_IT_MONTHS}[month(month_start)] AS month_it,
       strftime(month_start, '%b') AS month_abbr
FROM (SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS month_start
      FROM (SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem))""",
    "calendar_days": """
SELECT date,
       CAST(date_trunc('month', date) AS DATE) AS month_start,
       CAST(dayofmonth(last_day(date)) AS INTEGER) AS days_in_month,
       CAST(dayofmonth(date) AS INTEGER) AS day_of_month,
       CAST(dayofmonth(last_day(date)) + 1 AS INTEGER) AS forecast_x,
       CAST(date_trunc('month', date) + INTERVAL 1 MONTH AS DATE) AS next_month_start
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem)""",
    "int_div_average": """
SELECT m.area, m.month_start,
       CAST((m.total // c.n_centres) // dayofmonth(last_day(m.month_start)) AS BIGINT)
         AS avg_per_centre
FROM monthly m JOIN centre_counts c ON m.area = c.area""",
    "trend_forecast": "SELECT * FROM forecasts",
    "topk_per_group": "SELECT * FROM ranking",
    "filter_closed_interval": """
SELECT * FROM summary WHERE date >= DATE '1997-01-01' AND date <= DATE '1997-05-31'""",
    "filter_open_interval": """
SELECT * FROM summary WHERE date > DATE '1997-01-01' AND date < DATE '1997-05-31'""",
    "active_day_filter": "SELECT month_start, area, age_band, active_days FROM active",
    "filter_not_contains": "SELECT area, centre FROM centres WHERE NOT contains(centre, '7')",
    "filter_equals": "SELECT * FROM per_day WHERE area = 'NATION_3'",
    "active_day_semi_join": """
SELECT p.* FROM per_day p
WHERE EXISTS (SELECT 1 FROM active a
              WHERE a.month_start = CAST(date_trunc('month', p.date) AS DATE)
                AND a.area = p.area AND a.age_band = p.age_band)""",
    "join_centres": """
SELECT m.area, m.month_start, m.total, c.n_centres, c.n_named_centres
FROM monthly m JOIN centre_counts c ON m.area = c.area""",
    "monthly_total": "SELECT * FROM monthly",
    "total_over_supplier": "SELECT * FROM per_day",
    "count_centres": "SELECT * FROM centre_counts",
    "trend_fit": """
SELECT month_start, area, age_band, n,
       (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope,
       ((n * sxx - sx * sx) * sy - (n * sxy - sx * sy) * sx) / (n * (n * sxx - sx * sx))
         AS intercept
FROM active""",
    "topk_list": """
SELECT date, age_band, list({'forecast': forecast, 'area': area} ORDER BY rank) AS top
FROM ranking GROUP BY date, age_band""",
    "distinct_keys": """
SELECT DISTINCT area, CAST(date_trunc('month', date) AS DATE) AS month_start FROM summary""",
    "count_by_key": """
SELECT date, area, age_band, COUNT(*) AS n_rows FROM detail GROUP BY date, area, age_band""",
    "key_count": """
SELECT COUNT(*) AS n_keys FROM (SELECT DISTINCT month_start, area, age_band FROM active)""",
    "row_count": "SELECT COUNT(*) AS n_rows FROM lineitem",
    "sort_composite": "SELECT * FROM per_day ORDER BY date, area, age_band",
    "first_row": "SELECT * FROM summary ORDER BY date, area, total LIMIT 1",
    "limit_preview": "SELECT * FROM summary ORDER BY date, area, total LIMIT 10",
    "export_monthly_lines": f"""
SELECT '(' || area || ',' || {_IT_MONTHS}[month] || ')' AS label,
       CAST(avg_per_centre AS VARCHAR) AS value,
       'Regione, Mese;Numero medio vaccinazioni' AS header
FROM c1""",
    "export_top5_lines": """
SELECT '(' || strftime(date, '%Y-%m-%d') || ',' || age_band || ')' AS label,
       '[' || array_to_string(list_transform(top, lambda x: '(' || CAST(x.forecast AS VARCHAR)
                                                  || ',' || x.area || ')'), ', ') || ']'
         AS value,
       'Data, Fascia Anagrafica;TOP 5 (Numero vaccinazioni previste, Regione)' AS header
FROM c2""",
}

ORACLE_SQL: dict[str, str] = {name: _BASE + tail for name, tail in _ORACLE_TAIL.items()}
