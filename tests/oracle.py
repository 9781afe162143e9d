"""Differential check: a Spark query against DuckDB SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import math
import re

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):   # exact: the doubles are single divisions of exact integers
        return None if math.isnan(v) else v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(table) -> tuple[list[str], list[tuple]]:
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    rows = sorted((tuple(_norm(v) for v in r) for r in zip(*cols)), key=repr)
    return names, rows


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal (names, row count, values as multisets), else a reason."""
    s_names, s_rows = rows_of(spark_df.toArrow())
    d_names, d_rows = rows_of(con.sql(sql).to_arrow_table())
    if s_names != d_names:
        return f"columns differ: spark={s_names} duckdb={d_names}"
    if len(s_rows) != len(d_rows):
        return f"row counts differ: spark={len(s_rows)} duckdb={len(d_rows)}"
    if s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        return f"values differ, first pairs: {diff}"
    return None


def _type_name(t) -> str:
    # list child names are a writer convention ("element", "l", "item")
    return re.sub(r"list<\w+: ", "list<", str(t))


def types_of(spark_df, con, sql: str) -> tuple[dict, dict]:
    s = {f.name: _type_name(f.type) for f in spark_df.toArrow().schema}
    d = {f.name: _type_name(f.type) for f in con.sql(sql).to_arrow_table().schema}
    return s, d
