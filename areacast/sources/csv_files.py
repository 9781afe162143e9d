"""CSV sources and the report sink.

Readers take the used columns by position (the files carry more columns than
the queries need) and parse them strictly: a bad date or integer raises, as
the job must not silently drop or null such rows. Only the selected columns
are parsed (CSV column pruning).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from areacast.schemas import CENTRES_FIELDS, DAILY_DETAIL_FIELDS, DAILY_SUMMARY_FIELDS

Field = tuple[int, str, str]


def checked_field(c: Column, dtype: str, field: str) -> Column:
    """A parsed field: null (a value that is empty, missing from a short line, or
    not of its type) raises for dates and integers; a string may be null."""
    if dtype == "string":
        return c
    return F.coalesce(c, F.raise_error(F.lit(f"cannot parse {field} as {dtype}")))


def read_csv(spark: SparkSession, path: str | Sequence[str], fields: Sequence[Field],
             header: bool = True, sep: str = ",", check_all: bool = True) -> DataFrame:
    """Read CSV file(s) and return the ``fields`` (position, name, type).

    With ``header=True`` the first line of *every* file is a header and is
    skipped; a data line that happens to contain header text is kept. With
    ``header=False`` every line is data and columns are taken by position.

    The scan parses each used field once, to its type: dates are ISO
    ``yyyy-MM-dd`` and real calendar days, integers an optional sign and digits.
    What does not parse is null there, and `checked_field` raises on it. Its
    ``coalesce`` is no filter a scan can take, so a date window is not pushed into
    the parser, where it would hide bad rows.

    By default (``check_all=True``) any bad row raises, even one that a date
    window would drop. With ``check_all=False`` a count raises only on rows the
    query keeps; the date is still checked on every row.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    names = reader.csv(path).columns
    types = {pos: dtype for pos, _, dtype in fields}
    if max(types) >= len(names):
        raise ValueError(f"{path}: no column {max(types)}, only {len(names)} columns")
    schema = StructType()
    for pos, name in enumerate(names):
        schema.add(name, DataType.fromDDL(types.get(pos, "string")))
    raw = reader.schema(schema).options(**STRICT).csv(path).toDF(*[f"_c{pos}" for pos in range(len(names))])
    return _checked(raw, fields, check_all)


#: A field that is not of its type is null in the parser's result.
STRICT = {"mode": "PERMISSIVE", "dateFormat": "yyyy-MM-dd", "enableDateTimeParsingFallback": "false"}


def _checked(raw: DataFrame, fields: Sequence[Field], check_all: bool) -> DataFrame:
    """The fields of raw columns ``_c0``, ``_c1``, ..., checked."""
    checked = {name: checked_field(F.col(f"_c{pos}"), dtype, name) for pos, name, dtype in fields}
    if check_all:
        for _, name, dtype in fields:
            if dtype != "string":
                raw = raw.where(checked[name].isNotNull())
    return raw.select(*[c.alias(name) for name, c in checked.items()])


def parse_lines(lines: DataFrame, line: str, fields: Sequence[Field], sep: str = ",",
                check_all: bool = True) -> DataFrame:
    """The ``fields`` (position, name, type) of a column of CSV lines, parsed once,
    by the rules of `read_csv`; a line too short for a field has it empty."""
    types = {pos: dtype for pos, _, dtype in fields}
    schema = ", ".join(f"_c{pos} {types.get(pos, 'string')}" for pos in range(max(types) + 1))
    parsed = lines.select(F.from_csv(F.col(line), schema, {**STRICT, "sep": sep}).alias("fields"))
    return _checked(parsed.select(F.col("fields.*")), fields, check_all)


def read_centres(spark: SparkSession, path, header: bool = True,
                 check_all: bool = True) -> DataFrame:
    """(area, centre): one row per vaccination centre."""
    return read_csv(spark, path, CENTRES_FIELDS, header, check_all=check_all)


def read_daily_summary(spark: SparkSession, path, header: bool = True,
                       check_all: bool = True) -> DataFrame:
    """(date, area, total): vaccinations per day and area."""
    return read_csv(spark, path, DAILY_SUMMARY_FIELDS, header, check_all=check_all)


def read_daily_detail(spark: SparkSession, path, header: bool = True,
                      check_all: bool = True) -> DataFrame:
    """(date, supplier, area, age_band, doses): per day, supplier, area and band."""
    return read_csv(spark, path, DAILY_DETAIL_FIELDS, header, check_all=check_all)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """Plain multi-file CSV write (one file per task), replacing ``path``."""
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def write_report(lines: DataFrame, path: str, header: Sequence[str],
                 sep: str = ";", one_file: bool = False) -> None:
    """Write a two-column report (already sorted) under ``header``.

    The sorted partitions become ordered part files, each with the header;
    their number does not depend on a row count. ``one_file`` asks for a single
    file, written by one task in order: for reports known to be small.
    """
    out = lines.toDF(*header)
    if one_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)
