"""Report lines of the two exported results (two text columns each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.functions.calendar import ITALIAN_MONTHS
from areacast.functions.text import pair_label, top_list_text

# Report headers, first and second column.
MONTHLY_HEADER = ("Regione, Mese", "Numero medio vaccinazioni")
TOP5_HEADER = ("Data, Fascia Anagrafica", "TOP 5 (Numero vaccinazioni previste, Regione)")


def monthly_lines(result: DataFrame) -> DataFrame:
    """``(AREA,Mese)`` and the average, from (area, month, avg_per_centre),
    in the order of ``result``: C1 is sorted by area and month start, which
    stays chronological across a year end (the month number alone would
    put December after January)."""
    names = F.array(*[F.lit(n) for n in ITALIAN_MONTHS])
    label = pair_label("area", F.element_at(names, F.col("month")))
    return result.select(label.alias("label"),
                         F.col("avg_per_centre").cast("string").alias("value"))


def top5_lines(result: DataFrame) -> DataFrame:
    """``(date,band)`` and ``[(n,AREA), ...]`` from (date, age_band, top), in
    the order of ``result`` (C2 is sorted by date, then band)."""
    return result.select(pair_label(F.col("date").cast("string"), "age_band").alias("label"),
                         top_list_text("top").alias("value"))
