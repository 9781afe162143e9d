"""Text renderings of rows and report cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from areacast.functions._cols import ColumnOrName, col


def row_to_line(cols: Sequence[ColumnOrName], sep: str = ",") -> Column:
    """Join the fields of a row into one delimited line; null becomes ``null``."""
    return F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("null")) for c in cols])


def pair_label(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``(a,b)`` as text."""
    return F.format_string("(%s,%s)", col(a).cast("string"), col(b).cast("string"))


def top_list_text(items: ColumnOrName, value_field: str = "forecast",
                  name_field: str = "area") -> Column:
    """``[(v1,name1), (v2,name2), ...]`` from an array of structs, in array order."""
    rendered = F.transform(
        col(items),
        lambda x: F.format_string("(%s,%s)", x[value_field].cast("string"), x[name_field]),
    )
    return F.concat(F.lit("["), F.array_join(rendered, ", "), F.lit("]"))
