"""Column positions and types of the input files.

Only the positions the queries read are fixed; further columns are ignored.
"""

from __future__ import annotations


# (position, name, type) of the used columns.
CENTRES_FIELDS = ((0, "area", "string"), (1, "centre", "string"))
DAILY_SUMMARY_FIELDS = ((0, "date", "date"), (1, "area", "string"), (2, "total", "bigint"))
DAILY_DETAIL_FIELDS = (
    (0, "date", "date"),
    (1, "supplier", "string"),
    (2, "area", "string"),
    (3, "age_band", "string"),
    (5, "doses", "bigint"),
)
