"""Sources (CSV files, warehouse tables) and the CSV report sink."""

from areacast.sources.csv_files import (
    checked_field,
    read_centres,
    read_csv,
    read_daily_detail,
    read_daily_summary,
    write_csv,
    write_report,
)
from areacast.sources.tables import (
    centres_from_tables,
    daily_detail_from_tables,
    daily_summary_from_tables,
    supplier_areas,
    table,
)

__all__ = [
    "checked_field",
    "centres_from_tables", "daily_detail_from_tables", "daily_summary_from_tables",
    "read_centres", "read_csv", "read_daily_detail", "read_daily_summary",
    "supplier_areas", "table", "write_csv", "write_report",
]
