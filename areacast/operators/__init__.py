"""DataFrame -> DataFrame operators. No actions, no UDFs."""

from areacast.operators.aggregates import (
    centre_counts,
    count_by_key,
    daily_total,
    distinct_keys,
    key_count,
    monthly_total,
    row_count,
)
from areacast.operators.export import monthly_lines, top5_lines
from areacast.operators.filters import equals, not_contains, positive, within
from areacast.operators.joins import join_centres, per_centre_average, semi_join
from areacast.operators.ranking import first_row, preview, ranked_list, sort_by, top_k_per_group
from areacast.operators.trend import (
    active_day_semi_join,
    active_keys,
    fit_trend,
    forecast_next_month,
    keep_active,
    trend_moments,
)

__all__ = [
    "active_day_semi_join", "active_keys", "centre_counts", "count_by_key",
    "daily_total", "distinct_keys", "equals", "first_row", "fit_trend",
    "forecast_next_month", "join_centres", "keep_active", "key_count", "monthly_lines",
    "per_centre_average",
    "monthly_total", "not_contains", "positive", "preview", "ranked_list",
    "row_count", "semi_join", "sort_by", "top5_lines", "top_k_per_group",
    "trend_moments", "within",
]
