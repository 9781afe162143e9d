"""Column-expression building blocks (calendar, exact arithmetic, text)."""

from areacast.functions.arithmetic import (
    exact_forecast,
    exact_intercept,
    exact_slope,
    idiv,
    int_div_average,
)
from areacast.functions.calendar import (
    ITALIAN_MONTHS,
    day_of_month,
    days_in_month,
    forecast_day,
    month_abbr,
    month_index0,
    month_label_it,
    month_name_upper,
    month_number,
    month_start,
    next_month_start,
)
from areacast.functions.text import pair_label, row_to_line, top_list_text

__all__ = [
    "ITALIAN_MONTHS", "day_of_month", "days_in_month", "exact_forecast",
    "exact_intercept", "exact_slope",
    "forecast_day", "idiv", "int_div_average", "month_abbr", "month_index0",
    "month_label_it", "month_name_upper", "month_number", "month_start",
    "next_month_start", "pair_label", "row_to_line", "top_list_text",
]
