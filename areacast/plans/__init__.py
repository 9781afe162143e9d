"""Composed queries and the batch job."""

from areacast.plans.queries import (
    forecast_ranking,
    forecast_top5,
    monthly_avg_per_centre,
    monthly_avg_per_centre_sql,
)

__all__ = ["forecast_ranking", "forecast_top5", "monthly_avg_per_centre",
           "monthly_avg_per_centre_sql"]
