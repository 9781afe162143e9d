"""areacast: regional campaign analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` column expressions: no Python UDFs, no actions
inside operators, no driver-side collection. Queries are composed in
:mod:`areacast.plans.queries`.
"""

from areacast.plans.queries import (
    forecast_top5,
    monthly_avg_per_centre,
    monthly_avg_per_centre_sql,
)

__all__ = ["forecast_top5", "monthly_avg_per_centre", "monthly_avg_per_centre_sql"]
