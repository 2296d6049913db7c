"""Publish the tables and the unified view to Spark SQL.

After ``register_views`` the warehouse names resolve in ``spark.sql``:
``delays_all``, ``stations_regions``, ``weather_all`` and ``unified_all``. SQL
written for the warehouse (APPROX_PERCENTILE, COUNT(DISTINCT CASE ...),
NULLIF, scalar subqueries) runs on them as is; Catalyst plans it like the
DataFrame form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from railpulse.operators.unified import unified_all
from railpulse.sources.sinks import create_view


def register_views(delays: DataFrame, stations: DataFrame, weather: DataFrame,
                   prefix: str = "") -> DataFrame:
    """Create or replace the four temp views; returns the unified view's frame."""
    create_view(delays, f"{prefix}delays_all")
    create_view(stations, f"{prefix}stations_regions")
    create_view(weather, f"{prefix}weather_all")
    return create_view(unified_all(delays, stations, weather), f"{prefix}unified_all")
