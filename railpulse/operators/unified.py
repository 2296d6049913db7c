"""The unified table: daily delays + station dimension + weather flags.

Both dimensions are small next to the delays (one row per station; one row
per region and day). No hint is forced: Catalyst broadcasts a side whose
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-plans from measured sizes, with a shuffle join beyond that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from railpulse.constants import UNIFIED_COLUMNS
from railpulse.functions.geo import region_name_of


def unified_all(delays: DataFrame, stations: DataFrame, weather: DataFrame) -> DataFrame:
    """delays ⟕ stations (id) ⟕ weather (date, region id); rows without a
    station id are dropped first. No ORDER BY: see ``unified_sorted``."""
    d = delays.where(F.col("station_id").isNotNull())
    sr = stations.select("station_id", "county", "region", "region_id")
    w = weather.select("date", "region_id", "high_temp", "high_wind", "high_precip")
    j = d.join(sr, "station_id", "left").join(w, ["date", "region_id"], "left")
    return j.select(*UNIFIED_COLUMNS)


def unified_sorted(unified: DataFrame) -> DataFrame:
    """Display order of the view (date, station name); for export only."""
    return unified.orderBy("date", "station_name")


def unified_wide(delays: DataFrame, stations: DataFrame, weather: DataFrame) -> DataFrame:
    """The documented older view: joins stations by name and weather by
    region name, keeps rows without an id, carries the raw measures and
    names the flags extreme_*."""
    sr = stations.select("station_name", "region", "county")
    w = weather.select(
        "date", region_name_of("region_id").alias("_region_name"), "temperature_mean_c",
        "wind_gust_max_kmh", "precipitation_sum_mm",
        F.col("high_temp").alias("extreme_temperature"), F.col("high_wind").alias("extreme_wind"),
        F.col("high_precip").alias("extreme_precipitation"))
    j = (delays.join(sr, "station_name", "left")
               .join(w, (delays["date"] == w["date"]) & (F.col("region") == w["_region_name"]), "left"))
    return j.select(
        delays["date"], "station_name", "region", "county", "total_delay_minutes", "train_count",
        "avg_delay_minutes", "temperature_mean_c", "wind_gust_max_kmh", "precipitation_sum_mm",
        "extreme_temperature", "extreme_wind", "extreme_precipitation")
