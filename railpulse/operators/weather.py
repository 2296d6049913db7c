"""Weather: region configuration, response flattening, typing and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from railpulse.functions.weather import high_precip, high_temp, high_wind

WEATHER_COLUMNS = ("region_id", "date", "temperature_mean_c", "precipitation_sum_mm",
                   "wind_gust_max_kmh", "high_temp", "high_wind", "high_precip")


def regions_from_config(config: DataFrame) -> DataFrame:
    """``{"regions": [...]}`` -> (region_id, region_name, lat, lon); the id is
    the 0-based position in the list."""
    return (config.select(F.posexplode("regions").alias("region_id", "r"))
                  .select(F.col("region_id").cast("int").alias("region_id"),
                          "r.region_name", "r.lat", "r.lon"))


ARRAYS = ("time", "temperature_2m_mean", "wind_gusts_10m_max", "precipitation_sum")


def unequal_arrays() -> Column:
    """Whether a response's daily arrays differ in length (a missing one has none)."""
    sizes = [F.coalesce(F.size(f"daily.{a}"), F.lit(-1)) for a in ARRAYS]
    return F.greatest(*sizes) != F.least(*sizes)


def flatten_responses(responses: DataFrame, region_col: str = "region_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """One response document per region with parallel daily arrays -> one row
    per (region, day). Arrays of unequal length pad with NULL."""
    z = F.arrays_zip(
        F.col("daily.time").alias("date"),
        F.col("daily.temperature_2m_mean").alias("temperature_mean_c"),
        F.col("daily.wind_gusts_10m_max").alias("wind_gust_max_kmh"),
        F.col("daily.precipitation_sum").alias("precipitation_sum_mm"),
    )
    z = F.when(unequal_arrays(), F.raise_error(F.lit("daily arrays of unequal length"))).otherwise(z)
    return responses.select(region_col, *extra, F.inline_outer(z)).where(F.col("date").isNotNull())


def enforce_weather_schema(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Typed projection by column name, in the table's column order; ``extra``
    columns follow."""
    return df.select(
        F.col("region_id").try_cast("int").alias("region_id"),
        F.col("date").try_cast("date").alias("date"),
        F.col("temperature_mean_c").try_cast("double").alias("temperature_mean_c"),
        F.col("precipitation_sum_mm").try_cast("double").alias("precipitation_sum_mm"),
        F.col("wind_gust_max_kmh").try_cast("double").alias("wind_gust_max_kmh"),
        *extra,
    )


def with_flags(measures: DataFrame, strict: bool = False) -> DataFrame:
    """Add the three extreme flags. ``strict`` fails the job on a NULL
    measurement (the source system crashed there) instead of a NULL flag."""
    t, w, p = F.col("temperature_mean_c"), F.col("wind_gust_max_kmh"), F.col("precipitation_sum_mm")
    if strict:
        bad = t.isNull() | w.isNull() | p.isNull()
        t = F.when(bad, F.raise_error(F.lit("NULL weather measurement"))).otherwise(t)
    return measures.select(
        "region_id", "date", "temperature_mean_c", "precipitation_sum_mm", "wind_gust_max_kmh",
        high_temp(t).alias("high_temp"), high_wind(w).alias("high_wind"),
        high_precip(p).alias("high_precip"))


def weather_from_responses(responses: DataFrame) -> DataFrame:
    """Landed responses -> weather table rows (flatten, type, flag)."""
    return with_flags(enforce_weather_schema(flatten_responses(responses)))
