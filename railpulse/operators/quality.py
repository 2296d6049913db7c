"""Data-quality reports and guards. Each report is one aggregate pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


class EmptyInputError(RuntimeError):
    pass


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when ``df`` has no row (``isEmpty`` stops at the first row)."""
    if df.isEmpty():
        raise EmptyInputError(f"no rows in {what}")
    return df


def unmatched_stations(daily: DataFrame, lookup: DataFrame) -> DataFrame:
    """Station names of daily delays that the lookup does not know (the
    replacement-bus stops the unified table loses), with their volume."""
    missing = daily.join(lookup.select("station_name"), "station_name", "left_anti")
    return missing.groupBy("station_name").agg(
        F.count(F.lit(1)).alias("missing_days"),
        F.sum("train_count").cast("long").alias("train_count"))


def dq_stations(stations: DataFrame) -> DataFrame:
    """One row: stations, and how many lack a county, region, region id or
    station id, have a blank name, or lost a coordinate to a failed cast."""
    return stations.agg(
        F.count(F.lit(1)).alias("stations"),
        F.count_if(F.col("county").isNull()).alias("without_county"),
        F.count_if(F.col("region").isNull()).alias("without_region"),
        F.count_if(F.col("region_id").isNull()).alias("without_region_id"),
        F.count_if(F.col("station_id").isNull()).alias("without_station_id"),
        F.count_if(F.col("station_name").isNull() | (F.col("station_name") == "")).alias("blank_names"),
        F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("without_coordinates"),
    )


def duplicate_keys(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """One row for ``table``: rows, distinct keys, keys seen more than once and
    the surplus rows those keys add to any join on them."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("surplus_rows"),
    )


def dq_duplicate_keys(stations: DataFrame, lookup: DataFrame, weather: DataFrame,
                      delays: DataFrame) -> DataFrame:
    """Key uniqueness of every table the unified join relies on."""
    return (duplicate_keys(stations, ["station_id"], "stations_regions")
            .unionByName(duplicate_keys(lookup, ["station_name"], "station_lookup"))
            .unionByName(duplicate_keys(weather, ["date", "region_id"], "weather_all"))
            .unionByName(duplicate_keys(delays, ["date", "station_name"], "delays_all")))


class DuplicateKeyError(RuntimeError):
    pass


def require_unique(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Fail when a key of ``df`` is not unique: a join on it would multiply rows."""
    if not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
        raise DuplicateKeyError(f"{table}: ({', '.join(keys)}) is not unique")
    return df


def dq_rejects(rows: DataFrame) -> DataFrame:
    """Rejected rows per ``reason``."""
    return rows.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def weather_gaps(weather: DataFrame, week: DataFrame, region_ids: range = range(8)) -> DataFrame:
    """Every (region, day) of the given week(s) that has no weather row.

    ``week`` holds ``start_date`` and ``end_date`` (e.g. the newest weekly
    delay file's bounds); the expected cells are its days times the regions,
    generated in Spark and matched with an anti join."""
    days = week.select(F.explode(F.sequence("start_date", "end_date")).alias("date"))
    cells = days.select("date", F.explode(F.array(*[F.lit(i) for i in region_ids])).alias("region_id"))
    return cells.join(weather.select("date", "region_id"), ["date", "region_id"], "left_anti")
