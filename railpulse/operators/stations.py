"""Station dimension: clean names, dense ids, county -> region -> region id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from railpulse.constants import COUNTY_BOXES
from railpulse.functions.geo import county_of, region_id_of, region_of
from railpulse.functions.names import clean_name
from railpulse.operators.ordering import dense_row_ids


def clean_coords(coords: DataFrame) -> DataFrame:
    return coords.select(clean_name("station_name").alias("station_name"),
                         F.col("lat").cast("double").alias("lat"),
                         F.col("lon").cast("double").alias("lon"))


def with_station_ids(coords: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """station_id = 1..n in station-name byte order (lat, lon break ties).

    Numbered with a range-partitioned running count, not a one-task global
    window, so the dimension can grow without limit."""
    return dense_row_ids(coords, ["station_name", "lat", "lon"], "station_id", num_partitions)


def with_stable_ids(coords: DataFrame, stored: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Like ``with_station_ids``, but a name of the ``stored`` lookup (station_id,
    station_name) keeps its id and new names get the ids after the largest, so that
    rows stored with old ids stay right."""
    known = stored.select(F.col("station_name").alias("_name"), "station_id")
    last = known.agg(F.coalesce(F.max("station_id"), F.lit(0))).first()[0]
    joined = coords.join(known, F.col("station_name").eqNullSafe(F.col("_name")), "left").drop("_name")
    new = joined.where("station_id is null").drop("station_id")
    return joined.where("station_id is not null").unionByName(
        dense_row_ids(new, ["station_name", "lat", "lon"], "station_id", num_partitions, start=last + 1))


def assign_county(df: DataFrame, lat: str = "lat", lon: str = "lon", boxes=COUNTY_BOXES) -> DataFrame:
    """First matching county box per row, as a CASE chain (no join)."""
    return df.withColumn("county", county_of(lat, lon, boxes))


def assign_county_by_join(df: DataFrame, lat: str = "lat", lon: str = "lon",
                          boxes=COUNTY_BOXES) -> DataFrame:
    """The same first match from the boxes as data: the constant list (20 entries, in
    order of priority) is joined to each row as an array, the boxes that hold the
    point are kept, and the first one wins. No row is moved."""
    table = F.array(*[F.struct(F.lit(n).alias("county"), *[F.lit(x).alias(k) for k, x in zip(("a", "b", "c", "d"), box)])
                      for n, *box in boxes])
    holding = F.filter(table, lambda x: F.col(lat).between(x["a"], x["b"]) & F.col(lon).between(x["c"], x["d"]))
    return df.withColumn("county", F.get(holding, F.lit(0))["county"])


def assign_region(df: DataFrame, county: str = "county") -> DataFrame:
    """County -> region -> region id, NULL when unknown."""
    return (df.withColumn("region", region_of(county))
              .withColumn("region_id", region_id_of("region")))


def stations_regions(coords: DataFrame, num_partitions: int | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Raw (name, lat, lon) -> the stations table (7 columns, by name). With a
    ``stored`` lookup its ids are kept."""
    clean = clean_coords(coords)
    ids = with_station_ids(clean, num_partitions) if stored is None else with_stable_ids(clean, stored, num_partitions)
    s = assign_region(assign_county(ids))
    return s.select("station_name", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
                    "county", "region", "region_id", "station_id")


def station_lookup(stations: DataFrame) -> DataFrame:
    return stations.select(F.col("station_id").cast("int").alias("station_id"), "station_name")


def station_probe(stations: DataFrame, min_id_exclusive: int = 28) -> DataFrame:
    """Stations after the first ids (which are code-named in the source data)."""
    return stations.where(F.col("station_id") > min_id_exclusive)
