"""Point in box for any table of boxes: a cover of grid cells and an equi-join.

A box belongs to the grid whose cells are as wide as its longer side or up to twice as
wide (a power of two), so that it touches at most two cells each way. A point has one cell
per grid in use. Points and boxes meet on (grid, cell), the box is tested
exactly, and of the boxes that hold a point the one of first priority wins. Equal points
are looked up once. Neither side is collected or broadcast by force; a crowded cell is a
skewed join key, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

FINEST, WIDEST = -20, 10  # grids from a millionth of a degree to 1024 degrees


def box_cells(boxes: DataFrame) -> DataFrame:
    """(grid, cy, cx, name, priority and the four bounds) of every cell that a box
    touches. Boxes with a missing or reversed bound hold nothing."""
    longer = F.greatest(F.col("lat_max") - F.col("lat_min"), F.col("lon_max") - F.col("lon_min"))
    grid = F.greatest(F.lit(FINEST), F.least(F.lit(WIDEST), F.ceil(F.log2(longer)))).cast("int")
    sound = boxes.where("lat_min <= lat_max and lon_min <= lon_max").withColumn("grid", F.when(longer > 0, grid).otherwise(F.lit(FINEST)))
    return sound.withColumn("cy", F.explode(_cells("lat_min", "lat_max"))).withColumn("cx", F.explode(_cells("lon_min", "lon_max")))


def _cells(low: str, high: str):
    width = F.pow(F.lit(2.0), F.col("grid"))
    return F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))


def first_box(points: DataFrame, boxes: DataFrame, lat: str = "lat", lon: str = "lon", out: str = "county") -> DataFrame:
    """``points`` with the name of the box of first priority (then name) that holds each,
    NULL where none does. ``boxes``: name, priority, lat_min, lat_max, lon_min, lon_max."""
    cells = box_cells(boxes)
    grids = sorted(r["grid"] for r in cells.select("grid").distinct().collect())  # 31 at most
    where = points.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).where("_lat is not null and _lon is not null").distinct()
    width = F.pow(F.lit(2.0), F.col("grid"))
    where = where.withColumn("grid", F.explode(F.array(*[F.lit(g) for g in grids]).cast("array<int>"))) \
        .withColumn("cy", F.floor(F.col("_lat") / width)).withColumn("cx", F.floor(F.col("_lon") / width))
    held = where.join(cells, ["grid", "cy", "cx"]).where(
        F.col("_lat").between(F.col("lat_min"), F.col("lat_max")) & F.col("_lon").between(F.col("lon_min"), F.col("lon_max")))
    best = held.groupBy("_lat", "_lon").agg(F.min_by("name", F.struct("priority", "name")).alias("_name"))
    joined = points.join(best, (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon")), "left")
    return joined.withColumn(out, F.col("_name")).drop("_lat", "_lon", "_name")
