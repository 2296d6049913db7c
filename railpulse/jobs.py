"""Batch entry points: the preprocessing runs and the KPI report.

Each job reads its inputs with explicit schemas, runs one lazy plan and writes
its outputs; counts that the source system printed are collected with an
``Observation`` during the write instead of a second pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from railpulse.constants import DELAYS_ALL
from railpulse.operators import delays as D
from railpulse.operators import stations as S
from railpulse.operators.quality import require_rows
from railpulse.sources import sinks as SK
from railpulse.streaming.refresh import write_kpis


@dataclass
class DelayRunReport:
    total_before: int
    total_after: int
    removed: int
    pct_kept: float | None
    rows_written: int
    undated: int = 0  # records left out because their date is not readable


def preprocess_delays(records: DataFrame, lookup: DataFrame, out_path: str,
                      start: str | None = None, end: str | None = None,
                      fmt: str = "parquet") -> DelayRunReport:
    """Raw records of one date range -> daily station delays at ``out_path``.

    ``fmt="parquet"`` appends the range's days to a date-partitioned table
    (repeat-safe); ``fmt="csv"`` writes the export form (header, NULL as
    empty, ordered by date and station)."""
    dated = Observation("dated")
    records = records.observe(dated, F.count_if(F.col("service_date").isNull()).alias("undated"))
    named = D.with_station_name(D.in_date_range(records.where("service_date is not null"), start, end))
    # Counted on the named records (cleaning changes no count), then
    # aggregated with the name cleaning after the first aggregate.
    observed, obs = D.observe_early_filter(named)
    delays = D.attach_station_id(D.daily_station_delays_from_named(observed), lookup)
    if fmt == "parquet":
        written = SK.append_days(delays, out_path, DELAYS_ALL)
    else:
        SK.export_csv(delays, out_path, sort_cols=["date", "station_name"])
        written = delays.sparkSession.read.option("header", True).csv(out_path).count()
    m = obs.get or {}
    before, after = int(m.get("total_before", 0)), int(m.get("total_after", 0))
    pct = round(100.0 * after / before, 1) if before else None
    return DelayRunReport(before, after, before - after, pct, written, int((dated.get or {}).get("undated", 0)))


def known_ids(spark: SparkSession, ids_path: str) -> DataFrame | None:
    """(station_id, station_name) of the id log: a name's first id. None before the
    first run."""
    log = SK.read_stored(spark, ids_path)
    return None if log is None else log.groupBy("station_name").agg(F.min("station_id").alias("station_id")).select("station_id", "station_name")


def preprocess_stations(coords: DataFrame, stations_out: str, lookup_out: str) -> DataFrame:
    """Station coordinates -> the stations table (Parquet) and the id lookup
    (JSON lines). Ids live in an append-only log beside the table (``<table>_ids``): new
    names are added in one file before anything is replaced, so a run that is lost at
    any point keeps every id given out. Returns the stations table as written."""
    spark = coords.sparkSession
    ids_path = f"{stations_out.rstrip('/')}_ids"
    require_rows(coords, "station coordinates")
    stored = known_ids(spark, ids_path)
    if stored is None:  # a table from before there was a log
        stored = SK.read_stored(spark, stations_out)
        if stored is not None:
            S.station_lookup(stored).coalesce(1).write.mode("append").parquet(ids_path)
            stored = known_ids(spark, ids_path)
    given = S.station_lookup(S.stations_regions(coords, stored=stored))
    if stored is not None:
        given = given.join(stored.select(F.col("station_id").alias("_id")), F.col("station_id") == F.col("_id"), "left_anti")
    given = given.checkpoint(eager=True)
    if not given.isEmpty():
        given.coalesce(1).write.mode("append").parquet(ids_path)  # new names only
    stations = S.stations_regions(coords, stored=known_ids(spark, ids_path))
    SK.write_result(stations.checkpoint(eager=True), stations_out)
    written = spark.read.parquet(stations_out)
    SK.export_lookup_json(S.station_lookup(written), lookup_out)
    return written


def kpi_report(spark: SparkSession, unified: DataFrame, out_root: str,
               min_trains: int = 10) -> dict[str, str]:
    """Write the KPI tables (with the documented variants, the weather effect and
    the region share) as Parquet; the unified table's joins run once."""
    out = out_root.rstrip("/")
    return {name: f"{out}/{name}" for name in write_kpis(spark, unified, out, min_trains)}


__all__ = ["DelayRunReport", "preprocess_delays", "preprocess_stations", "kpi_report"]
