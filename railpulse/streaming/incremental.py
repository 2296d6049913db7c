"""The stored unified table, kept up to date by day.

The ledgers of the delay and the weather load say which days each file changed. Days of
ledger entries that the unified table has not taken in are its change set; only those
days are read from the delays, the weather and the unified table itself, late weather
included. The entries are noted as applied after the days are stored, so a run that is lost
repeats them. Another stations table changes every day: its mark is kept with the
entries, and the table is then built anew. The days of a change set are a list in
the plan, which prunes partitions before anything is read; a calendar bounds it.

The keys that the joins rely on are checked the same way: per day the number of rows,
of distinct keys and a sum over the keys' hashes are kept, and only changed days are
read again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from railpulse.constants import DELAYS_ALL, UNIFIED_COLUMNS, WEATHER_ALL
from railpulse.operators.quality import DuplicateKeyError
from railpulse.operators.unified import unified_all
from railpulse.sources.sinks import append_days, read_stored, read_table
from railpulse.streaming.ledger import Ledger

APPLIED = "entry STRING, stations STRING, at TIMESTAMP"
_TYPES = {f.name: f.dataType for s in (DELAYS_ALL, WEATHER_ALL) for f in s.fields} | {"county": T.StringType(), "region": T.StringType()}
UNIFIED_ALL = T.StructType([T.StructField(c, _TYPES[c]) for c in UNIFIED_COLUMNS])
KEY_MARKS = T.StructType([T.StructField("date", T.DateType()), *[T.StructField(c, T.LongType()) for c in ("rows", "distinct_keys", "key_sum")]])


def on_days(table: DataFrame, days: list[dt.date] | None) -> DataFrame:
    return table if days is None else table.where(F.col("date").isin(days) if days else F.lit(False))


def stations_mark(stations: DataFrame) -> str:
    """The same for the same rows in any order."""
    r = stations.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(station_id, station_name, county, region, region_id))").alias("x"),
                     F.sum(F.xxhash64("station_id", "county", "region", "region_id").cast("decimal(20,0)")).alias("s")).first()
    return f"{r['n']}:{r['x']}:{r['s']}"


def changes(spark: SparkSession, unified_path: str, ledgers: list[Ledger], stations: DataFrame) -> tuple[list[str], list[dt.date] | None, str]:
    """(entries not taken in yet, their days or None for all, mark of the stations)."""
    applied, mark = read_stored(spark, f"{unified_path.rstrip('/')}_applied"), stations_mark(stations)
    new = ledgers[0].files().select("entry", "days")
    for ledger in ledgers[1:]:
        new = new.union(ledger.files().select("entry", "days"))
    last = None
    if applied is not None and read_stored(spark, unified_path) is not None:
        new = new.join(applied.select("entry"), "entry", "left_anti")
        last = applied.agg(F.max_by("stations", "at")).first()[0]
    new = new.persist()
    try:
        entries = [r["entry"] for r in new.select("entry").collect()]  # a row per file of a refresh
        days = sorted(r["date"] for r in new.select(F.explode("days").alias("date")).distinct().collect()) if last == mark else None
    finally:
        new.unpersist()
    return entries, days, mark


def update_unified(spark: SparkSession, unified_path: str, delays: DataFrame, stations: DataFrame, weather: DataFrame,
                   days: list[dt.date] | None) -> int:
    """Rewrite the given days of the stored unified table (None: all of it) from
    tables partitioned by day. Returns the rows written."""
    if days == []:
        return 0
    changed = unified_all(on_days(delays, days), stations, on_days(weather, days))
    if days is None:
        return append_days(changed, unified_path, UNIFIED_ALL, replace_all=True)
    return append_days(changed, unified_path, UNIFIED_ALL)


def applied(spark: SparkSession, unified_path: str, entries: list[str], mark: str) -> None:
    rows = [(e, mark, dt.datetime.now()) for e in entries or [""]]
    spark.createDataFrame(rows, APPLIED).coalesce(1).write.mode("append").parquet(f"{unified_path.rstrip('/')}_applied")


def require_unique_days(spark: SparkSession, table_path: str, schema: T.StructType, keys: list[str], days: list[dt.date] | None) -> int:
    """Fail when a key of a table partitioned by day is not unique on one of the
    given days (None, or no marks yet: all days). The marks of sound days are
    kept in ``<table>_keys``; returns how many days were read."""
    marks_path = f"{table_path.rstrip('/')}_keys"
    if read_stored(spark, marks_path) is None:
        days = None
    if days == []:
        return 0
    rows = on_days(read_table(spark, table_path, schema), days)
    per_key = rows.groupBy("date", *[k for k in keys if k != "date"]).agg(F.count(F.lit(1)).alias("n"))
    marks = per_key.groupBy("date").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                                        F.expr(f"bit_xor(xxhash64({', '.join(keys)}))").alias("key_sum")).persist()
    try:
        bad = marks.where("rows > distinct_keys").orderBy("date").first()
        if bad is not None:
            raise DuplicateKeyError(f"{table_path}: ({', '.join(keys)}) is not unique on {bad['date']}")
        return append_days(marks, marks_path, KEY_MARKS)
    finally:
        marks.unpersist()
