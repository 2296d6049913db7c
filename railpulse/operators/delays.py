"""Raw train records -> daily station delays.

One lazy plan: date range, station of record, named-only, cast, non-early
filter, (date, raw name) aggregate, name cleaning, (date, station) aggregate,
station id lookup. Both aggregates are partial + final hash aggregates, so a
station holding a third of all records is combined map-side before any
shuffle, and the name cleaning runs on aggregated rows, not on every record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from railpulse.functions.names import STATION_RECORD_TYPES, clean_name, station_of_record


def in_date_range(records: DataFrame, start: str | None, end: str | None,
                  date_col: str = "service_date") -> DataFrame:
    """Inclusive date range; either bound may be open. Pushed to the scan."""
    c = F.col(date_col)
    if start is not None:
        records = records.where(c >= F.lit(start).cast("date"))
    if end is not None:
        records = records.where(c <= F.lit(end).cast("date"))
    return records


def with_station_name(records: DataFrame) -> DataFrame:
    """Records that name a station, with that name still raw (untrimmed).

    NULL and empty names are dropped *before* cleaning, as the source does: a
    name of only quotes or blanks survives and becomes ''."""
    # Sections and unknown types name no station; saying so here lets a stored
    # table skip them in the scan.
    return (records.where(F.col("record_type").isin(*STATION_RECORD_TYPES))
                   .withColumn("station_name", station_of_record())
                   .where(F.col("station_name").isNotNull() & (F.col("station_name") != "")))


def clean_records(named: DataFrame) -> DataFrame:
    """Rename, prune and cast: (date, station_name, delay). Bad dates or
    numbers become NULL instead of failing the job."""
    return named.select(
        F.col("service_date").try_cast("date").alias("date"),
        clean_name("station_name").alias("station_name"),
        F.col("delay").try_cast("double").alias("delay"),
    )


def non_early(clean: DataFrame) -> DataFrame:
    """Keep on-time and delayed records (delay >= 0); NULL delays go too."""
    return clean.where(F.col("delay") >= 0)


def early_filter_counts(clean: DataFrame, by: list[str | Column] | None = None) -> DataFrame:
    """Records before / after the non-early filter, removed and % kept (one
    decimal), as a single aggregate pass (optionally per group)."""
    kept = F.count_if(F.col("delay") >= 0)
    aggs = [F.count(F.lit(1)).alias("total_before"), kept.alias("total_after")]
    g = clean.groupBy(*by).agg(*aggs) if by else clean.agg(*aggs)
    return g.select(
        *(by or []), "total_before", "total_after",
        (F.col("total_before") - F.col("total_after")).alias("removed"),
        F.round(F.lit(100.0) * F.col("total_after") / F.col("total_before"), 1).alias("pct_kept"),
    )


def observe_early_filter(clean: DataFrame, name: str = "early_filter") -> tuple[DataFrame, Observation]:
    """The same counts collected while the downstream write runs: no second
    pass over the records. Read ``obs.get`` after the action."""
    obs = Observation(name)
    observed = clean.observe(obs, F.count(F.lit(1)).alias("total_before"),
                             F.count_if(F.col("delay") >= 0).alias("total_after"))
    return observed, obs


def daily_station_delays(kept: DataFrame) -> DataFrame:
    """(date, station_name) -> total delay, train count, average delay."""
    return kept.groupBy("date", "station_name").agg(
        F.sum("delay").alias("total_delay_minutes"),
        F.count(F.lit(1)).cast("int").alias("train_count"),
        F.avg("delay").alias("avg_delay_minutes"),
    )


def daily_station_delays_from_named(named: DataFrame) -> DataFrame:
    """The same daily aggregate as ``daily_station_delays(non_early(
    clean_records(named)))``, with the name cleaning moved after a first
    aggregation.

    Records are first aggregated by (date, raw name), which partial
    aggregation shrinks map-side. The two regular expressions of
    ``clean_name`` then run once per distinct raw name and day instead of once
    per record, and a second, small aggregation merges raw spellings that
    clean to the same name. Sums and counts re-aggregate exactly; the average
    is their quotient, as ``avg`` computes it."""
    typed = named.select(
        F.col("service_date").try_cast("date").alias("date"),
        F.col("station_name").alias("_raw"),
        F.col("delay").try_cast("double").alias("delay"))
    per_raw = (typed.where(F.col("delay") >= 0)
                    .groupBy("date", "_raw")
                    .agg(F.sum("delay").alias("_s"), F.count(F.lit(1)).alias("_n")))
    per_name = (per_raw.withColumn("station_name", clean_name("_raw"))
                       .groupBy("date", "station_name")
                       .agg(F.sum("_s").alias("total_delay_minutes"), F.sum("_n").alias("_n")))
    return per_name.select(
        "date", "station_name", "total_delay_minutes",
        F.col("_n").cast("int").alias("train_count"),
        (F.col("total_delay_minutes") / F.col("_n")).alias("avg_delay_minutes"))


def attach_station_id(daily: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join of daily delays to the (station_id, station_name) lookup.

    Names missing from the lookup (replacement buses) keep a NULL id. The
    lookup is one row per station: the planner broadcasts it when its size
    is known to be small and falls back to a shuffle join otherwise."""
    lk = lookup.select("station_name", F.col("station_id").cast("int").alias("station_id"))
    return (daily.join(lk, "station_name", "left")
                 .select("date", "station_id", "station_name", "total_delay_minutes",
                         "train_count", "avg_delay_minutes"))


def delays_all(records: DataFrame, lookup: DataFrame, start: str | None = None,
               end: str | None = None) -> DataFrame:
    """The whole preprocessing run: raw records -> the delays table."""
    named = with_station_name(in_date_range(records, start, end))
    return attach_station_id(daily_station_delays_from_named(named), lookup)


def enforce_delay_schema(staged: DataFrame) -> DataFrame:
    """Typed projection of a text delay file, bound by column name, in the
    staging order (date, station_name, station_id, total, count, avg)."""
    return staged.select(
        F.col("date").try_cast("date").alias("date"),
        F.col("station_name").cast("string").alias("station_name"),
        F.col("station_id").try_cast("int").alias("station_id"),
        F.col("total_delay_minutes").try_cast("double").alias("total_delay_minutes"),
        F.col("train_count").try_cast("int").alias("train_count"),
        F.col("avg_delay_minutes").try_cast("double").alias("avg_delay_minutes"),
    )


DELAY_TYPES = {"station_id": "int", "total_delay_minutes": "double", "train_count": "int", "avg_delay_minutes": "double"}


def with_reject_reason(staged: DataFrame) -> DataFrame:
    """Adds ``reason`` to text delay rows: the first column (date, station_name, then
    the numbers) whose value cannot be stored, NULL for a sound row. A row needs a
    date and a station name; a number may be missing but not unreadable."""
    reason = F.when(F.col("date").try_cast("date").isNull(), "date").when(
        F.col("station_name").isNull() | (F.col("station_name") == ""), "station_name")
    for c, kind in DELAY_TYPES.items():
        reason = reason.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), c)
    return staged.withColumn("reason", reason)
