"""The three punctuality KPIs over the unified table, each in the form the
warehouse SQL computes ("as written") and, where the documentation says
otherwise, in the documented form.

Scale notes. KPI 1 groups by region (a handful of huge groups): the exact
median never holds a group in one task (see
``railpulse.operators.ordering.lower_median``); the approximate one is an option
(``percentile_approx``, rank error 1 / accuracy). ``kpi_median_exact`` and
``kpi_resilience`` without a threshold checkpoint what they read twice, so a job
runs when the frame is built. KPI 2 and 3 group by station:
count-distinct-by-date is rewritten as a two-level aggregate (station, date)
then station, both with map-side combining, which is exact for any
duplication of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from railpulse.constants import DELAYED_AVG_MINUTES, MIN_TRAINS_DOCUMENTED
from railpulse.functions.weather import any_extreme, calm
from railpulse.operators.ordering import lower_median
from railpulse.session import ensure_checkpoint_dir


def _avg() -> Column:
    return F.col("avg_delay_minutes")


# (output column, flag column or None for all days)
MEDIAN_VARIANTS = (
    ("median_delay", None),
    ("median_high_temp", "high_temp"),
    ("median_high_wind", "high_wind"),
    ("median_high_precip", "high_precip"),
)


def _delayed_value(flag: str | None, threshold: float = DELAYED_AVG_MINUTES) -> Column:
    cond = _avg() > F.lit(threshold)
    if flag is not None:
        cond = (F.col(flag) == 1) & cond
    return F.when(cond, _avg())


def kpi_median(unified: DataFrame, accuracy: int = 10000,
               threshold: float = DELAYED_AVG_MINUTES) -> DataFrame:
    """KPI 1: per region, the median of daily averages above ``threshold``
    on all days and on each kind of extreme day (2 decimals), and the number
    of distinct days tracked. Approximate median, as the warehouse computes
    it; exact while a group holds fewer than ``accuracy`` values."""
    aggs = [F.round(F.percentile_approx(_delayed_value(flag, threshold), F.lit(0.5), F.lit(accuracy)), 2)
            .alias(name) for name, flag in MEDIAN_VARIANTS]
    return (unified.groupBy("region")
                   .agg(*aggs, F.count_distinct("date").alias("days_tracked")))


def kpi_median_exact(unified: DataFrame, threshold: float = DELAYED_AVG_MINUTES,
                     num_partitions: int | None = None) -> DataFrame:
    """KPI 1 with the exact lower median (discrete 0.5 percentile).

    The days count and the medians both need the unified rows: the columns
    they use (station-day sized) are checkpointed once so the input behind
    the unified table is scanned once."""
    ensure_checkpoint_dir(unified.sparkSession)
    unified = unified.select("region", "date", "avg_delay_minutes", "high_temp", "high_wind",
                             "high_precip").checkpoint(eager=True)
    variants = F.array(*[F.struct(F.lit(name).alias("variant"),
                                  _delayed_value(flag, threshold).alias("v"))
                         for name, flag in MEDIAN_VARIANTS])
    long = (unified.select("region", F.inline(variants))
                   .where(F.col("v").isNotNull()))
    med = lower_median(long, ["region", "variant"], "v", "m", num_partitions)
    wide = med.groupBy("region").agg(*[
        F.round(F.max(F.when(F.col("variant") == name, F.col("m"))), 2).alias(name)
        for name, _ in MEDIAN_VARIANTS]).withColumnRenamed("region", "_r")
    days = unified.groupBy("region").agg(F.count_distinct("date").alias("days_tracked"))
    j = days.join(wide, days["region"].eqNullSafe(wide["_r"]), "left")
    return j.select("region", *[name for name, _ in MEDIAN_VARIANTS], "days_tracked")


def order_kpi_median(kpi: DataFrame) -> DataFrame:
    return kpi.orderBy(F.desc_nulls_last("median_delay"), F.asc_nulls_last("region"))


def weather_effect(kpi: DataFrame) -> DataFrame:
    """Per region: median on flagged days minus the overall median (2
    decimals); NULL where no flagged day exceeded the threshold."""
    base = F.col("median_delay")
    return kpi.select(
        "region", "median_delay",
        F.round(F.col("median_high_temp") - base, 2).alias("temp_effect"),
        F.round(F.col("median_high_wind") - base, 2).alias("wind_effect"),
        F.round(F.col("median_high_precip") - base, 2).alias("precip_effect"),
    )


def _top(df: DataFrame, score: Column, top: int | None) -> DataFrame:
    ordered = df.orderBy(score, F.desc("observed_days"), F.asc("station_name"),
                         F.asc_nulls_last("region"))
    return ordered.limit(top) if top else ordered


def kpi_delay_score(unified: DataFrame, min_trains: int = MIN_TRAINS_DOCUMENTED,
                    threshold: float = DELAYED_AVG_MINUTES, top: int | None = 10) -> DataFrame:
    """KPI 2 as documented: among station-days with more than ``min_trains``
    trains, the share whose average delay exceeds ``threshold``; the ``top``
    most delayed stations (ties: more observed days, then name)."""
    g = (unified.where(F.col("train_count") > F.lit(min_trains))
                .groupBy("station_name", "region")
                .agg(F.count(F.lit(1)).alias("observed_days"),
                     F.count_if(_avg() > F.lit(threshold)).alias("delayed_days")))
    s = g.withColumn("percent_delayed_days",
                     F.round(F.lit(100.0) * F.col("delayed_days") / F.col("observed_days"), 2))
    return _top(s, F.desc_nulls_last("percent_delayed_days"), top)


def kpi_delay_score_as_written(unified: DataFrame, threshold: float = DELAYED_AVG_MINUTES,
                               top: int | None = 10) -> DataFrame:
    """KPI 2 exactly as the warehouse SQL computes it: COUNT over a CASE with
    ELSE 0 counts every row, so delayed_days equals observed_days."""
    counted = F.when(_avg() > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))
    g = (unified.groupBy("station_name", "region")
                .agg(F.count(F.lit(1)).alias("observed_days"),
                     F.count(counted).alias("delayed_days")))
    s = g.withColumn("percent_delayed_days",
                     F.round(F.lit(100.0) * F.col("delayed_days") / F.col("observed_days"), 2))
    return _top(s, F.desc_nulls_last("percent_delayed_days"), top)


def calm_mean(unified: DataFrame) -> DataFrame:
    """One row: mean daily average delay over calm days (all flags 0)."""
    return unified.where(calm()).agg(F.avg("avg_delay_minutes").alias("calm_avg_delay"),
                                     F.count(F.lit(1)).alias("calm_days"))


def kpi_resilience(unified: DataFrame, threshold: float | None = None,
                   top: int | None = 10) -> DataFrame:
    """KPI 3: per station, distinct extreme-weather days, distinct resilient
    days (extreme and average delay <= threshold) and their ratio in % (one
    decimal, NULL without extreme days); the ``top`` least resilient
    stations, NULL scores last (ties: more observed days, then name).

    ``threshold=None`` uses the calm-day mean as the SQL does (a scalar
    subquery over the checkpointed per-day aggregate); a number uses that
    fixed value as the documentation describes."""
    ext = any_extreme()
    # Level 1: one row per (station, region, date), combined map-side before
    # its shuffle. A day is resilient when the smallest average among its
    # extreme rows is within the threshold, so this level does not depend on
    # the threshold; it also carries the calm-day partial sums, so the
    # threshold subquery and the per-station aggregate both read this one
    # aggregate.
    per_day = (unified.groupBy("station_name", "region", "date")
                      .agg(F.count(F.lit(1)).alias("_rows"),
                           F.max(F.when(ext, 1)).alias("_ext"),
                           F.min(F.when(ext, _avg())).alias("_ext_min_avg"),
                           F.sum(F.when(calm(), _avg())).alias("_calm_sum"),
                           F.count(F.when(calm(), _avg())).alias("_calm_n")))
    if threshold is None:
        # The threshold needs a full pass before the per-station pass can use
        # it: materialise the (station-day sized) aggregate once in the shared
        # checkpoint folder so the input is not scanned twice.
        ensure_checkpoint_dir(unified.sparkSession)
        per_day = per_day.checkpoint(eager=True)
        limit = per_day.agg((F.sum("_calm_sum") / F.sum("_calm_n")).alias("t")).scalar()
    else:
        limit = F.lit(float(threshold))
    dated = F.col("date").isNotNull()
    g = (per_day.groupBy("station_name", "region")
                .agg(F.sum("_rows").alias("observed_days"),
                     F.count(F.when(dated, F.col("_ext"))).alias("extreme_weather_days"),
                     F.count(F.when(dated & (F.col("_ext_min_avg") <= limit), 1)).alias("resilient_days")))
    s = g.withColumn("resilience_score_pct", F.round(
        F.col("resilient_days").cast("double") / F.nullif(F.col("extreme_weather_days"), F.lit(0))
        * F.lit(100), 1))
    return _top(s, F.asc_nulls_last("resilience_score_pct"), top)


def region_share(top_stations: DataFrame) -> DataFrame:
    """How many of the listed stations each region holds, and their share in
    % (one decimal). The input is a top-k list, so the window is over k rows."""
    c = top_stations.groupBy("region").agg(F.count(F.lit(1)).alias("station_count"))
    return c.withColumn("share_pct", F.round(
        F.lit(100.0) * F.col("station_count") / F.sum("station_count").over(Window.partitionBy()), 1))
