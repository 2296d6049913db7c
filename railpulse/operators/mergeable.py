"""KPI parts that merge: what is kept per day and put together without the rows.

Medians. A quantile sketch per (region, day, variant) is small and merges; merged over
the days it brackets the median within its error. One pass then counts the values below
the bracket and those inside it, and the median is the exact value of its rank there: no
sort, and only the bracket's distinct values, a fraction of a per cent, are walked. A group whose
rank lies outside its bracket (the error bound holds with high probability only) takes part
again with a wider one, the last of which is open.

Days. A set of days is a bitmap per station; bitmaps of weeks merge with OR, so a day that
two loads bring counts once, and the number of days is a bit count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from railpulse.constants import DELAYED_AVG_MINUTES
from railpulse.functions.weather import any_extreme
from railpulse.operators.kpis import MEDIAN_VARIANTS, _delayed_value, _top, calm_mean
from railpulse.session import ensure_checkpoint_dir

SKETCH_K = 4096  # rank error below 0.1 %
BRACKETS = (0.002, 0.05, None)  # ranks on either side of the median; None: all
EPOCH = 719_163  # days before 1970 that have a bit


def delay_values(unified: DataFrame, threshold: float = DELAYED_AVG_MINUTES) -> DataFrame:
    """(region, date, variant, v): the values that each median of KPI 1 is taken of."""
    variants = F.array(*[F.struct(F.lit(name).alias("variant"), _delayed_value(flag, threshold).alias("v")) for name, flag in MEDIAN_VARIANTS])
    return unified.select("region", "date", F.inline(variants)).where(F.col("v").isNotNull())


def day_sketches(values: DataFrame, groups: list[str], k: int = SKETCH_K) -> DataFrame:
    """One quantile sketch per group and day, to be stored with the day."""
    return values.groupBy(*groups, "date").agg(F.kll_sketch_agg_double("v", k).alias("sketch"))


def merged_sketches(sketches: DataFrame, groups: list[str], k: int = SKETCH_K) -> DataFrame:
    return sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def bracketed_median(values: DataFrame, sketches: DataFrame, groups: list[str], brackets: tuple = BRACKETS) -> DataFrame:
    """(groups, median): the exact lower median of ``v`` per group, found inside the
    bracket that the merged sketch of the group gives."""
    spark = values.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [f"_g{i}" for i in range(len(groups))]
    left = sketches.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], "sketch").checkpoint(eager=True)
    found = None
    for width in brackets:
        def bound(rank: float, open_end: float) -> Column:
            return F.lit(open_end) if width is None else F.kll_sketch_get_quantile_double("sketch", F.lit(rank))

        limits = left.select(*keys, bound(0.5 - (width or 0), float("-inf")).alias("_lo"), bound(0.5 + (width or 0), float("inf")).alias("_hi"))
        same = [F.col(g).eqNullSafe(F.col(k)) for g, k in zip(groups, keys)]
        placed = values.join(limits, same).select(*keys, F.when(F.col("v") < F.col("_lo"), float("-inf")).when(
            F.col("v") > F.col("_hi"), float("inf")).otherwise(F.col("v")).alias("v"), F.col("v").between(F.col("_lo"), F.col("_hi")).alias("_in"))
        # What lies outside a bracket is one count on each side of it.
        counted = placed.groupBy(*keys, "v", "_in").agg(F.count(F.lit(1)).alias("_c"))
        group = Window.partitionBy(*keys)
        walked = counted.withColumn("_cum", F.sum("_c").over(group.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))) \
            .withColumn("_k", F.ceil(F.sum("_c").over(group) / F.lit(2.0)))
        hit = walked.where((F.col("_cum") >= F.col("_k")) & (F.col("_cum") - F.col("_c") < F.col("_k")) & F.col("_in"))
        hit = hit.select(*keys, F.col("v").alias("median")).checkpoint(eager=True)
        found = hit if found is None else found.union(hit)
        done = hit.select(*[F.col(k).alias(f"d{k}") for k in keys])
        left = left.join(done, [F.col(k).eqNullSafe(F.col(f"d{k}")) for k in keys], "left_anti").checkpoint(eager=True)
        if left.isEmpty():
            break
    return found.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], "median")


def kpi_median_bracketed(unified: DataFrame, threshold: float = DELAYED_AVG_MINUTES, brackets: tuple = BRACKETS) -> DataFrame:
    """KPI 1 (see ``kpis.kpi_median_exact``) from mergeable sketches by day."""
    ensure_checkpoint_dir(unified.sparkSession)
    unified = unified.select("region", "date", "avg_delay_minutes", "high_temp", "high_wind", "high_precip").checkpoint(eager=True)
    values, groups = delay_values(unified, threshold), ["region", "variant"]
    median = bracketed_median(values, merged_sketches(day_sketches(values, groups), groups), groups, brackets)
    wide = median.groupBy(F.col("region").alias("_r")).agg(*[
        F.round(F.max(F.when(F.col("variant") == name, F.col("median"))), 2).alias(name) for name, _ in MEDIAN_VARIANTS])
    days = unified.groupBy("region").agg(F.count_distinct("date").alias("days_tracked"))
    return days.join(wide, F.col("region").eqNullSafe(F.col("_r")), "left").select("region", *[n for n, _ in MEDIAN_VARIANTS], "days_tracked")


def day_sets(unified: DataFrame, threshold: float | Column, by: list[str] | None = None) -> DataFrame:
    """Per station (and ``by``) and run of days: the rows, and the days with extreme
    weather and the resilient ones among them as bitmaps. Days before the year 1 have
    no bit; a row without a date counts as a row only."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    number = F.unix_date("date") + F.lit(EPOCH)
    bit, extreme = F.bitmap_bit_position(number), any_extreme()
    return unified.groupBy(*(by or []), "station_name", "region", F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.bitmap_construct_agg(F.when(extreme, bit)).alias("extreme"),
        F.bitmap_construct_agg(F.when(extreme & (F.col("avg_delay_minutes") <= limit), bit)).alias("resilient"))


def merged_day_sets(sets: DataFrame) -> DataFrame:
    """Sets of several loads as one: a day counts once whichever of them have it."""
    return sets.groupBy("station_name", "region", "bucket").agg(
        F.sum("rows").alias("rows"), F.bitmap_or_agg("extreme").alias("extreme"), F.bitmap_or_agg("resilient").alias("resilient"))


def resilience_of_day_sets(sets: DataFrame, top: int | None = 10) -> DataFrame:
    """KPI 3 (see ``kpis.kpi_resilience``) counted from merged sets of days."""
    g = sets.groupBy("station_name", "region").agg(
        F.sum("rows").alias("observed_days"), F.sum(F.bitmap_count("extreme")).alias("extreme_weather_days"),
        F.sum(F.bitmap_count("resilient")).alias("resilient_days"))
    s = g.withColumn("resilience_score_pct", F.round(
        F.col("resilient_days").cast("double") / F.nullif(F.col("extreme_weather_days"), F.lit(0)) * F.lit(100), 1))
    return _top(s, F.asc_nulls_last("resilience_score_pct"), top)


def calm_limit(unified: DataFrame) -> Column:
    """The calm-day mean as a scalar subquery."""
    return calm_mean(unified).select("calm_avg_delay").scalar()
