"""Named queries: one per operator family of the domain, each a function
(spark, sf_dir) -> DataFrame over the shared test tables.

Oracle keys use ``min_trains = 1`` for the documented delay score: the
synthetic station-days hold few trains (the documented 10 is covered by the
unit tests)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from railpulse.constants import COUNTY_BOXES, DELAYS_ALL
from railpulse.functions.names import clean_name, station_of_record
from railpulse.operators import delays as D
from railpulse.operators import grid as G
from railpulse.operators import kpis as K
from railpulse.operators import mergeable as M
from railpulse.operators import quality as Q
from railpulse.operators import stations as S
from railpulse.operators import unified as U
from railpulse.operators import weather as W
from railpulse.plans.domain import Domain, in_load, load_label
from railpulse.session import scratch_path
from railpulse.sources import readers as R
from railpulse.sources import sinks as SK
from railpulse.sources import testmap as TM
from railpulse.streaming import incremental as INC

ORACLE_MIN_TRAINS = 1


def q_raw_scan(spark: SparkSession, sf: str) -> DataFrame:
    return Domain(spark, sf).records()


def q_date_range(spark: SparkSession, sf: str) -> DataFrame:
    """Each preprocessing run's date range over the whole record table: records
    in range, records naming a station, records kept. One pass: the runs are
    conditional counts, then one row per run."""
    st = F.col("_st")
    records = Domain(spark, sf).records().withColumn("_st", station_of_record())
    has_name = st.isNotNull() & (st != "")
    counts = records.agg(*[
        F.struct(F.count_if(inside), F.count_if(inside & has_name),
                 F.count_if(inside & has_name & (F.col("delay") >= 0))).alias(name)
        for name, inside in ((name, in_load(a, b)) for name, a, b in TM.LOADS)])
    rows = [F.struct(F.lit(name).alias("load"), F.lit(a).cast("date").alias("start_date"),
                     F.lit(b).cast("date").alias("end_date"), F.col(f"{name}.col1").alias("records"),
                     F.col(f"{name}.col2").alias("named_records"), F.col(f"{name}.col3").alias("kept_records"))
            for name, a, b in TM.LOADS]
    return counts.select(F.inline(F.array(*rows)))


def q_station_of_record(spark: SparkSession, sf: str) -> DataFrame:
    return Domain(spark, sf).named().select("service_date", "record_type", "station_name", "delay")


def q_clean_names(spark: SparkSession, sf: str) -> DataFrame:
    named = Domain(spark, sf).named()
    return (named.groupBy(F.col("station_name").alias("raw_name"))
                 .agg(F.count(F.lit(1)).alias("records"))
                 .withColumn("station_name", clean_name("raw_name")))


def q_clean_records(spark: SparkSession, sf: str) -> DataFrame:
    return Domain(spark, sf).clean()


def q_non_early(spark: SparkSession, sf: str) -> DataFrame:
    return Domain(spark, sf).kept()


def q_early_filter_stats(spark: SparkSession, sf: str) -> DataFrame:
    clean = Domain(spark, sf).clean().withColumn("load", load_label("date"))
    return D.early_filter_counts(clean, ["load"])


def q_daily_station_delays(spark: SparkSession, sf: str) -> DataFrame:
    return Domain(spark, sf).daily()


def q_attach_station_id(spark: SparkSession, sf: str) -> DataFrame:
    return Domain(spark, sf).delays()


def q_delays_all(spark: SparkSession, sf: str) -> DataFrame:
    """The delays table of all loads: together they cover every record, so one
    pass over the records makes it."""
    return Domain(spark, sf).delays()


def q_delays_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The delays table staged as text (every column STRING, as in its CSV)
    and typed again by name, in the staging column order."""
    delays = Domain(spark, sf).delays()
    return D.enforce_delay_schema(delays.select(*[F.col(c).cast("string").alias(c) for c in delays.columns]))


def q_append_week(spark: SparkSession, sf: str) -> DataFrame:
    """Initial load, both weeks, then the newest week again, each appended
    into a date-partitioned table by per-day overwrite; the table read back
    equals one clean load of everything. The loads are slices of delays that are
    computed once."""
    delays = Domain(spark, sf).delays().where("date is not null").checkpoint(eager=True)
    path = scratch_path(spark, "delays_all")
    for _, a, b in [*TM.LOADS, TM.LOADS[-1]]:
        SK.append_days(delays.where(in_load(a, b, "date")), path, DELAYS_ALL)
    return SK.read_table(spark, path, DELAYS_ALL)


def q_load_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads overlapping in the middle week: the first one brings everything up
    to the middle week, the second one the middle week again, with every delay two
    minutes longer, and all that follows. Per (date, station) the newer load wins."""
    delays = Domain(spark, sf).delays().where("date is not null")
    (_, _, _), (_, a, b), _ = TM.LOADS
    first = delays.where(F.col("date") <= F.lit(b).cast("date")).withColumn("loaded", F.lit(1))
    longer = F.col("total_delay_minutes") + 2
    second = (delays.where(F.col("date") >= F.lit(a).cast("date")).withColumn("loaded", F.lit(2))
              .withColumn("avg_delay_minutes", longer / F.col("train_count")).withColumn("total_delay_minutes", longer))
    return SK.newest_per_key(first.unionByName(second), ["date", "station_name"], ["loaded"]).drop("loaded")


def q_dq_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Typing rejects by reason. The text form of the delays has three faults put
    in by rule: the id of every 7th train count, the date of every 11th and the
    total of every 13th are not readable."""
    delays = Domain(spark, sf).delays()
    text = delays.select(*[F.col(c).cast("string").alias(c) for c in delays.columns])
    n = F.col("train_count").cast("int")
    text = (text.withColumn("station_id", F.when(n % 7 == 0, F.lit("x")).otherwise(F.col("station_id")))
                .withColumn("date", F.when(n % 11 == 0, F.lit("not a date")).otherwise(F.col("date")))
                .withColumn("total_delay_minutes", F.when(n % 13 == 0, F.lit("12,5")).otherwise(F.col("total_delay_minutes"))))
    return Q.dq_rejects(D.with_reject_reason(text))


def q_station_ids(spark: SparkSession, sf: str) -> DataFrame:
    return Domain(spark, sf).lookup()


def q_county_of_station(spark: SparkSession, sf: str) -> DataFrame:
    coords = S.clean_coords(Domain(spark, sf).coords())
    return S.assign_county(coords).select("station_name", "lat", "lon", "county")


def q_station_ids_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of a first run over every station with an even number, kept when the
    second run brings all of them: new names get the ids after the largest."""
    coords = S.clean_coords(Domain(spark, sf).coords())
    even = F.substring("station_name", -1, 1).isin("0", "2", "4", "6", "8")
    stored = S.station_lookup(S.with_station_ids(coords.where(even)))
    return S.station_lookup(S.with_stable_ids(coords, stored))


def q_county_by_join(spark: SparkSession, sf: str) -> DataFrame:
    coords = S.clean_coords(Domain(spark, sf).coords())
    return S.assign_county_by_join(coords).select("station_name", "lat", "lon", "county")


def q_region_of_county(spark: SparkSession, sf: str) -> DataFrame:
    coords = S.clean_coords(Domain(spark, sf).coords())
    return S.assign_region(S.assign_county(coords)).select("station_name", "county", "region",
                                                           "region_id")


def q_stations_regions(spark: SparkSession, sf: str) -> DataFrame:
    return Domain(spark, sf).stations()


def q_station_probe(spark: SparkSession, sf: str) -> DataFrame:
    return S.station_probe(Domain(spark, sf).stations(), 28)


def q_weather_flags(spark: SparkSession, sf: str) -> DataFrame:
    return W.with_flags(Domain(spark, sf).weather_measures())


def q_weather_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Weather measures shaped as the weather service's weekly responses
    (one document per region and week, parallel arrays), then flattened,
    typed and flagged."""
    return W.weather_from_responses(TM.weather_responses(Domain(spark, sf).weather_measures()))


def q_weather_all(spark: SparkSession, sf: str) -> DataFrame:
    """The weather table loaded through its initial text form (';', decimal
    comma, blanks), written to the shared folder and parsed back."""
    dom = Domain(spark, sf)
    path = scratch_path(spark, "weather_initial")
    TM.write_weather_initial_text(dom.weather(), path)
    return R.read_weather_initial_csv(spark, path)


def q_unified_all(spark: SparkSession, sf: str) -> DataFrame:
    return Domain(spark, sf).unified()


def q_unified_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The stored unified table after two refreshes. The first one has the delays up to
    the middle week, and no weather of that week yet; the second one brings that weather
    late, and the newest delays. It rewrites only the days of both; the others stay as
    they are."""
    dom = Domain(spark, sf)
    delays = dom.delays().where("date is not null").checkpoint(eager=True)
    weather, stations = dom.weather().checkpoint(eager=True), dom.stations()
    (_, _, _), (_, a, b), (_, c, d) = TM.LOADS
    path = scratch_path(spark, "unified_all")
    INC.update_unified(spark, path, delays.where(F.col("date") <= F.lit(b).cast("date")), stations, weather.where(~in_load(a, b, "date")), None)
    changed = weather.where(in_load(a, b, "date")).select("date").union(delays.where(in_load(c, d, "date")).select("date")).distinct()
    INC.update_unified(spark, path, delays, stations, weather, sorted(r["date"] for r in changed.collect()))  # days of a calendar
    return SK.read_table(spark, path, INC.UNIFIED_ALL)


def q_county_by_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Counties from the boxes as a table: a grid cover and an equi-join."""
    coords = S.clean_coords(Domain(spark, sf).coords())
    path = scratch_path(spark, "county_boxes")
    spark.createDataFrame([(n, i, *map(float, box)) for i, (n, *box) in enumerate(COUNTY_BOXES)],
                          "name STRING, priority INT, lat_min DOUBLE, lat_max DOUBLE, lon_min DOUBLE, lon_max DOUBLE").write.parquet(path)
    return G.first_box(coords, spark.read.parquet(path)).select("station_name", "lat", "lon", "county")


def q_kpi_median_bracketed(spark: SparkSession, sf: str) -> DataFrame:
    return K.order_kpi_median(M.kpi_median_bracketed(Domain(spark, sf).unified()))


def q_kpi_resilience_bitmaps(spark: SparkSession, sf: str) -> DataFrame:
    """KPI 3 from bitmaps of days that are kept per load and merged."""
    unified = Domain(spark, sf).unified().checkpoint(eager=True)
    sets = M.day_sets(unified.withColumn("load", load_label("date")), M.calm_limit(unified), ["load"])
    return M.resilience_of_day_sets(M.merged_day_sets(sets))


def q_unified_wide(spark: SparkSession, sf: str) -> DataFrame:
    dom = Domain(spark, sf)
    return U.unified_wide(dom.delays(), dom.stations(), dom.weather())


def q_kpi_median(spark: SparkSession, sf: str) -> DataFrame:
    return K.order_kpi_median(K.kpi_median_exact(Domain(spark, sf).unified()))


def q_kpi_median_approx(spark: SparkSession, sf: str) -> DataFrame:
    """The approximate median as the source system takes it; equal to the exact one while a
    region holds fewer than 10,000 values, else within a rank of one ten-thousandth."""
    return K.order_kpi_median(K.kpi_median(Domain(spark, sf).unified()))


def q_kpi_median_exact(spark: SparkSession, sf: str) -> DataFrame:
    return K.order_kpi_median(K.kpi_median_exact(Domain(spark, sf).unified()))


def q_weather_effect(spark: SparkSession, sf: str) -> DataFrame:
    return K.weather_effect(K.kpi_median_exact(Domain(spark, sf).unified()))


def q_kpi_delay_score(spark: SparkSession, sf: str) -> DataFrame:
    return K.kpi_delay_score(Domain(spark, sf).unified(), min_trains=ORACLE_MIN_TRAINS)


def q_kpi_delay_score_as_written(spark: SparkSession, sf: str) -> DataFrame:
    return K.kpi_delay_score_as_written(Domain(spark, sf).unified())


def q_calm_average(spark: SparkSession, sf: str) -> DataFrame:
    c = K.calm_mean(Domain(spark, sf).unified())
    return c.select(F.round("calm_avg_delay", 6).alias("calm_avg_delay"), "calm_days")


def q_kpi_resilience(spark: SparkSession, sf: str) -> DataFrame:
    return K.kpi_resilience(Domain(spark, sf).unified())


def q_kpi_resilience_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return K.kpi_resilience(Domain(spark, sf).unified(), threshold=5.0)


def q_worst_region_share(spark: SparkSession, sf: str) -> DataFrame:
    top = K.kpi_delay_score(Domain(spark, sf).unified(), min_trains=ORACLE_MIN_TRAINS)
    return K.region_share(top)


def q_weather_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """(region, day) cells of the newest week in the delays without weather;
    the week is the seven days ending on the last delay date."""
    dom = Domain(spark, sf)
    week = dom.daily().agg(F.max("date").alias("end_date")) \
        .select(F.date_sub("end_date", 6).alias("start_date"), "end_date")
    return Q.weather_gaps(dom.weather(), week).select("date", "region_id")


def q_unmatched_stations(spark: SparkSession, sf: str) -> DataFrame:
    dom = Domain(spark, sf)
    return Q.unmatched_stations(dom.daily(), dom.lookup())


def q_dq_stations(spark: SparkSession, sf: str) -> DataFrame:
    return Q.dq_stations(Domain(spark, sf).stations())


def q_dq_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    dom = Domain(spark, sf)
    return Q.dq_duplicate_keys(dom.stations(), dom.lookup(), dom.weather(), dom.delays())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_scan": q_raw_scan,
    "date_range": q_date_range,
    "station_of_record": q_station_of_record,
    "clean_names": q_clean_names,
    "clean_records": q_clean_records,
    "non_early": q_non_early,
    "early_filter_stats": q_early_filter_stats,
    "daily_station_delays": q_daily_station_delays,
    "attach_station_id": q_attach_station_id,
    "delays_all": q_delays_all,
    "delays_schema": q_delays_schema,
    "append_week": q_append_week,
    "load_conflicts": q_load_conflicts,
    "dq_rejects": q_dq_rejects,
    "station_ids": q_station_ids,
    "station_ids_incremental": q_station_ids_incremental,
    "county_of_station": q_county_of_station,
    "county_by_join": q_county_by_join,
    "region_of_county": q_region_of_county,
    "stations_regions": q_stations_regions,
    "station_probe": q_station_probe,
    "weather_flags": q_weather_flags,
    "weather_schema": q_weather_schema,
    "weather_all": q_weather_all,
    "unified_all": q_unified_all,
    "unified_wide": q_unified_wide,
    "unified_incremental": q_unified_incremental,
    "county_by_grid": q_county_by_grid,
    "kpi_median_bracketed": q_kpi_median_bracketed,
    "kpi_resilience_bitmaps": q_kpi_resilience_bitmaps,
    "kpi_median": q_kpi_median,
    "kpi_median_exact": q_kpi_median_exact,
    "kpi_median_approx": q_kpi_median_approx,
    "weather_effect": q_weather_effect,
    "kpi_delay_score": q_kpi_delay_score,
    "kpi_delay_score_as_written": q_kpi_delay_score_as_written,
    "calm_average": q_calm_average,
    "kpi_resilience": q_kpi_resilience,
    "kpi_resilience_fixed": q_kpi_resilience_fixed,
    "worst_region_share": q_worst_region_share,
    "weather_gaps": q_weather_gaps,
    "unmatched_stations": q_unmatched_stations,
    "dq_stations": q_dq_stations,
    "dq_duplicate_keys": q_dq_duplicate_keys,
}
