"""The same queries as plain SQL for DuckDB over the shared test tables.

The mapping rules (FIXTURES.md §2) and each operator are restated in SQL; the
fixed values (county boxes, region maps, thresholds) come from
``railpulse.constants`` so that both sides use one set of numbers.
"""

from __future__ import annotations

from railpulse.constants import (
    COUNTY_BOXES, COUNTY_REGION, DELAYED_AVG_MINUTES, PRECIP_HIGH_MM, REGION_COORDINATES, REGION_ID,
    TEMP_HIGH_C, TEMP_LOW_C, WIND_HIGH_KMH,
)
from railpulse.sources.testmap import LOADS, MAP_START, WEATHER_DAYS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


_COUNTY_CASE = "CASE " + " ".join(
    f"WHEN lat BETWEEN {_d(a)} AND {_d(b)} AND lon BETWEEN {_d(c)} AND {_d(d)} THEN {_q(n)}"
    for n, a, b, c, d in COUNTY_BOXES) + " END"
_REGION_CASE = "CASE county " + " ".join(
    f"WHEN {_q(k)} THEN {_q(v)}" for k, v in COUNTY_REGION.items()) + " END"
_REGION_ID_CASE = "CAST(CASE region " + " ".join(
    f"WHEN {_q(k)} THEN {v}" for k, v in REGION_ID.items()) + " END AS INTEGER)"
_REGION_NAME_CASE = "CASE region_id " + " ".join(
    f"WHEN {i} THEN {_q(r[0])}" for i, r in enumerate(REGION_COORDINATES)) + " END"


def _window(column: str, a: str | None, b: str | None) -> str:
    """Condition of a load's window; an open end has no bound."""
    return " AND ".join([f"{column} IS NOT NULL"] + ([f"{column} >= DATE {_q(a)}"] if a else [])
                        + ([f"{column} <= DATE {_q(b)}"] if b else []))


def _date(x: str | None) -> str:
    return f"DATE {_q(x)}" if x else "CAST(NULL AS DATE)"


_LOAD_CASE = "CASE " + " ".join(f"WHEN {_window('date', a, b)} THEN {_q(n)}" for n, a, b in LOADS) + " END"

_SUPPLIER = "'Supplier#' || lpad(CAST({k} AS VARCHAR), 9, '0')"

# -- building blocks ---------------------------------------------------------
RECORDS = f"""records AS (
  SELECT CAST(ts AS DATE) AS service_date,
         CASE event_type WHEN 'error' THEN 'Szakasz' WHEN 'click' THEN 'InduloAllomas'
              WHEN 'view' THEN 'KozbensoAllomas' WHEN 'purchase' THEN 'ZaroSzakasz'
              ELSE 'Egyeb' END AS record_type,
         CASE WHEN event_type = 'click' THEN '"' || {_SUPPLIER.format(k='user_id')} || '"'
              ELSE {_SUPPLIER.format(k='user_id')} || ' ' END AS origin,
         {_SUPPLIER.format(k='user_id + 1')} AS destination,
         CAST(floor((value - 15) / 5) AS DOUBLE) AS delay
  FROM events)"""

NAMED = """named AS (
  SELECT * FROM (
    SELECT *, CASE WHEN record_type IN ('InduloAllomas', 'KozbensoAllomas') THEN origin
                   WHEN record_type = 'ZaroSzakasz' THEN destination END AS station_name
    FROM records) x
  WHERE station_name IS NOT NULL AND station_name <> '')"""

CLEAN_NAME = "regexp_replace(replace({c}, '\"', ''), '^\\s+|\\s+$', '', 'g')"

CLEAN = f"""clean AS (
  SELECT service_date AS date, {CLEAN_NAME.format(c='station_name')} AS station_name, delay
  FROM named)"""

KEPT = "kept AS (SELECT * FROM clean WHERE delay >= 0)"

DAILY = """daily AS (
  SELECT date, station_name, SUM(delay) AS total_delay_minutes,
         CAST(COUNT(*) AS INTEGER) AS train_count, AVG(delay) AS avg_delay_minutes
  FROM kept GROUP BY date, station_name)"""

COORDS = f"""coords AS (
  SELECT {CLEAN_NAME.format(c='s_name')} AS station_name,
         CAST(4580 + (s_suppkey * 37) % 290 AS DOUBLE) / 100 AS lat,
         CAST(1590 + (s_suppkey * 53) % 700 AS DOUBLE) / 100 AS lon
  FROM supplier)"""

WITH_COUNTY = f"""with_county AS (SELECT *, {_COUNTY_CASE} AS county FROM coords)"""
WITH_REGION = f"""with_region AS (
  SELECT *, {_REGION_ID_CASE} AS region_id FROM (SELECT *, {_REGION_CASE} AS region FROM with_county) r)"""

STATIONS = """stations AS (
  SELECT station_name, lat AS latitude, lon AS longitude, county, region, region_id,
         CAST(ROW_NUMBER() OVER (ORDER BY station_name NULLS LAST, lat NULLS LAST, lon NULLS LAST) AS INTEGER) AS station_id
  FROM with_region)"""

LOOKUP = "lookup AS (SELECT station_id, station_name FROM stations)"

DELAYS = """delays AS (
  SELECT d.date, l.station_id, d.station_name, d.total_delay_minutes, d.train_count,
         d.avg_delay_minutes
  FROM daily d LEFT JOIN lookup l ON d.station_name = l.station_name)"""

MEASURES = f"""measures AS (
  SELECT CAST(o_custkey % 8 AS INTEGER) AS region_id,
         DATE {_q(MAP_START)} + CAST(o_orderkey % {WEATHER_DAYS} AS INTEGER) AS date,
         CAST(SUM(o_orderkey) % 450 - 120 AS DOUBLE) / 10 AS temperature_mean_c,
         CAST(SUM(o_orderkey + o_custkey) % 80 AS DOUBLE) / 10 AS precipitation_sum_mm,
         CAST(SUM(o_custkey) % 600 AS DOUBLE) / 10 AS wind_gust_max_kmh
  FROM orders GROUP BY 1, 2)"""

WEATHER = f"""weather AS (
  SELECT region_id, date, temperature_mean_c, precipitation_sum_mm, wind_gust_max_kmh,
         CAST((temperature_mean_c < {_d(TEMP_LOW_C)} OR temperature_mean_c > {_d(TEMP_HIGH_C)}) AS INTEGER) AS high_temp,
         CAST(wind_gust_max_kmh > {_d(WIND_HIGH_KMH)} AS INTEGER) AS high_wind,
         CAST(precipitation_sum_mm > {_d(PRECIP_HIGH_MM)} AS INTEGER) AS high_precip
  FROM measures)"""

UNIFIED = """unified AS (
  SELECT d.date, d.station_name, sr.county, sr.region, d.total_delay_minutes, d.train_count,
         d.avg_delay_minutes, w.high_temp, w.high_wind, w.high_precip
  FROM delays d
  LEFT JOIN stations sr ON d.station_id = sr.station_id
  LEFT JOIN weather w ON d.date = w.date AND sr.region_id = w.region_id
  WHERE d.station_id IS NOT NULL)"""

_CHAIN = {
    "records": [RECORDS],
    "named": [RECORDS, NAMED],
    "clean": [RECORDS, NAMED, CLEAN],
    "kept": [RECORDS, NAMED, CLEAN, KEPT],
    "daily": [RECORDS, NAMED, CLEAN, KEPT, DAILY],
    "coords": [COORDS],
    "with_county": [COORDS, WITH_COUNTY],
    "with_region": [COORDS, WITH_COUNTY, WITH_REGION],
    "stations": [COORDS, WITH_COUNTY, WITH_REGION, STATIONS],
    "lookup": [COORDS, WITH_COUNTY, WITH_REGION, STATIONS, LOOKUP],
    "delays": [RECORDS, NAMED, CLEAN, KEPT, DAILY, COORDS, WITH_COUNTY, WITH_REGION, STATIONS,
               LOOKUP, DELAYS],
    "measures": [MEASURES],
    "weather": [MEASURES, WEATHER],
    "unified": [RECORDS, NAMED, CLEAN, KEPT, DAILY, COORDS, WITH_COUNTY, WITH_REGION, STATIONS,
                LOOKUP, DELAYS, MEASURES, WEATHER, UNIFIED],
}


def with_(*needs: str) -> str:
    """WITH clause holding every building block the named ones depend on."""
    seen: list[str] = []
    for n in needs:
        for block in _CHAIN[n]:
            if block not in seen:
                seen.append(block)
    return "WITH " + ",\n".join(seen) + "\n"


_DELAYED = DELAYED_AVG_MINUTES
_ANY = "(high_temp = 1 OR high_wind = 1 OR high_precip = 1)"
_CALM = "(high_temp = 0 AND high_wind = 0 AND high_precip = 0)"
_CALM_AVG = f"(SELECT AVG(avg_delay_minutes) FROM unified WHERE {_CALM})"


def _median(cond: str | None) -> str:
    c = f"avg_delay_minutes > {_d(_DELAYED)}" if cond is None else \
        f"{cond} = 1 AND avg_delay_minutes > {_d(_DELAYED)}"
    return f"ROUND(quantile_disc(CASE WHEN {c} THEN avg_delay_minutes END, 0.5), 2)"


KPI_MEDIAN = with_("unified") + f"""
SELECT region,
       {_median(None)} AS median_delay,
       {_median('high_temp')} AS median_high_temp,
       {_median('high_wind')} AS median_high_wind,
       {_median('high_precip')} AS median_high_precip,
       COUNT(DISTINCT date) AS days_tracked
FROM unified GROUP BY region ORDER BY median_delay DESC NULLS LAST, region"""


def _resilience(threshold_sql: str) -> str:
    return with_("unified") + f"""
SELECT station_name, region, observed_days, extreme_weather_days, resilient_days,
       ROUND(CAST(resilient_days AS DOUBLE) / NULLIF(extreme_weather_days, 0) * 100, 1)
         AS resilience_score_pct
FROM (
  SELECT station_name, region, COUNT(*) AS observed_days,
         COUNT(DISTINCT CASE WHEN {_ANY} THEN date END) AS extreme_weather_days,
         COUNT(DISTINCT CASE WHEN {_ANY} AND avg_delay_minutes <= {threshold_sql} THEN date END)
           AS resilient_days
  FROM unified GROUP BY station_name, region) s
ORDER BY resilience_score_pct ASC NULLS LAST, observed_days DESC, station_name, region NULLS LAST
LIMIT 10"""


def _delay_score(min_trains: int) -> str:
    return f"""
SELECT station_name, region, observed_days, delayed_days,
       ROUND(CAST(100.0 AS DOUBLE) * delayed_days / observed_days, 2) AS percent_delayed_days
FROM (
  SELECT station_name, region, COUNT(*) AS observed_days,
         COUNT(CASE WHEN avg_delay_minutes > {_d(_DELAYED)} THEN 1 END) AS delayed_days
  FROM unified WHERE train_count > {min_trains} GROUP BY station_name, region) s
ORDER BY percent_delayed_days DESC NULLS LAST, observed_days DESC, station_name, region NULLS LAST
LIMIT 10"""


def _loads_union(body: str) -> str:
    return " UNION ALL ".join(body.format(name=_q(n), a=_date(a), b=_date(b), window=_window("service_date", a, b))
                              for n, a, b in LOADS)


ORACLE: dict[str, str] = {
    "raw_scan": with_("records") + "SELECT * FROM records",
    "date_range": with_("records") + "SELECT * FROM (" + _loads_union("""
SELECT {name} AS load, {a} AS start_date, {b} AS end_date, COUNT(*) AS records,
       COUNT(*) FILTER (WHERE st IS NOT NULL AND st <> '') AS named_records,
       COUNT(*) FILTER (WHERE st IS NOT NULL AND st <> '' AND delay >= 0) AS kept_records
FROM (SELECT *, CASE WHEN record_type IN ('InduloAllomas', 'KozbensoAllomas') THEN origin
                     WHEN record_type = 'ZaroSzakasz' THEN destination END AS st
      FROM records WHERE {window}) r""") + ") u",
    "station_of_record": with_("named") +
        "SELECT service_date, record_type, station_name, delay FROM named",
    "clean_names": with_("named") + f"""
SELECT station_name AS raw_name, COUNT(*) AS records,
       {CLEAN_NAME.format(c='station_name')} AS station_name
FROM named GROUP BY named.station_name""",
    "clean_records": with_("clean") + "SELECT * FROM clean",
    "non_early": with_("kept") + "SELECT * FROM kept",
    "early_filter_stats": with_("clean") + f"""
SELECT load, total_before, total_after, total_before - total_after AS removed,
       ROUND(CAST(100.0 AS DOUBLE) * total_after / total_before, 1) AS pct_kept
FROM (SELECT {_LOAD_CASE} AS load, COUNT(*) AS total_before,
             COUNT(*) FILTER (WHERE delay >= 0) AS total_after
      FROM clean GROUP BY 1) s""",
    "daily_station_delays": with_("daily") + "SELECT * FROM daily",
    "attach_station_id": with_("delays") + "SELECT * FROM delays",
    "delays_all": with_("delays") + "SELECT * FROM delays",
    "delays_schema": with_("delays") + """
SELECT date, station_name, station_id, total_delay_minutes, train_count, avg_delay_minutes FROM delays""",
    "append_week": with_("delays") + "SELECT * FROM delays WHERE date IS NOT NULL",
    "load_conflicts": with_("delays") + f"""
SELECT date, station_id, station_name, total_delay_minutes, train_count, avg_delay_minutes
FROM delays WHERE date < {_date(LOADS[1][1])}
UNION ALL
SELECT date, station_id, station_name, total_delay_minutes + 2, train_count, (total_delay_minutes + 2) / train_count
FROM delays WHERE date >= {_date(LOADS[1][1])}""",
    "dq_rejects": with_("delays") + """
SELECT reason, COUNT(*) AS rows FROM (
  SELECT CASE WHEN train_count % 11 = 0 THEN 'date' WHEN train_count % 7 = 0 THEN 'station_id'
              WHEN train_count % 13 = 0 THEN 'total_delay_minutes' END AS reason FROM delays) r
WHERE reason IS NOT NULL GROUP BY reason""",
    "station_ids": with_("lookup") + "SELECT * FROM lookup",
    "station_ids_incremental": with_("coords") + """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY CASE WHEN right(station_name, 1) IN ('0', '2', '4', '6', '8') THEN 0 ELSE 1 END,
                               station_name NULLS LAST, lat, lon) AS INTEGER) AS station_id, station_name
FROM coords""",
    "county_of_station": with_("with_county") + "SELECT station_name, lat, lon, county FROM with_county",
    "county_by_join": with_("with_county") + "SELECT station_name, lat, lon, county FROM with_county",
    "county_by_grid": with_("with_county") + "SELECT station_name, lat, lon, county FROM with_county",
    "region_of_county": with_("with_region") +
        "SELECT station_name, county, region, region_id FROM with_region",
    "stations_regions": with_("stations") + "SELECT * FROM stations",
    "station_probe": with_("stations") + "SELECT * FROM stations WHERE station_id > 28",
    "weather_flags": with_("weather") + "SELECT * FROM weather",
    "weather_schema": with_("weather") + "SELECT * FROM weather",
    "weather_all": with_("weather") + "SELECT * FROM weather",
    "unified_all": with_("unified") + "SELECT * FROM unified",
    "unified_incremental": with_("unified") + "SELECT * FROM unified WHERE date IS NOT NULL",
    "unified_wide": with_("delays", "stations", "weather") + f"""
SELECT d.date, d.station_name, sr.region, sr.county, d.total_delay_minutes, d.train_count,
       d.avg_delay_minutes, w.temperature_mean_c, w.wind_gust_max_kmh, w.precipitation_sum_mm,
       w.high_temp AS extreme_temperature, w.high_wind AS extreme_wind,
       w.high_precip AS extreme_precipitation
FROM delays d
LEFT JOIN stations sr ON d.station_name = sr.station_name
LEFT JOIN (SELECT *, {_REGION_NAME_CASE} AS region_name FROM weather) w
  ON d.date = w.date AND sr.region = w.region_name""",
    "kpi_median": KPI_MEDIAN,
    "kpi_median_exact": KPI_MEDIAN,
    "kpi_median_approx": KPI_MEDIAN,
    "kpi_median_bracketed": KPI_MEDIAN,
    "weather_effect": with_("unified") + f"""
SELECT region, median_delay,
       ROUND(median_high_temp - median_delay, 2) AS temp_effect,
       ROUND(median_high_wind - median_delay, 2) AS wind_effect,
       ROUND(median_high_precip - median_delay, 2) AS precip_effect
FROM (SELECT region, {_median(None)} AS median_delay, {_median('high_temp')} AS median_high_temp,
             {_median('high_wind')} AS median_high_wind, {_median('high_precip')} AS median_high_precip
      FROM unified GROUP BY region) k""",
    "kpi_delay_score": with_("unified") + _delay_score(1),
    "kpi_delay_score_as_written": with_("unified") + f"""
SELECT station_name, region, COUNT(*) AS observed_days,
       COUNT(CASE WHEN avg_delay_minutes > {_d(_DELAYED)} THEN 1 ELSE 0 END) AS delayed_days,
       ROUND(CAST(100.0 AS DOUBLE) * COUNT(CASE WHEN avg_delay_minutes > {_d(_DELAYED)} THEN 1 ELSE 0 END)
             / COUNT(*), 2) AS percent_delayed_days
FROM unified GROUP BY station_name, region
ORDER BY percent_delayed_days DESC NULLS LAST, observed_days DESC, station_name, region NULLS LAST
LIMIT 10""",
    "calm_average": with_("unified") + f"""
SELECT ROUND(AVG(avg_delay_minutes), 6) AS calm_avg_delay, COUNT(*) AS calm_days
FROM unified WHERE {_CALM}""",
    "kpi_resilience": _resilience(_CALM_AVG),
    "kpi_resilience_bitmaps": _resilience(_CALM_AVG),
    "kpi_resilience_fixed": _resilience(_d(5.0)),
    "worst_region_share": with_("unified") + f"""
SELECT region, COUNT(*) AS station_count,
       ROUND(CAST(100.0 AS DOUBLE) * COUNT(*) / SUM(COUNT(*)) OVER (), 1) AS share_pct
FROM ({_delay_score(1)}) t GROUP BY region""",
    "weather_gaps": with_("daily", "weather") + """
SELECT c.date, c.region_id
FROM (SELECT CAST(g.d AS DATE) AS date, CAST(t.r AS INTEGER) AS region_id
      FROM (SELECT MAX(date) AS end_date FROM daily) w,
           generate_series(CAST(w.end_date - 6 AS TIMESTAMP), CAST(w.end_date AS TIMESTAMP), INTERVAL 1 DAY) g(d),
           range(8) t(r)) c
WHERE NOT EXISTS (SELECT 1 FROM weather x WHERE x.date = c.date AND x.region_id = c.region_id)""",
    "unmatched_stations": with_("delays") + """
SELECT station_name, COUNT(*) AS missing_days, CAST(SUM(train_count) AS BIGINT) AS train_count
FROM delays d WHERE NOT EXISTS (SELECT 1 FROM lookup l WHERE l.station_name = d.station_name)
GROUP BY station_name""",
    "dq_stations": with_("stations") + """
SELECT COUNT(*) AS stations,
       COUNT(*) FILTER (WHERE county IS NULL) AS without_county,
       COUNT(*) FILTER (WHERE region IS NULL) AS without_region,
       COUNT(*) FILTER (WHERE region_id IS NULL) AS without_region_id,
       COUNT(*) FILTER (WHERE station_id IS NULL) AS without_station_id,
       COUNT(*) FILTER (WHERE station_name IS NULL OR station_name = '') AS blank_names,
       COUNT(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) AS without_coordinates
FROM stations""",
    "dq_duplicate_keys": with_("stations", "lookup", "weather", "delays") + " UNION ALL ".join(
        f"""
SELECT {_q(t)} AS table_name, {_q(k)} AS key_columns, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows,
       COUNT(*) AS distinct_keys, COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys,
       CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT COUNT(*) AS n FROM {src} GROUP BY {k}) g"""
        for t, k, src in (("stations_regions", "station_id", "stations"),
                          ("station_lookup", "station_name", "lookup"),
                          ("weather_all", "date,region_id", "weather"),
                          ("delays_all", "date,station_name", "delays"))),
}
