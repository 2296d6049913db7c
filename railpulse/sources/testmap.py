"""Domain inputs derived from the shared synthetic tables.

The mapping is a fixed rule set (see FIXTURES.md §2): events become raw
train records, suppliers become stations with coordinates, orders become one
weather row per (region, day). Integer arithmetic comes first and one DOUBLE
division last, so any SQL engine computes the same bits. The oracle SQL in
``railpulse.plans.oracle`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from railpulse.functions.weather import high_precip, high_temp, high_wind

MAP_START = "2024-01-01"  # first day of the synthetic period
WEATHER_DAYS = 29  # days with weather; the records' 30th day has none
# The three loads of the synthetic period, as the source system ran its
# preprocessing three times: an initial load and two weekly loads. The first
# and the last are open, so that no dated record is outside all of them.
LOADS = (
    ("initial", None, "2024-01-16"),
    ("week_1", "2024-01-17", "2024-01-23"),
    ("week_2", "2024-01-24", None),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _supplier_name(key) -> F.Column:
    return F.concat(F.lit("Supplier#"), F.lpad(key.cast("string"), 9, "0"))


def train_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw record per event, in the raw-record schema."""
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    name = _supplier_name(F.col("user_id"))
    return ev.select(
        F.to_date("ts").alias("service_date"),
        F.when(et == "error", "Szakasz").when(et == "click", "InduloAllomas")
         .when(et == "view", "KozbensoAllomas").when(et == "purchase", "ZaroSzakasz")
         .otherwise("Egyeb").alias("record_type"),
        F.when(et == "click", F.concat(F.lit('"'), name, F.lit('"')))
         .otherwise(F.concat(name, F.lit(" "))).alias("origin"),
        _supplier_name(F.col("user_id") + 1).alias("destination"),
        F.floor((F.col("value") - 15) / 5).cast("double").alias("delay"),
    )


def station_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station per supplier, placed inside the country's bounding area."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.col("s_name").alias("station_name"),
        ((F.lit(4580) + (k * 37) % 290) / 100).alias("lat"),
        ((F.lit(1590) + (k * 53) % 700) / 100).alias("lon"),
    )


def weather_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather row per (region, day) from all orders. They spread over one
    day less than the records, so that some station-days have no weather."""
    g = table(spark, sf_dir, "orders").groupBy(
        (F.col("o_custkey") % 8).cast("int").alias("region_id"),
        F.date_add(F.lit(MAP_START).cast("date"), (F.col("o_orderkey") % WEATHER_DAYS).cast("int"))
         .alias("date"),
    ).agg(
        F.sum("o_orderkey").alias("_sk"),
        F.sum(F.col("o_orderkey") + F.col("o_custkey")).alias("_skc"),
        F.sum("o_custkey").alias("_sc"),
    )
    return g.select(
        "region_id", "date",
        ((F.col("_sk") % 450 - 120) / 10).alias("temperature_mean_c"),
        ((F.col("_skc") % 80) / 10).alias("precipitation_sum_mm"),
        ((F.col("_sc") % 600) / 10).alias("wind_gust_max_kmh"),
    )


def weather_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather rows with the three extreme flags, in the table's column order."""
    w = weather_measures(spark, sf_dir)
    return w.select(
        "region_id", "date", "temperature_mean_c", "precipitation_sum_mm", "wind_gust_max_kmh",
        high_temp().alias("high_temp"), high_wind().alias("high_wind"),
        high_precip().alias("high_precip"),
    )


def weather_responses(measures: DataFrame) -> DataFrame:
    """Measures shaped as the weather service answers: one document per
    region and week (7 days at most, so every group is bounded), with
    parallel daily arrays in date order. Dates travel as text."""
    week = F.floor(F.datediff(F.col("date"), F.lit(MAP_START).cast("date")) / 7).cast("int")
    days = (measures.groupBy("region_id", week.alias("_week"))
                    .agg(F.array_sort(F.collect_list(F.struct(
                        F.col("date").cast("string").alias("d"),
                        F.col("temperature_mean_c").alias("t"),
                        F.col("wind_gust_max_kmh").alias("w"),
                        F.col("precipitation_sum_mm").alias("p")))).alias("_days")))
    return days.select(
        "region_id",
        F.struct(
            F.transform("_days", lambda x: x["d"]).alias("time"),
            F.transform("_days", lambda x: x["t"]).alias("temperature_2m_mean"),
            F.transform("_days", lambda x: x["w"]).alias("wind_gusts_10m_max"),
            F.transform("_days", lambda x: x["p"]).alias("precipitation_sum"),
        ).alias("daily"))


def _decimal_comma(c) -> F.Column:
    return F.regexp_replace(c.cast("string"), r"\.", ",")


def write_weather_initial_text(weather: DataFrame, path: str) -> None:
    """Write weather rows in the initial text form: ';' separated, decimal
    commas, a stray blank before the wind value, coordinates of the region."""
    from railpulse.constants import REGION_COORDINATES
    lat = F.element_at(F.array(*[F.lit(r[1]) for r in REGION_COORDINATES]), F.col("region_id") + 1)
    lon = F.element_at(F.array(*[F.lit(r[2]) for r in REGION_COORDINATES]), F.col("region_id") + 1)
    text = weather.select(
        F.col("region_id").cast("string").alias("location_id"),
        _decimal_comma(lat).alias("latitude"),
        _decimal_comma(lon).alias("longitude"),
        F.col("date").cast("string").alias("time"),
        _decimal_comma(F.col("temperature_mean_c")).alias("temperature_2m_mean"),
        _decimal_comma(F.col("precipitation_sum_mm")).alias("precipitation_sum"),
        F.concat(F.lit(" "), _decimal_comma(F.col("wind_gust_max_kmh"))).alias("wind_gusts_10m_max"),
        F.col("high_temp").cast("string").alias("high_temp"),
        F.col("high_wind").cast("string").alias("high_wind"),
        F.col("high_precip").cast("string").alias("high_precip"),
    )
    (text.write.mode("overwrite").option("header", True).option("sep", ";")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))
