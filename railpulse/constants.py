"""Explicit schemas, thresholds and the fixed lookup values of the domain.

Nothing here is inferred at read time: every table has a declared
``StructType`` and every CSV is bound by header name.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source system's values for the results
# to agree; they are stated plainly, in their natural order.
# ---------------------------------------------------------------------------

# Record types of the raw train records and which name column each one uses.
RECORD_TYPE_SECTION = "Szakasz"  # a section between stations: no station name
RECORD_TYPES_ORIGIN = ("InduloAllomas", "KozbensoAllomas")  # departure / intermediate stop
RECORD_TYPE_TERMINAL = "ZaroSzakasz"  # last section: the arrival station

# County bounding boxes, in matching order: the first box containing the point
# wins, bounds are inclusive. (county, lat_min, lat_max, lon_min, lon_max)
COUNTY_BOXES = (
    ("Budapest", 47.37, 47.63, 18.92, 19.28),
    ("Borsod-Abaúj-Zemplén", 47.8, 48.7, 20.2, 21.5),
    ("Heves", 47.3, 48.2, 19.7, 20.8),
    ("Nógrád", 47.7, 48.7, 18.8, 20.2),
    ("Hajdú-Bihar", 46.9, 47.8, 20.6, 22.2),
    ("Jász-Nagykun-Szolnok", 46.7, 47.5, 19.8, 21.0),
    ("Szabolcs-Szatmár-Bereg", 47.5, 48.6, 21.1, 22.9),
    ("Bács-Kiskun", 45.8, 47.0, 18.6, 20.3),
    ("Békés", 46.1, 47.2, 20.5, 21.9),
    ("Csongrád-Csanád", 46.1, 47.0, 19.8, 20.9),
    ("Fejér", 46.8, 47.4, 18.0, 19.3),
    ("Komárom-Esztergom", 47.3, 47.9, 17.5, 18.9),
    ("Veszprém", 46.6, 47.8, 17.0, 18.6),
    ("Győr-Moson-Sopron", 47.2, 48.1, 16.3, 18.0),
    ("Vas", 46.7, 47.8, 15.9, 17.3),
    ("Zala", 45.8, 47.2, 15.9, 17.4),
    ("Baranya", 45.8, 46.6, 17.2, 18.9),
    ("Somogy", 45.8, 47.0, 17.0, 18.5),
    ("Tolna", 46.2, 46.9, 18.2, 19.4),
    ("Pest", 47.0, 48.0, 18.6, 20.2),
)

# County -> region.
COUNTY_REGION = {
    "Borsod-Abaúj-Zemplén": "Észak-Magyarország",
    "Heves": "Észak-Magyarország",
    "Nógrád": "Észak-Magyarország",
    "Hajdú-Bihar": "Észak-Alföld",
    "Jász-Nagykun-Szolnok": "Észak-Alföld",
    "Szabolcs-Szatmár-Bereg": "Észak-Alföld",
    "Bács-Kiskun": "Dél-Alföld",
    "Békés": "Dél-Alföld",
    "Csongrád-Csanád": "Dél-Alföld",
    "Fejér": "Közép-Dunántúl",
    "Komárom-Esztergom": "Közép-Dunántúl",
    "Veszprém": "Közép-Dunántúl",
    "Győr-Moson-Sopron": "Nyugat-Dunántúl",
    "Vas": "Nyugat-Dunántúl",
    "Zala": "Nyugat-Dunántúl",
    "Baranya": "Dél-Dunántúl",
    "Somogy": "Dél-Dunántúl",
    "Tolna": "Dél-Dunántúl",
    "Pest": "Pest",
    "Budapest": "Budapest",
}

# Region -> region id. The id is also the region's position in the weather
# region configuration, which lists (region_name, lat, lon) in this order.
REGION_ID = {
    "Észak-Magyarország": 0,
    "Észak-Alföld": 1,
    "Dél-Alföld": 2,
    "Közép-Dunántúl": 3,
    "Nyugat-Dunántúl": 4,
    "Dél-Dunántúl": 5,
    "Budapest": 6,
    "Pest": 7,
}
REGION_COORDINATES = (
    ("Észak-Magyarország", 48.1, 20.8),
    ("Észak-Alföld", 47.5, 21.5),
    ("Dél-Alföld", 46.5, 20.5),
    ("Közép-Dunántúl", 47.2, 18.5),
    ("Nyugat-Dunántúl", 47.4, 17.0),
    ("Dél-Dunántúl", 46.4, 18.2),
    ("Budapest", 47.5, 19.0),
    ("Pest", 47.4, 19.5),
)

# Extreme-weather thresholds, all strict: temperature outside (-5, 25) °C,
# wind gust above 45 km/h, precipitation above 5 mm.
TEMP_LOW_C = -5.0
TEMP_HIGH_C = 25.0
WIND_HIGH_KMH = 45.0
PRECIP_HIGH_MM = 5.0

# A station-day counts as delayed when its average delay exceeds 5 minutes;
# the documented delay score only counts station-days with more than 10 trains.
DELAYED_AVG_MINUTES = 5.0
MIN_TRAINS_DOCUMENTED = 10

# Weekly delay files are named delay_data_<start>_<end>.csv.
WEEK_FILE_PATTERN = r"delay_data_(\d{4}-\d{2}-\d{2})_(\d{4}-\d{2}-\d{2})"
WEEK_FILE_GLOB = "delay_data_*_*.csv"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

RAW_RECORDS = T.StructType([
    T.StructField("service_date", T.DateType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("delay", T.DoubleType()),
])

STATION_COORDS = T.StructType([
    T.StructField("station_name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

STATION_LOOKUP = T.StructType([
    T.StructField("station_id", T.IntegerType()),
    T.StructField("station_name", T.StringType()),
])

STATIONS_REGIONS = T.StructType([
    T.StructField("station_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("county", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("region_id", T.IntegerType()),
    T.StructField("station_id", T.IntegerType()),
])

DELAYS_ALL = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("station_id", T.IntegerType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("total_delay_minutes", T.DoubleType()),
    T.StructField("train_count", T.IntegerType()),
    T.StructField("avg_delay_minutes", T.DoubleType()),
])

WEATHER_ALL = T.StructType([
    T.StructField("region_id", T.IntegerType()),
    T.StructField("date", T.DateType()),
    T.StructField("temperature_mean_c", T.DoubleType()),
    T.StructField("precipitation_sum_mm", T.DoubleType()),
    T.StructField("wind_gust_max_kmh", T.DoubleType()),
    T.StructField("high_temp", T.IntegerType()),
    T.StructField("high_wind", T.IntegerType()),
    T.StructField("high_precip", T.IntegerType()),
])

# The weather service answers one document per region with parallel arrays.
WEATHER_RESPONSE = T.StructType([
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m_mean", T.ArrayType(T.DoubleType())),
        T.StructField("wind_gusts_10m_max", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
    ])),
])

REGION_CONFIG = T.StructType([
    T.StructField("regions", T.ArrayType(T.StructType([
        T.StructField("region_name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]))),
])

UNIFIED_COLUMNS = (
    "date", "station_name", "county", "region", "total_delay_minutes",
    "train_count", "avg_delay_minutes", "high_temp", "high_wind", "high_precip",
)


def all_strings(schema: T.StructType) -> T.StructType:
    """The same column names, every type STRING: how text inputs are read
    before the typed projection validates them."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
