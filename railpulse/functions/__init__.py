"""Column expressions: every one is a built-in Spark expression, so it stays
JVM-side and inside whole-stage codegen (no Python UDF anywhere)."""

from railpulse.functions.names import clean_name, station_of_record
from railpulse.functions.geo import county_of, region_of, region_id_of, region_name_of
from railpulse.functions.weather import (
    any_extreme, calm, high_precip, high_temp, high_wind, parse_decimal_comma,
)

__all__ = [
    "clean_name", "station_of_record", "county_of", "region_of", "region_id_of",
    "region_name_of", "any_extreme", "calm", "high_precip", "high_temp", "high_wind",
    "parse_decimal_comma",
]
