"""Unified table and the documented name-keyed variant on hand-written rows."""
import datetime as dt

from railpulse.constants import DELAYS_ALL, STATIONS_REGIONS, WEATHER_ALL
from railpulse.operators.unified import unified_all, unified_wide

D1, D2 = dt.date(2025, 6, 1), dt.date(2025, 6, 2)


def frames(spark):
    delays = spark.createDataFrame([
        (D1, 30, "Abaliget", 2.0, 10, 0.2), (D2, 30, "Abaliget", 60.0, 10, 6.0),
        (D1, None, "Bus", 7.0, 16, 0.4375), (D1, 31, "Kint", 1.0, 1, 1.0)], DELAYS_ALL)
    stations = spark.createDataFrame([
        ("Abaliget", 46.15, 18.07, "Baranya", "Dél-Dunántúl", 5, 30),
        ("Kint", 44.0, 14.0, None, None, None, 31)], STATIONS_REGIONS)
    weather = spark.createDataFrame([(5, D1, 26.0, 0.0, 10.0, 1, 0, 0)], WEATHER_ALL)
    return delays, stations, weather


def test_unified_by_id(spark):
    rows = {(r.date, r.station_name): r for r in unified_all(*frames(spark)).collect()}
    assert set(rows) == {(D1, "Abaliget"), (D2, "Abaliget"), (D1, "Kint")}  # no-id rows dropped
    assert rows[(D1, "Abaliget")].high_temp == 1 and rows[(D1, "Abaliget")].region == "Dél-Dunántúl"
    assert rows[(D2, "Abaliget")].high_temp is None  # no weather that day
    assert rows[(D1, "Kint")].region is None and rows[(D1, "Kint")].high_wind is None


def test_documented_view_by_name(spark):
    rows = {(r.date, r.station_name): r for r in unified_wide(*frames(spark)).collect()}
    assert len(rows) == 4  # the documented view keeps rows without an id
    a = rows[(D1, "Abaliget")]
    assert (a.temperature_mean_c, a.extreme_temperature, a.extreme_wind) == (26.0, 1, 0)
    assert rows[(D1, "Bus")].region is None and rows[(D1, "Bus")].extreme_temperature is None
