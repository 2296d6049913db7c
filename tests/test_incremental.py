"""Only the days that a load changed are read and written again."""
import datetime as dt
import glob
import os

import pytest

from railpulse.constants import DELAYS_ALL, WEATHER_ALL
from railpulse.operators.quality import DuplicateKeyError, require_unique
from railpulse.operators.unified import unified_all
from railpulse.sources import sinks as SK
from railpulse.streaming import incremental as I
from railpulse.streaming.ledger import Ledger, Version

DAYS = [dt.date(2025, 6, d) for d in range(1, 8)]


@pytest.fixture()
def tables(spark, tmp):
    at = lambda *p: os.path.join(tmp, *p)
    stations = spark.createDataFrame([("A", 47.5, 19.0, "Budapest", "Budapest", 6, 1), ("B", 47.5, 19.0, "Pest", "Pest", 2, 2)],
                                     "station_name STRING, latitude DOUBLE, longitude DOUBLE, county STRING, region STRING, region_id INT, station_id INT")
    delays = spark.createDataFrame([(d, i, n, 7.0 * d.day, 10, 0.7 * d.day) for d in DAYS for i, n in ((1, "A"), (2, "B"), (None, "Bus"))], DELAYS_ALL)
    weather = spark.createDataFrame([(r, d, 20.0, 0.0, 1.0, 0, 0, 0) for d in DAYS for r in (2, 6)],
                                    "region_id INT, date DATE, temperature_mean_c DOUBLE, precipitation_sum_mm DOUBLE, wind_gust_max_kmh DOUBLE, "
                                    "high_temp INT, high_wind INT, high_precip INT")
    SK.append_days(delays, at("delays"), DELAYS_ALL)
    SK.append_days(weather, at("weather"), WEATHER_ALL)
    return at, stations


def spoil(folder, keep):
    """Make every day's files unreadable but those of ``keep``."""
    for f in glob.glob(f"{folder}/date=*/*.parquet"):
        if f.split("date=")[1][:10] not in {str(d) for d in keep}:
            with open(f, "wb") as out:
                out.write(b"not parquet")


def test_only_changed_days_are_read_and_written(spark, tables):
    at, stations = tables
    read = lambda: (SK.read_table(spark, at("delays"), DELAYS_ALL), SK.read_table(spark, at("weather"), WEATHER_ALL))
    delays, weather = read()
    I.update_unified(spark, at("unified"), delays, stations, weather, None)
    assert SK.read_table(spark, at("unified"), I.UNIFIED_ALL).count() == 14
    # Late weather of one region on the third day, and new delays on the fifth.
    late = spark.createDataFrame([(6, DAYS[2], 40.0, 0.0, 1.0, 1, 0, 0)], weather.selectExpr(
        "region_id", "date", "temperature_mean_c", "precipitation_sum_mm", "wind_gust_max_kmh", "high_temp", "high_wind", "high_precip").schema)
    SK.merge_days(late, at("weather"), WEATHER_ALL, ["date", "region_id"])
    SK.append_days(spark.createDataFrame([(DAYS[4], 1, "A", 1.0, 10, 0.1), (DAYS[4], 2, "B", 2.0, 10, 0.2)], DELAYS_ALL), at("delays"), DELAYS_ALL)
    changed = [DAYS[2], DAYS[4]]
    expected = sorted(map(tuple, unified_all(*(read()[0], stations, read()[1])).collect()), key=str)
    untouched = {f: os.stat(f).st_mtime_ns for f in glob.glob(at("unified", "date=*", "*.parquet")) if not any(str(d) in f for d in changed)}
    for folder in ("delays", "weather"):
        spoil(at(folder), changed)
    assert I.update_unified(spark, at("unified"), *(read()[0], stations, read()[1]), changed) == 4
    assert sorted(map(tuple, SK.read_table(spark, at("unified"), I.UNIFIED_ALL).collect()), key=str) == expected
    assert all(os.stat(f).st_mtime_ns == t for f, t in untouched.items()) and len(untouched) >= 5
    plan = I.on_days(read()[0], changed)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2025-06-03" in plan.split("PartitionFilters")[1]


def test_change_sets(spark, tables):
    at, stations = tables
    ledgers = [Ledger(spark, at("delays")), Ledger(spark, at("weather"))]
    version = lambda n: Version(f"/in/{n}", dt.datetime(2025, 7, 1), 5)
    ledgers[0].record([version("d1")], "x", {"d1": DAYS[:3]})
    entries, days, mark = I.changes(spark, at("unified"), ledgers, stations)
    assert days is None and len(entries) == 1  # nothing stored yet: all of it
    I.update_unified(spark, at("unified"), SK.read_table(spark, at("delays"), DELAYS_ALL), stations, SK.read_table(spark, at("weather"), WEATHER_ALL), None)
    I.applied(spark, at("unified"), entries, mark)
    assert I.changes(spark, at("unified"), ledgers, stations) == ([], [], mark)
    ledgers[0].record([version("d2")], "y", {"d2": DAYS[2:5]})
    ledgers[1].record([version("w1"), version("w2")], "y", {"w1": DAYS[:1]})
    entries, days, _ = I.changes(spark, at("unified"), ledgers, stations)
    assert (len(entries), days) == (3, [DAYS[0], *DAYS[2:5]])
    assert I.changes(spark, at("unified"), ledgers, stations)[1] == days  # until they are noted as applied
    I.applied(spark, at("unified"), entries, mark)
    assert I.changes(spark, at("unified"), ledgers, stations)[:2] == ([], [])
    assert I.changes(spark, at("unified"), ledgers, stations.where("station_id = 1"))[1] is None  # other stations: all of it
    assert I.stations_mark(stations) == I.stations_mark(stations.orderBy("station_id", ascending=False))


def test_keys_are_checked_on_changed_days(spark, tables):
    at, _ = tables
    key = ["date", "station_name"]
    check = lambda days: I.require_unique_days(spark, at("delays"), DELAYS_ALL, key, days)
    assert check([DAYS[0]]) == 7  # no marks yet: every day
    assert check([]) == 0
    twice = spark.createDataFrame([(DAYS[3], 1, "A", 1.0, 1, 1.0), (DAYS[3], 2, "A", 2.0, 1, 2.0)], DELAYS_ALL)
    SK.append_days(twice, at("delays"), DELAYS_ALL)
    with pytest.raises(DuplicateKeyError):
        require_unique(SK.read_table(spark, at("delays"), DELAYS_ALL), key, "delays")
    with pytest.raises(DuplicateKeyError, match="2025-06-04"):
        check([DAYS[3]])
    SK.append_days(twice.limit(1), at("delays"), DELAYS_ALL)
    spoil(at("delays"), [DAYS[3]])
    assert check([DAYS[3]]) == 1  # no other day is read
    marks = {r["date"]: r for r in SK.read_table(spark, at("delays_keys"), I.KEY_MARKS).collect()}
    assert len(marks) == 7 and (marks[DAYS[3]]["rows"], marks[DAYS[0]]["rows"]) == (1, 3)
