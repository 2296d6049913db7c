"""Repeat-safe per-day append, CSV/JSON round trips, newest-file discovery."""
import datetime as dt
import os
import time

import pytest

from railpulse.constants import DELAYS_ALL
from railpulse.sources import readers as R
from railpulse.sources import sinks as SK

d = dt.date


def week(spark, start, n_days, stations=("A", "B")):
    rows = [(d(2025, 6, start + i), j + 1, s, float(i + j), 10 + j, (i + j) / (10 + j))
            for i in range(n_days) for j, s in enumerate(stations)]
    return spark.createDataFrame(rows, DELAYS_ALL)


def snapshot(spark, path):
    return sorted(tuple(r) for r in SK.read_table(spark, path, DELAYS_ALL).collect())


def test_append_is_repeat_safe_and_by_name(spark, tmp):
    path = os.path.join(tmp, "delays_all")
    SK.append_days(week(spark, 1, 7), path, DELAYS_ALL)
    SK.append_days(week(spark, 8, 7), path, DELAYS_ALL)
    first = snapshot(spark, path)
    assert len(first) == 28
    # same week again, columns in another order: by-name insert, same table
    again = week(spark, 8, 7)
    SK.append_days(again.select(*reversed(again.columns)), path, DELAYS_ALL)
    assert snapshot(spark, path) == first


def test_partial_day_is_refused(spark, tmp):
    path = os.path.join(tmp, "delays_all")
    SK.append_days(week(spark, 1, 2), path, DELAYS_ALL)
    with pytest.raises(SK.PartialDayError):
        SK.append_days(week(spark, 1, 1, stations=("A",)), path, DELAYS_ALL, check_partial=True)


def test_csv_export_round_trip_with_null_id(spark, tmp):
    path = os.path.join(tmp, "delay_data_initial")
    rows = [(d(2025, 6, 1), 30, "Abaliget", 2.0, 10, 0.2), (d(2025, 6, 1), None, "Bus stop", 7.0, 16, 0.4375)]
    SK.export_csv(spark.createDataFrame(rows, DELAYS_ALL), path)
    back = sorted((tuple(r) for r in R.read_delay_csv(spark, path).collect()), key=str)
    assert back == sorted(rows, key=str)


def test_lookup_json_both_forms(spark, tmp):
    lines = os.path.join(tmp, "lookup_lines")
    SK.export_lookup_json(spark.createDataFrame([(1, "A"), (2, "Ábr")], "station_id INT, station_name STRING"), lines)
    assert sorted(tuple(r) for r in R.read_station_lookup(spark, lines, multi_line=False).collect()) == [(1, "A"), (2, "Ábr")]
    arr = os.path.join(tmp, "stations_ids.json")
    with open(arr, "w") as f:
        f.write('[\n  {"station_id": 29, "station_name": "Aba-Sárkeresztúr"},\n  {"station_id": 30, "station_name": "Abaliget"}\n]\n')
    assert sorted(tuple(r) for r in R.read_station_lookup(spark, arr).collect()) == [(29, "Aba-Sárkeresztúr"), (30, "Abaliget")]


def test_stations_csv_na_is_null(spark, tmp):
    p = os.path.join(tmp, "stations_regions.csv")
    with open(p, "w") as f:
        f.write("station_name,lat,lon,county,region,location_id,station_id\n")
        f.write("Aba-Sárkeresztúr,47.023785,18.5425663,Fejér,Közép-Dunántúl,3,29\n")
        f.write("Kint,44.0,14.0,NA,NA,NA,31\n")
    rows = {r.station_name: r for r in R.read_stations_csv(spark, p).collect()}
    assert rows["Aba-Sárkeresztúr"].region_id == 3 and rows["Aba-Sárkeresztúr"].station_id == 29
    assert rows["Kint"].county is None and rows["Kint"].region_id is None


def test_newest_week_file(spark, tmp):
    for i, name in enumerate(["delay_data_2025-11-24_2025-11-30.csv", "delay_data_2025-12-01_2025-12-07.csv"]):
        p = os.path.join(tmp, name)
        with open(p, "w") as f:
            f.write("date\n")
        os.utime(p, (time.time() - 100 + i * 50, time.time() - 100 + i * 50))
    r = R.newest_week_file(spark, tmp).collect()[0]
    assert r.file_name == "delay_data_2025-12-01_2025-12-07.csv"
    assert (r.start_date, r.end_date) == (d(2025, 12, 1), d(2025, 12, 7))


def test_staged_csv_views_database_and_guard(spark, tmp):
    from railpulse.operators.quality import EmptyInputError, require_rows
    df = week(spark, 1, 2)
    SK.write_staged_csv(df, os.path.join(tmp, "staged"))
    back = R.read_delay_csv(spark, os.path.join(tmp, "staged"))
    assert back.count() == 4
    SK.create_view(back, "delays_staged_w1")
    assert spark.sql("SELECT COUNT(*) AS n FROM delays_staged_w1").collect()[0].n == 4
    SK.create_database(spark, "station_reports")
    assert "station_reports" in [d.name for d in spark.catalog.listDatabases()]
    assert require_rows(back, "staged") is back
    with pytest.raises(EmptyInputError):
        require_rows(back.where("1 = 0"), "empty week")


def test_sorted_export_and_raw_csv(spark, tmp):
    out = os.path.join(tmp, "daily")
    SK.export_csv(week(spark, 1, 3), out, sort_cols=["date", "station_name"])
    parts = sorted(f for f in os.listdir(out) if f.endswith(".csv"))  # written in key order
    lines = [line.split(",") for f in parts for line in open(os.path.join(out, f)).read().splitlines()[1:]]
    keys = [(line[0], line[2]) for line in lines]
    assert len(keys) == 6 and keys == sorted(keys)
    p = os.path.join(tmp, "raw.csv")
    with open(p, "w") as f:
        f.write("service_date,record_type,origin,destination,delay\n2025-06-01,InduloAllomas,A,B,3\nbad,ZaroSzakasz,A,B,x\n")
    raw = R.read_raw_records(spark, p, fmt="csv").collect()
    assert raw[0].service_date == d(2025, 6, 1) and raw[0].delay == 3.0
    assert raw[1].service_date is None and raw[1].delay is None
