"""The load path loses and doubles nothing: newest file per key, rejects beside the
table, columns by header name, files that cannot be loaded do not block others."""
import datetime as dt
import json
import os
import time

import pytest

from railpulse import session
from railpulse.__main__ import main
from railpulse.constants import DELAYS_ALL, STATION_COORDS, WEATHER_ALL
from railpulse.operators import quality as Q
from railpulse.operators import stations as S
from railpulse.plans.catalog import q_append_week, q_delays_all
from railpulse.sources import readers as R
from railpulse.sources import sinks as SK
from railpulse.streaming import refresh as RF

HEADER = "date,station_id,station_name,total_delay_minutes,train_count,avg_delay_minutes\n"


@pytest.fixture()
def place(tmp):
    def at(*p):
        return os.path.join(tmp, *p)
    os.makedirs(at("in"))
    return at


def put(path, text, age=0):
    with open(path, "w") as f:
        f.write(text)
    then = time.time() - age
    os.utime(path, (then, then))


def weather(*days, temp=20.0):
    n = len(days)
    return json.dumps({"daily": {"time": list(days), "temperature_2m_mean": [temp] * n, "wind_gusts_10m_max": [1.0] * n,
                                 "precipitation_sum": [0.0] * n}})


def stored(spark, place, schema=DELAYS_ALL):
    return SK.read_table(spark, place("table"), schema)


def test_the_newest_file_of_a_week_wins(spark, place):
    put(place("in", "delay_data_2025-11-24_2025-11-30.csv"), HEADER + "2025-11-24,30,A,2,10,0.2\n2025-11-25,30,A,1,10,0.1\n", 100)
    put(place("in", "delay_data_2025-11-24_2025-11-30_v2.csv"), HEADER + "2025-11-24,30,A,5,10,0.5\n2025-11-24,31,B,4,8,0.5\n")
    r = RF.load_delays(spark, place("in"), place("table"), place("ck"))
    assert (r.input_rows, r.superseded, r.rejected) == (4, 1, 0)
    rows = {(str(x.date), x.station_name): x.total_delay_minutes for x in stored(spark, place).collect()}
    assert rows == {("2025-11-24", "A"): 5.0, ("2025-11-24", "B"): 4.0, ("2025-11-25", "A"): 1.0}


def test_the_newest_file_of_a_region_wins(spark, place):
    put(place("in", "a_region_2.json"), weather("2025-06-01", "2025-06-02"), 100)
    put(place("in", "b_region_2.json"), weather("2025-06-02", temp=30.0))
    r = RF.load_weather(spark, place("in"), place("table"), place("ck"))
    rows = {str(x.date): x.temperature_mean_c for x in stored(spark, place, WEATHER_ALL).collect()}
    assert rows == {"2025-06-01": 20.0, "2025-06-02": 30.0} and r.superseded == 1
    assert len([d for d in os.listdir(place("table")) if d.startswith("date=")]) == 2
    put(place("in", "c_region_3.json"), weather("2025-06-02"))  # another region of a stored day
    RF.load_weather(spark, place("in"), place("table"), place("ck"))
    assert sorted((str(x.date), x.region_id) for x in stored(spark, place, WEATHER_ALL).collect()) == [
        ("2025-06-01", 2), ("2025-06-02", 2), ("2025-06-02", 3)]


def test_unreadable_rows_are_kept_beside_the_table(spark, place):
    week = "delay_data_2025-11-24_2025-11-30.csv"
    put(place("in", week), HEADER + "2025-11-24,30,A,2,10,0.2\nbad,30,A,2,10,0.2\n2025-11-25,x,A,2,10,0.2\n2025-12-25,30,A,2,10,0.2\n2025-11-26,30,,2,10,0.2\n")
    r = RF.load_delays(spark, place("in"), place("table"), place("ck"))
    assert (r.input_rows, r.rejected) == (5, 4)
    put(place("in", "delay_data_2025-12-01_2025-12-07.csv"), HEADER + "2025-12-01,30,A,2,10,0.2\nworse,30,A,2,10,0.2\n")
    RF.load_delays(spark, place("in"), place("table"), place("ck"))
    rejects = spark.read.json(place("table_rejects/*")).collect()
    assert sorted(x.reason for x in rejects) == ["date", "date", "outside the file's week", "station_id", "station_name"]
    assert {x.date for x in rejects} >= {"bad", "worse"}
    assert stored(spark, place).count() == 2


def test_a_day_must_bring_every_stored_key(spark, place):
    rows = lambda names: spark.createDataFrame([(dt.date(2025, 6, 1), 1, n, 1.0, 2, 0.5) for n in names], DELAYS_ALL)
    SK.append_days(rows("AB"), place("table"), DELAYS_ALL)
    with pytest.raises(SK.PartialDayError):
        SK.append_days(rows("BC"), place("table"), DELAYS_ALL, check_partial=True)
    SK.append_days(rows("ABC"), place("table"), DELAYS_ALL, check_partial=True)
    assert stored(spark, place).count() == 3
    with pytest.raises(Exception, match="row without date"):
        SK.append_days(spark.createDataFrame([(None, 1, "A", 1.0, 2, 0.5)], DELAYS_ALL), place("table"), DELAYS_ALL)


def test_files_that_cannot_be_loaded_do_not_block_others(spark, place):
    put(place("in", "delay_data_2025-11-24_2025-11-30.csv"), HEADER)
    put(place("in", "delay_data_newest_week.csv"), HEADER + "2025-11-24,30,A,2,10,0.2\n")
    put(place("in", "delay_data_2025-12-01_2025-12-07.csv"), HEADER + "2025-12-01,30,A,2,10,0.2\n")
    with pytest.raises(RF.LoadError) as e:
        RF.load_delays(spark, place("in"), place("table"), place("ck"))
    assert "holds no rows" in str(e.value) and "names no week" in str(e.value)
    assert stored(spark, place).count() == 1
    put(place("in", "delay_data_2025-12-08_2025-12-14.csv"), HEADER + "2025-12-08,30,A,2,10,0.2\n")
    assert RF.load_delays(spark, place("in"), place("table"), place("ck")).input_rows == 1
    assert stored(spark, place).count() == 2


def test_malformed_weather_is_reported(spark, place):
    put(place("in", "region_6.json"), weather("2025-06-01"))
    put(place("in", "region_7.json"), weather("2025-06-01")[:-20])
    put(place("in", "no_number.json"), weather("2025-06-01"))
    put(place("in", "region_99.json"), weather("2025-06-01"))
    with pytest.raises(RF.LoadError) as e:
        RF.load_weather(spark, place("in"), place("table"), place("ck"))
    assert "region_7.json: malformed" in str(e.value) and "no_number.json: region" in str(e.value) and "region_99.json" in str(e.value)
    assert [r.region_id for r in stored(spark, place, WEATHER_ALL).collect()] == [6]
    with pytest.raises(Exception):
        R.read_weather_responses(spark, place("in", "region_7.json")).collect()


def test_counts_of_a_long_backlog(spark, place):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    for i in range(5):
        day = dt.date(2025, 11, 3) + dt.timedelta(days=7 * i)
        put(place("in", f"delay_data_{day}_{day + dt.timedelta(days=6)}.csv"), HEADER + f"{day},30,A,2,10,0.2\n")
    try:
        r = RF.load_delays(spark, place("in"), place("table"), place("ck"), max_files=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (r.batches, r.input_rows) == (5, 5)


def test_text_columns_are_bound_by_name(spark, place):
    put(place("raw.csv"), "service_date,record_type,destination,origin,delay\n2025-06-01,InduloAllomas,To,From,3\n")
    r = R.read_raw_records(spark, place("raw.csv"), "csv").first()
    assert (r.origin, r.destination, r.delay) == ("From", "To", 3.0)
    put(place("coords.csv"), "station_name,lon,lat\nAba,19.0,47.5\n")
    c = R.read_coords(spark, place("coords.csv"), "csv").first()
    assert (c.lat, c.lon) == (47.5, 19.0) and set(c.asDict()) == set(STATION_COORDS.fieldNames())
    put(place("in", "delay_data_2025-11-24_2025-11-30.csv"), HEADER + "2025-11-24,30,A,2,10,0.2\n")
    put(place("in", "delay_data_2025-12-01_2025-12-07.csv"),
        "avg_delay_minutes,extra,train_count,station_name,station_id,total_delay_minutes,date\n0.5,?,8,B,31,4,2025-12-01\n")
    want = [(dt.date(2025, 11, 24), 30, "A", 2.0, 10, 0.2), (dt.date(2025, 12, 1), 31, "B", 4.0, 8, 0.5)]
    assert sorted(map(tuple, R.read_delay_csv(spark, place("in")).collect())) == want
    RF.load_delays(spark, place("in"), place("table"), place("ck"))
    assert sorted(map(tuple, stored(spark, place).collect())) == want
    put(place("short.csv"), "date,station_name\n2025-12-01,B\n")
    with pytest.raises(R.MissingColumnError, match="station_id"):
        R.read_delay_csv(spark, place("short.csv"))


def test_lookup_form_is_not_guessed(spark, place):
    lookup = spark.createDataFrame([(i, f"S{i}") for i in range(50)], "station_id INT, station_name STRING").repartition(3)
    SK.export_lookup_json(lookup, place("x.json"))
    assert R.read_station_lookup(spark, place("x.json"), multi_line=False).count() == 50
    with pytest.raises(ValueError):
        R.read_station_lookup(spark, place("x.json"))


def test_newest_file_needs_a_week_in_its_name(spark, place):
    put(place("in", "delay_data_2025-11-24_2025-11-30.csv"), HEADER, 100)
    put(place("in", "delay_data_initial.csv"), HEADER)  # not a weekly file
    assert R.newest_week_file(spark, place("in")).first().file_name == "delay_data_2025-11-24_2025-11-30.csv"
    put(place("in", "delay_data_last_week.csv"), HEADER)
    with pytest.raises(R.FileNameError):
        R.newest_week_file(spark, place("in"))


def test_station_ids_stay(spark, place):
    names = lambda *x: spark.createDataFrame([(n, 47.5, 19.0) for n in x], STATION_COORDS)
    ids = {r.station_name: r.station_id for r in S.with_station_ids(names("B", None, "A")).collect()}
    assert ids == {"A": 1, "B": 2, None: 3}
    for coords, want in ((names("B", "D"), {"B": 1, "D": 2}), (names("A", "B", "C", "D"), {"B": 1, "D": 2, "A": 3, "C": 4})):
        coords.write.mode("overwrite").parquet(place("coords"))
        main(["stations", "--coords", place("coords"), "--stations-out", place("stations"), "--lookup-out", place("lookup")])
        assert {r.station_name: r.station_id for r in spark.read.parquet(place("stations")).collect()} == want


def test_a_late_record_reaches_the_table(spark, place):
    sf = "/root/testdata/sf0.001"
    for t in ("supplier", "orders"):
        os.symlink(f"{sf}/{t}.parquet", place(f"{t}.parquet"))
    events = spark.read.parquet(f"{sf}/events.parquet")
    late = events.where("event_type = 'view'").limit(1).selectExpr(
        *["timestamp_ntz'2024-03-05 10:00:00' AS ts" if c == "ts" else "100D AS value" if c == "value" else c for c in events.columns])
    events.unionByName(late).write.parquet(place("events.parquet"))
    for q in (q_delays_all, q_append_week):
        assert q(spark, place()).where("date = '2024-03-05'").count() == 1


def test_refresh_checks_keys_and_stores_the_join_once(spark, place):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    day = dt.date(2025, 6, 1)
    unified = spark.createDataFrame(
        [(day, f"S{i}", "C", "R", 60.0, 11, 6.0, i % 2, 0, 0) for i in range(20)],
        "date DATE, station_name STRING, county STRING, region STRING, total_delay_minutes DOUBLE, train_count INT, "
        "avg_delay_minutes DOUBLE, high_temp INT, high_wind INT, high_precip INT")
    rows = RF.write_kpis(spark, unified.mapInArrow(count, unified.schema), place("out"))
    assert seen.value == 20
    assert rows["kpi_median"] == rows["weather_effect"] == rows["worst_region_share"] == 1 and rows["kpi_resilience"] == 10
    twice = spark.createDataFrame([(1, "A"), (1, "B")], "station_id INT, station_name STRING")
    with pytest.raises(Q.DuplicateKeyError):
        Q.require_unique(twice, ["station_id"], "stations_regions")
    assert Q.require_unique(twice, ["station_name"], "stations_regions") is twice


def test_initial_history_from_the_command_line(spark, place):
    put(place("d.csv"), HEADER + "2025-06-01,30,Abaliget,2,10,0.2\n")
    put(place("w.csv"), "location_id;latitude;longitude;time;temperature_2m_mean;precipitation_sum;wind_gusts_10m_max;high_temp;high_wind;high_precip\n"
        "0;48,1195;20,85;2025-06-01;21,8;1,3; 38,2;0;0;0\n")
    put(place("r.json"), json.dumps({"regions": [{"region_name": "X", "lat": 47.0, "lon": 19.0}]}))
    out = main(["initial", "--delays-csv", place("d.csv"), "--delays", place("table"), "--weather-csv", place("w.csv"),
                "--weather", place("weather"), "--region-config", place("r.json"), "--regions", place("regions")])
    assert out == {"delays": 1, "weather": 1, "regions": 1}
    assert spark.read.parquet(place("weather")).first().wind_gust_max_kmh == 38.2


def test_no_private_checkpoint_folder_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
    monkeypatch.setattr(session, "_is_local", lambda s: False)
    with pytest.raises(session.MissingCheckpointDirError):
        session.ensure_checkpoint_dir(spark)


def test_scratch_folders_can_be_dropped(spark):
    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    session.drop_scratch(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path)
