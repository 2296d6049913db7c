"""File versions, issues that stay open, and rejected rows that are tried again."""
import datetime as dt
import json
import os
import time

import pytest

from railpulse.constants import DELAYS_ALL, WEATHER_ALL
from railpulse.operators.weather import flatten_responses
from railpulse.sources import readers as R
from railpulse.sources import sinks as SK
from railpulse.streaming import refresh as RF
from railpulse.streaming.ledger import Issue, Ledger

HEADER = "date,station_id,station_name,total_delay_minutes,train_count,avg_delay_minutes\n"
WEEK = "delay_data_2025-11-24_2025-11-30.csv"


@pytest.fixture()
def place(tmp):
    def at(*p):
        return os.path.join(tmp, *p)
    for folder in ("in", "weather_in"):
        os.makedirs(at(folder))
    return at


def put(path, text, age=0.0):
    with open(path, "w") as f:
        f.write(text)
    then = time.time() - age
    os.utime(path, (then, then))


def day(date, name, total=2):
    return f"{date},30,{name},{total},10,{total / 10}\n"


def response(*days, temp=20.0, **other):
    n = len(days)
    return json.dumps({"daily": {"time": list(days), "temperature_2m_mean": [temp] * n, "wind_gusts_10m_max": [1.0] * n,
                                 "precipitation_sum": [0.0] * n} | other})


def load(spark, place):
    return RF.load_delays(spark, place("in"), place("table"), place("ck"))


def totals(spark, place):
    return {(str(r.date), r.station_name): r.total_delay_minutes for r in SK.read_table(spark, place("table"), DELAYS_ALL).collect()}


def test_a_corrected_file_under_its_old_name_is_read(spark, place):
    put(place("in", WEEK), HEADER + day("2025-11-24", "A"), 100)
    assert load(spark, place).batches == 1
    assert load(spark, place).batches == 0
    put(place("in", WEEK), HEADER + day("2025-11-24", "A", 5), 50)
    again = load(spark, place)
    assert (again.batches, again.input_rows) == (1, 1)
    assert totals(spark, place) == {("2025-11-24", "A"): 5.0}
    assert load(spark, place).batches == 0
    assert Ledger(spark, place("table")).files().count() == 2


def test_a_corrected_weather_file_is_read(spark, place):
    for temp, age in ((20.0, 100), (45.0, 50)):
        put(place("in", "region_6.json"), response("2025-06-01", temp=temp), age)
        RF.load_weather(spark, place("in"), place("table"), place("ck"))
    row = SK.read_table(spark, place("table"), WEATHER_ALL).first()
    assert (row.temperature_mean_c, row.high_temp) == (45.0, 1)
    assert RF.load_weather(spark, place("in"), place("table"), place("ck")).batches == 0


def test_an_older_file_does_not_replace_a_newer_one(spark, place):
    put(place("in", WEEK), HEADER + day("2025-11-24", "A", 9), 10)
    load(spark, place)
    put(place("in", "delay_data_2025-11-18_2025-11-24.csv"), HEADER + day("2025-11-24", "A", 1) + day("2025-11-20", "A", 3), 500)
    assert load(spark, place).superseded == 1
    assert totals(spark, place) == {("2025-11-24", "A"): 9.0, ("2025-11-20", "A"): 3.0}


def refreshed(spark, place, regions=None):
    return RF.refresh(spark, RF.RefreshPaths(place("in"), place("weather_in"), place("table"), place("weather"), place("stations"),
                                             place("ck"), place("out"), regions))


def stations(spark, place, *names):
    rows = [(n, 47.5, 19.0, "Budapest", "Budapest", 6, 30 + i) for i, n in enumerate(names)]
    spark.createDataFrame(rows, "station_name STRING, latitude DOUBLE, longitude DOUBLE, county STRING, region STRING, region_id INT, station_id INT") \
        .write.mode("overwrite").parquet(place("stations"))


def test_an_issue_stays_open_until_a_sound_file_settles_it(spark, place):
    stations(spark, place, "A")
    put(place("in", WEEK), HEADER, 100)
    put(place("in", "delay_data_2025-11-17_2025-11-23.csv"), HEADER + day("2025-11-17", "A"), 100)
    put(place("weather_in", "region_6.json"), response("2025-11-17"))
    with pytest.raises(RF.LoadError, match="holds no rows"):
        refreshed(spark, place)
    with pytest.raises(RF.LoadError, match="open issues: week 2025-11-24 to 2025-11-30"):
        refreshed(spark, place)
    assert not os.path.exists(place("out"))
    put(place("in", WEEK), HEADER + day("2025-11-24", "A"), 50)
    summary = {(r.step, r.metric): r.value for r in refreshed(spark, place).collect()}
    assert summary[("kpi_median", "kpi_rows")] == 1
    assert Ledger(spark, place("table")).open_issues().count() == 0


def test_an_issue_can_be_dismissed(spark, place):
    put(place("in", "delay_data_last_week.csv"), HEADER + day("2025-11-24", "A"))
    with pytest.raises(RF.LoadError, match="names no week"):
        load(spark, place)
    ledger = Ledger(spark, place("table"))
    subject = ledger.open_issues().first()["subject"]
    with pytest.raises(RF.LoadError, match="names no week"):
        RF.require_settled([ledger])
    ledger.dismiss(subject, "withdrawn by the sender")
    RF.require_settled([ledger])


def test_issue_states(spark, place):
    ledger = Ledger(spark, place("x"))
    assert ledger.open_issues().count() == 0
    ledger.settle([Issue("a", "p", "bad"), Issue("b", None, "bad")], set(), "1")
    ledger.settle([Issue("b", None, "still")], {"a", "b", "never opened"}, "2")
    assert [(r.subject, r.reason) for r in ledger.open_issues().collect()] == [("b", "still")]
    ledger.settle([Issue("a", "p", "again")], set(), "3")
    ledger.settle([], {"b"}, "4")
    assert [(r.subject, r.path, r.reason) for r in ledger.open_issues().collect()] == [("a", "p", "again")]


def test_partial_days_are_tried_again_together(spark, place):
    put(place("in", WEEK), HEADER + day("2025-11-24", "A") + day("2025-11-24", "B"), 500)
    load(spark, place)
    put(place("in", "delay_data_2025-11-23_2025-11-29.csv"), HEADER + day("2025-11-24", "A", 7), 100)
    with pytest.raises(RF.LoadError, match="lacks B on 2025-11-24"):
        load(spark, place)
    assert totals(spark, place)[("2025-11-24", "A")] == 2.0
    put(place("in", "delay_data_2025-11-22_2025-11-28.csv"), HEADER + day("2025-11-24", "B", 8), 90)
    load(spark, place)  # alone it lacks A; together they are whole
    assert totals(spark, place) == {("2025-11-24", "A"): 7.0, ("2025-11-24", "B"): 8.0}
    RF.require_settled([Ledger(spark, place("table"))])
    assert not os.path.exists(place("table_rejects")) or not os.listdir(place("table_rejects"))


def test_rejected_rows_can_be_replayed(spark, place, monkeypatch):
    put(place("in", WEEK), HEADER + day("2025-11-24", "A") + "2025-11-25,30,B,\"2,5\",10,0.2\n")
    load(spark, place)
    assert RF.replay_rejects(spark, place("in"), place("table")) == 1
    assert len(totals(spark, place)) == 1  # it still cannot be typed, and stays beside the table
    real = RF.with_reject_reason
    fixed = lambda text: real(text.withColumn("total_delay_minutes", RF.F.regexp_replace("total_delay_minutes", ",", ".")))
    monkeypatch.setattr(RF, "with_reject_reason", fixed)
    assert RF.replay_rejects(spark, place("in"), place("table")) == 1
    assert totals(spark, place) == {("2025-11-24", "A"): 2.0, ("2025-11-25", "B"): 2.5}
    assert RF.replay_rejects(spark, place("in"), place("table")) == 0


def test_arrays_of_unequal_length_are_refused(spark, place):
    put(place("in", "region_6.json"), response("2025-06-01", "2025-06-02", temperature_2m_mean=[20.0]))
    put(place("in", "region_7.json"), response("2025-06-01"))
    with pytest.raises(RF.LoadError, match="region_6.json: daily arrays of unequal length"):
        RF.load_weather(spark, place("in"), place("table"), place("ck"))
    assert [r.region_id for r in SK.read_table(spark, place("table"), WEATHER_ALL).collect()] == [7]
    with pytest.raises(Exception, match="unequal length"):
        flatten_responses(R.read_weather_responses(spark, place("in", "region_6.json"))).collect()


def test_regions_come_from_the_configuration(spark, place):
    stations(spark, place, "A")
    put(place("in", WEEK), HEADER + day("2025-11-24", "A"))
    put(place("weather_in", "region_9.json"), response("2025-11-24"))
    spark.range(10).selectExpr("cast(id as int) region_id").write.parquet(place("regions"))
    summary = {(r.step, r.metric): r.value for r in refreshed(spark, place, place("regions")).collect()}
    assert summary[("weather", "missing_cells_newest_week")] == 7 * 10 - 1


def test_a_file_without_its_columns_blocks_no_other(spark, place):
    put(place("in", WEEK), "date,station_name\n2025-11-24,A\n")
    put(place("in", "delay_data_2025-12-01_2025-12-07.csv"), HEADER + day("2025-12-01", "A"))
    put(place("in", "delay_data_2025-12-08_2025-12-14.csv"), "")
    with pytest.raises(RF.LoadError) as e:
        load(spark, place)
    assert "has no column station_id" in str(e.value) and "holds no rows" in str(e.value)
    assert list(totals(spark, place)) == [("2025-12-01", "A")]


def test_very_many_files_in_two_column_orders(spark, place):
    start = dt.date(2001, 1, 1)
    for i in range(1001):
        d = start + dt.timedelta(days=i)
        text = HEADER + day(d, "A", i) if i % 2 else f"station_name,date,avg_delay_minutes,train_count,total_delay_minutes,station_id\nA,{d},0.1,10,{i},30\n"
        put(place("in", f"delay_data_{i:04d}.csv"), text)
    rows = R.read_delay_csv(spark, place("in")).collect()
    assert len(rows) == 1001 and all(r.date == start + dt.timedelta(days=int(r.total_delay_minutes)) and r.station_id == 30 for r in rows)
    headers = R.header_lines(spark, place("in"))
    assert headers.count() == 1001 and headers.select("header").distinct().count() == 2
