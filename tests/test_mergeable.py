"""Medians from sketches, days from bitmaps, boxes as a table, ids that survive."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from railpulse import jobs
from railpulse.constants import STATION_COORDS
from railpulse.operators import grid as G
from railpulse.operators import kpis as K
from railpulse.operators import mergeable as M
from railpulse.sources import sinks as SK

UNIFIED = ("date DATE, station_name STRING, county STRING, region STRING, total_delay_minutes DOUBLE, train_count INT, avg_delay_minutes DOUBLE, "
           "high_temp INT, high_wind INT, high_precip INT")


def lower_median(values):
    return sorted(values)[(len(values) + 1) // 2 - 1]


@pytest.fixture(scope="module")
def unified(spark):
    rng = random.Random(3)
    start, flag = dt.date(2025, 1, 1), lambda: rng.choice([0, 0, 1, None])
    rows = [(rng.choice([None, *[start + dt.timedelta(days=i) for i in range(60)]]), f"S{rng.randrange(25)}", "C", rng.choice(["X", "Y", None]), 1.0, 5,
             round(rng.gammavariate(2, 4), 2), flag(), flag(), flag()) for _ in range(6000)]
    return spark.createDataFrame(rows, UNIFIED).checkpoint()


def by_region(df):
    return {r["region"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("brackets", [M.BRACKETS, ((0.0, 0.01, None)), (None,)])
def test_medians_from_day_sketches_are_exact(unified, brackets):
    """A bracket of no width misses most medians: the next one finds them."""
    assert by_region(M.kpi_median_bracketed(unified, brackets=brackets)) == by_region(K.kpi_median_exact(unified))


def test_bracketed_median_of_odd_groups(spark):
    groups = {"one": [3.0], "two": [1.0, 2.0], "ties": [5.0] * 9 + [7.0], "many": [float(i % 977) for i in range(20_000)], None: [-1.0, 0.0, 4.0]}
    rows = [(g, dt.date(2025, 1, 1 + i % 28), v) for g, own in groups.items() for i, v in enumerate(own)]
    values = spark.createDataFrame(rows, "g string, date date, v double")
    sketches = M.merged_sketches(M.day_sketches(values, ["g"], 200), ["g"], 200)
    got = {r["g"]: r["median"] for r in M.bracketed_median(values, sketches, ["g"], (0.001, 0.01, None)).collect()}
    assert got == {g: lower_median(own) for g, own in groups.items()}
    assert M.bracketed_median(values.where("false"), sketches.where("false"), ["g"]).count() == 0


@pytest.mark.parametrize("threshold", [None, 5.0])
def test_days_from_bitmaps(unified, threshold):
    limit = M.calm_limit(unified) if threshold is None else threshold
    half = F.col("date") < F.lit("2025-02-01").cast("date")
    # Two loads that overlap in all of January.
    sets = M.day_sets(unified.where(half), limit).union(M.day_sets(unified, limit)).withColumn("rows", F.col("rows"))
    whole = M.day_sets(unified, limit)
    expected = [tuple(r) for r in K.kpi_resilience(unified, threshold, top=None).collect()]
    assert [tuple(r) for r in M.resilience_of_day_sets(M.merged_day_sets(whole), top=None).collect()] == expected
    days = {(r[0], r[1]): (r["extreme_weather_days"], r["resilient_days"]) for r in M.resilience_of_day_sets(M.merged_day_sets(sets), top=None).collect()}
    assert days == {(r[0], r[1]): (r[3], r[4]) for r in expected}


def test_days_of_many_years(spark):
    days = [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2500, 7, 1), dt.date(2500, 7, 1)]
    rows = [(d, "S", "C", "X", 1.0, 1, 1.0, 1, 0, 0) for d in days]
    got = M.resilience_of_day_sets(M.merged_day_sets(M.day_sets(spark.createDataFrame(rows, UNIFIED), 5.0))).first()
    assert (got["observed_days"], got["extreme_weather_days"], got["resilient_days"]) == (5, 4, 4)


def test_ten_thousand_boxes(spark):
    rng = np.random.default_rng(5)
    low = rng.uniform(-60, 60, (10_000, 2)).round(3)
    size = np.where(rng.random((10_000, 1)) < 0.02, 40.0, 2.0 ** rng.integers(-8, 2, (10_000, 1))) * rng.random((10_000, 2))
    size[:50] = 0  # points as boxes
    high = low + size.round(3)
    boxes = [(f"b{i % 4000}", int(i * 7919 % 10_000), *map(float, (a[0], b[0], a[1], b[1]))) for i, (a, b) in enumerate(zip(low, high))]
    points = np.concatenate([rng.uniform(-62, 62, (700, 2)).round(3), low[:60], high[:60]])
    rows = [(i, *map(float, p)) for i, p in enumerate(points)] + [(9000, *map(float, points[0])), (9001, None, 1.0), (9002, 1.0, None)]
    expected = {}
    for i, la, lo in rows:
        if la is None or lo is None:
            expected[i] = None
            continue
        inside = np.flatnonzero((low[:, 0] <= la) & (la <= high[:, 0]) & (low[:, 1] <= lo) & (lo <= high[:, 1]))
        expected[i] = min(((boxes[j][1], boxes[j][0]) for j in inside), default=(0, None))[1]
    table = spark.createDataFrame([*boxes, ("reversed", -1, 50.0, -50.0, -50.0, 50.0), ("unknown", -1, None, 9.0, 0.0, 9.0)],
                                  "name STRING, priority INT, lat_min DOUBLE, lat_max DOUBLE, lon_min DOUBLE, lon_max DOUBLE")
    df = spark.createDataFrame(rows, "id INT, lat DOUBLE, lon DOUBLE")
    found = G.first_box(df, table)
    assert {r["id"]: r["county"] for r in found.collect()} == expected and any(expected.values())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    per_box = G.box_cells(table).groupBy("name", "priority").count().agg(F.max("count")).first()[0]
    assert per_box <= 4
    assert {r["county"] for r in G.first_box(df, table.where("false")).collect()} == {None}


def test_ids_survive_a_lost_run(spark, tmp, monkeypatch):
    coords = lambda *names: spark.createDataFrame([(n, 47.5, 19.0) for n in names], STATION_COORDS)
    ids = lambda df: {r["station_name"]: r["station_id"] for r in df.collect()}
    out, lookup = f"{tmp}/stations", f"{tmp}/lookup"
    assert ids(jobs.preprocess_stations(coords("B", "D"), out, lookup)) == {"B": 1, "D": 2}
    write = SK.write_result

    def lost(df, path):
        SK.delete_folder(spark, path)  # the old table is gone, the new one not written
        raise OSError("lost")

    monkeypatch.setattr(SK, "write_result", lost)
    with pytest.raises(OSError):
        jobs.preprocess_stations(coords("A", "B", "D"), out, lookup)
    monkeypatch.setattr(SK, "write_result", write)
    want = {"B": 1, "D": 2, "A": 3, "C": 4}
    assert ids(jobs.preprocess_stations(coords("A", "B", "C", "D"), out, lookup)) == want
    assert ids(spark.read.json(lookup)) == want
    assert spark.read.parquet(f"{out}_ids").count() == 4  # new names only
    assert ids(jobs.preprocess_stations(coords("D"), out, lookup)) == {"D": 2}
    assert ids(jobs.preprocess_stations(coords("A", "E"), out, lookup)) == {"A": 3, "E": 5}


def test_ids_of_a_table_without_a_log(spark, tmp):
    coords = spark.createDataFrame([("A", 47.5, 19.0), ("B", 47.5, 19.0)], STATION_COORDS)
    out = f"{tmp}/stations"
    spark.createDataFrame([("B", 7)], "station_name STRING, station_id INT").write.parquet(out)
    got = jobs.preprocess_stations(coords, out, f"{tmp}/lookup")
    assert {r["station_name"]: r["station_id"] for r in got.collect()} == {"B": 7, "A": 8}
