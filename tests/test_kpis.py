"""KPIs on hand-written unified rows."""
import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from railpulse.operators import kpis as K
from railpulse.operators.ordering import lower_median

SCHEMA = ("date DATE, station_name STRING, county STRING, region STRING, total_delay_minutes DOUBLE, "
          "train_count INT, avg_delay_minutes DOUBLE, high_temp INT, high_wind INT, high_precip INT")


def day(i):
    return dt.date(2025, 6, 1) + dt.timedelta(days=i)


def unified(spark):
    rows = [
        # station A: 11 trains each, two delayed days, one extreme day (resilient: 4 <= calm 4.5)
        (day(0), "A", "c", "R1", 0.0, 11, 6.0, 0, 0, 0),
        (day(1), "A", "c", "R1", 0.0, 11, 7.0, 1, 0, 0),
        (day(2), "A", "c", "R1", 0.0, 11, 4.0, 0, 1, 0),
        # station B: 10 trains (not counted by the documented score), no extreme day
        (day(0), "B", "c", "R2", 0.0, 10, 9.0, 0, 0, 0),
        (day(1), "B", "c", "R2", 0.0, 10, 5.0, None, None, None),
        # station C: NULL region, all extreme and late
        (day(0), "C", None, None, 0.0, 20, 8.0, 0, 0, 1),
        (day(1), "C", None, None, 0.0, 20, 3.0, 0, 0, 0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_delay_score_documented_and_as_written(spark):
    u = unified(spark)
    doc = {r.station_name: r for r in K.kpi_delay_score(u, min_trains=10).collect()}
    assert set(doc) == {"A", "C"}  # B's 10-train days do not count
    assert (doc["A"].observed_days, doc["A"].delayed_days, doc["A"].percent_delayed_days) == (3, 2, 66.67)
    written = K.kpi_delay_score_as_written(u).collect()
    assert all(r.percent_delayed_days == 100.0 and r.delayed_days == r.observed_days for r in written)


def test_calm_mean_excludes_null_flags(spark):
    r = K.calm_mean(unified(spark)).collect()[0]
    assert r.calm_days == 3 and abs(r.calm_avg_delay - (6.0 + 9.0 + 3.0) / 3) < 1e-12


def test_resilience_sql_and_fixed(spark):
    u = unified(spark)
    out = K.kpi_resilience(u).collect()
    # calm mean 6.0: A's extreme days (7, 4) -> one resilient; C's (8) -> none; B has none -> NULL last
    assert [(r.station_name, r.extreme_weather_days, r.resilient_days, r.resilience_score_pct) for r in out] == \
        [("C", 1, 0, 0.0), ("A", 2, 1, 50.0), ("B", 0, 0, None)]
    fixed = {r.station_name: r.resilience_score_pct for r in K.kpi_resilience(u, threshold=5.0).collect()}
    assert fixed["A"] == 50.0 and fixed["C"] == 0.0


def test_resilience_duplicate_rows_count_days_once(spark):
    u = unified(spark)
    dup = u.unionByName(u.where(F.col("station_name") == "A"))
    a = [r for r in K.kpi_resilience(dup, threshold=5.0).collect() if r.station_name == "A"][0]
    assert (a.observed_days, a.extreme_weather_days, a.resilient_days) == (6, 2, 1)


def test_median_exact_equals_approx_and_python(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        region = rnd.choice(["R1", "R2", None, "R3"])
        rows.append((day(i % 30), f"s{i % 17}", "c", region, 0.0, 5, float(rnd.randint(0, 40)) / 4,
                     rnd.choice([0, 1, None]), rnd.choice([0, 1]), rnd.choice([0, 1])))
    u = spark.createDataFrame(rows, SCHEMA)
    approx = {r.region: r.asDict() for r in K.kpi_median(u).collect()}
    exact = {r.region: r.asDict() for r in K.kpi_median_exact(u, num_partitions=5).collect()}
    assert approx == exact
    for reg in ("R1", "R2", None, "R3"):
        vals = sorted(r[6] for r in rows if r[3] == reg and r[6] > 5)
        assert exact[reg]["median_delay"] == round(vals[(len(vals) - 1) // 2], 2)


def test_lower_median_bruteforce(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice(["a", "b", "c", None]), rnd.choice([None, float(rnd.randint(0, 9))])) for _ in range(500)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    got = {r.g: r.median for r in lower_median(df, ["g"], "v", num_partitions=6).collect()}
    for g in ("a", "b", "c", None):
        vals = sorted(v for k, v in rows if k == g and v is not None)
        assert got[g] == vals[(len(vals) - 1) // 2] == statistics.median_low(vals)


def test_region_share(spark):
    top = K.kpi_delay_score(unified(spark), min_trains=0)
    got = {r.region: (r.station_count, r.share_pct) for r in K.region_share(top).collect()}
    assert got == {"R1": (1, 33.3), "R2": (1, 33.3), None: (1, 33.3)}
