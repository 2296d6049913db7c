"""Weather flags, response flattening, region config, decimal-comma text."""
import json
import os

from railpulse.operators import weather as W
from railpulse.sources import readers as R


def test_flag_boundaries(spark):
    rows = [(0, "2025-06-01", -5.0, 5.0, 45.0), (0, "2025-06-02", -5.1, 5.1, 45.1),
            (0, "2025-06-03", 25.0, 0.0, 0.0), (0, "2025-06-04", 25.1, None, 0.0)]
    df = spark.createDataFrame(rows, "region_id INT, date STRING, temperature_mean_c DOUBLE, precipitation_sum_mm DOUBLE, wind_gust_max_kmh DOUBLE")
    out = [(r.high_temp, r.high_wind, r.high_precip) for r in W.with_flags(W.enforce_weather_schema(df)).orderBy("date").collect()]
    assert out == [(0, 0, 0), (1, 1, 1), (0, 0, 0), (1, 0, None)]


def test_flatten_response_files(spark, tmp):
    docs = {"resp_region_3.json": {"daily": {"time": ["2025-06-01", "2025-06-02"], "temperature_2m_mean": [26.0, None],
                                              "wind_gusts_10m_max": [10.0, 50.0], "precipitation_sum": [0.0, 6.0]}},
            "resp_region_5.json": {"daily": {"time": [], "temperature_2m_mean": [], "wind_gusts_10m_max": [],
                                              "precipitation_sum": []}}}
    for n, doc in docs.items():
        with open(os.path.join(tmp, n), "w") as f:
            json.dump(doc, f, indent=2)
    rows = W.weather_from_responses(R.read_weather_responses(spark, tmp)).orderBy("date").collect()
    assert [(r.region_id, str(r.date), r.high_temp, r.high_wind, r.high_precip) for r in rows] == \
        [(3, "2025-06-01", 1, 0, 0), (3, "2025-06-02", None, 1, 1)]


def test_region_config_positions(spark, tmp):
    p = os.path.join(tmp, "region_coordinates.json")
    with open(p, "w") as f:
        json.dump({"regions": [{"region_name": "Észak-Magyarország", "lat": 48.1, "lon": 20.8},
                               {"region_name": "Észak-Alföld", "lat": 47.5, "lon": 21.5}]}, f, indent=2)
    got = [(r.region_id, r.region_name) for r in R.read_region_config(spark, p).collect()]
    assert got == [(0, "Észak-Magyarország"), (1, "Észak-Alföld")]


def test_initial_weather_text(spark, tmp):
    p = os.path.join(tmp, "weather_initial.csv")
    with open(p, "w") as f:
        f.write("location_id;latitude;longitude;time;temperature_2m_mean;precipitation_sum;wind_gusts_10m_max;high_temp;high_wind;high_precip\n")
        f.write("0;48,1195;20,85;2025-06-01;21,8;1,3; 38,2;0;0;0\n")
    r = R.read_weather_initial_csv(spark, p).collect()[0]
    assert (r.region_id, str(r.date), r.temperature_mean_c, r.precipitation_sum_mm, r.wind_gust_max_kmh) == \
        (0, "2025-06-01", 21.8, 1.3, 38.2)
    assert (r.high_temp, r.high_wind, r.high_precip) == (0, 0, 0)


def test_strict_flags_fail_on_null_measurement(spark):
    import pytest
    df = spark.createDataFrame([(0, "2025-06-01", None, 1.0, 1.0)],
                               "region_id INT, date STRING, temperature_mean_c DOUBLE, precipitation_sum_mm DOUBLE, wind_gust_max_kmh DOUBLE")
    with pytest.raises(Exception, match="NULL weather measurement"):
        W.with_flags(W.enforce_weather_schema(df), strict=True).collect()
    ok = W.with_flags(W.enforce_weather_schema(df.fillna(0.0)), strict=True).collect()[0]
    assert (ok.high_temp, ok.high_wind, ok.high_precip) == (0, 0, 0)
