"""Batch entry points over the sf0.001 test tables."""
import os

from conftest import SF
from railpulse import jobs
from railpulse.constants import DELAYS_ALL
from railpulse.operators.unified import unified_all
from railpulse.plans.domain import Domain
from railpulse.sources import readers as R
from railpulse.sources import sinks as SK


def test_preprocessing_runs_and_report(spark, tmp):
    dom = Domain(spark, SF)
    stations = jobs.preprocess_stations(dom.coords(), os.path.join(tmp, "stations"), os.path.join(tmp, "lookup"))
    lookup = R.read_station_lookup(spark, os.path.join(tmp, "lookup"), multi_line=False)
    assert lookup.count() == stations.count() == 10
    table = os.path.join(tmp, "delays_all")
    r1 = jobs.preprocess_delays(dom.records(), lookup, table, "2024-01-01", "2024-01-16")
    r2 = jobs.preprocess_delays(dom.records(), lookup, table, "2024-01-17", "2024-01-30")
    assert r1.total_before + r2.total_before == 600 and r1.total_after + r2.total_after == 456
    assert r1.removed == r1.total_before - r1.total_after
    stored = SK.read_table(spark, table, DELAYS_ALL)
    assert stored.count() == 280 == r1.rows_written + r2.rows_written
    csv = jobs.preprocess_delays(dom.records(), lookup, os.path.join(tmp, "export"), fmt="csv")
    assert csv.rows_written == 280
    paths = jobs.kpi_report(spark, unified_all(stored, stations, dom.weather()), os.path.join(tmp, "kpis"), min_trains=1)
    assert spark.read.parquet(paths["kpi_resilience"]).count() == 10
