"""Command-line entry points end to end on the sf0.001 test tables."""
import os

from conftest import SF
from railpulse.__main__ import main
from railpulse.plans.domain import Domain


def test_cli_chain(spark, tmp):
    dom = Domain(spark, SF)
    j = lambda *p: os.path.join(tmp, *p)
    dom.coords().write.parquet(j("coords"))
    dom.records().write.parquet(j("records"))
    dom.weather().write.partitionBy("date").parquet(j("weather"))
    assert main(["stations", "--coords", j("coords"), "--stations-out", j("stations"),
                 "--lookup-out", j("lookup")]) == {"stations": 10}
    rep = main(["delays", "--records", j("records"), "--lookup", j("lookup"), "--out", j("delays")])
    assert (rep["total_before"], rep["total_after"], rep["rows_written"]) == (600, 456, 280)
    paths = main(["kpis", "--delays", j("delays"), "--stations", j("stations"), "--weather", j("weather"),
                  "--results", j("kpis"), "--min-trains", "1"])
    assert spark.read.parquet(paths["kpi_resilience"]).count() == 10
