"""Whole-pipeline properties on the sf0.001 test tables."""
from pyspark.sql import functions as F

from conftest import SF
from railpulse.operators import delays as D
from railpulse.plans.domain import Domain, load_label
from railpulse.sources import testmap as TM


def test_unified_rows_equal_delays_with_id(spark):
    dom = Domain(spark, SF)
    assert dom.unified().count() == dom.delays().where(F.col("station_id").isNotNull()).count()


def test_before_equals_kept_plus_removed(spark):
    clean = Domain(spark, SF).clean().withColumn("load", load_label("date"))
    for r in D.early_filter_counts(clean, ["load"]).collect():
        assert r.total_before == r.total_after + r.removed
    total = D.early_filter_counts(Domain(spark, SF).clean()).collect()[0]
    assert (total.total_before, total.total_after) == (600, 456)


def test_station_ids_are_one_to_n(spark):
    ids = sorted(r.station_id for r in Domain(spark, SF).lookup().collect())
    assert ids == list(range(1, len(ids) + 1))


def test_loads_union_equals_one_load(spark):
    dom = Domain(spark, SF)
    loads = [sorted(map(tuple, dom.delays(a, b).collect()), key=str) for _, a, b in TM.LOADS]
    a = sorted((r for rows in loads for r in rows), key=str)
    b = sorted(map(tuple, dom.delays().collect()), key=str)
    assert a == b
