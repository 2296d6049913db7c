"""Plan shape: pruning and pushdown at the scan, no Python in any plan,
dimensions joined without a shuffle, no sort in the base view."""
import pytest

from conftest import SF
from railpulse.plans.catalog import QUERIES
from railpulse.plans.domain import Domain


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_anywhere(spark):
    for name, fn in QUERIES.items():
        p = plan(fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_scan_is_pruned_and_filtered(spark):
    from railpulse.operators.delays import in_date_range
    p = in_date_range(Domain(spark, SF).records(), "2024-01-08", "2024-01-14") \
        .select("service_date", "delay")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts)" in p or "PushedFilters: [IsNotNull(ts), " in p
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in p


def test_unified_joins_broadcast_and_unsorted(spark):
    u = Domain(spark, SF).unified()
    u.collect()
    p = plan(u)
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p
    assert "Sort [date" not in p  # no ORDER BY date, station_name in the base view


def test_resilience_subquery_runs_once(spark):
    from railpulse.operators.kpis import kpi_resilience
    p = kpi_resilience(Domain(spark, SF).unified())._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("scalar-subquery") <= 2


def test_hot_station_is_combined_before_the_shuffle(spark):
    """One station holds a third of all records: the totals stay exact and
    the aggregate is partial (map-side) below its exchange."""
    import datetime as dt
    from pyspark.sql import functions as F
    from railpulse.operators import delays as D
    n = 30000
    base = spark.range(n).select(
        F.lit(dt.date(2025, 6, 1)).alias("service_date"),
        F.lit("InduloAllomas").alias("record_type"),
        F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("S"), (F.col("id") % 97).cast("string"))).alias("origin"),
        F.lit("x").alias("destination"),
        (F.col("id") % 11).cast("double").alias("delay"))
    recs = base
    daily = D.daily_station_delays(D.non_early(D.clean_records(D.with_station_name(recs))))
    hot = daily.where("station_name = 'Hot'").collect()[0]
    expect = sum(i % 11 for i in range(0, n, 3))
    assert hot.train_count == n // 3 and hot.total_delay_minutes == expect
    p = daily._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in p and p.index("Exchange hashpartitioning") < p.rindex("partial_sum")


def test_date_range_reaches_a_stored_raw_table(spark, tmp):
    """Raw records stored with a service_date column: the range filter is a
    pushed filter on a plain scan and prunes date partitions."""
    import os
    from railpulse.operators.delays import in_date_range
    from railpulse.sources.readers import read_raw_records
    path = os.path.join(tmp, "raw")
    Domain(spark, SF).records().write.partitionBy("service_date").parquet(path)
    df = in_date_range(read_raw_records(spark, path), "2024-01-08", "2024-01-14").select("delay")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service_date" in p and "service_date" in p.split("PartitionFilters:")[1][:200]
    assert df.count() == Domain(spark, SF).records().where("service_date between '2024-01-08' and '2024-01-14'").count()


def test_no_cross_join_and_no_nested_loop(spark):
    for name, fn in QUERIES.items():
        p = plan(fn(spark, SF))
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name
