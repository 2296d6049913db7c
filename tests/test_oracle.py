"""Every registered query against its DuckDB oracle at sf0.001."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from railpulse.plans.catalog import QUERIES
from railpulse.plans.oracle import ORACLE
from conftest import SF
from tools.check_oracle import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = ORACLE.get(name)
    assert sql is not None, f"{name} has no oracle"
    cur = con.execute(sql)
    ocols = [x[0] for x in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["station_name", "region", "observed_days", "extreme_weather_days",
                          "resilient_days", "resilience_score_pct"]
    assert 0 < df.count() <= 10
