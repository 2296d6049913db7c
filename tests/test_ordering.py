"""The distributed running sum equals a plain prefix sum."""
from hypothesis import given, settings, strategies as st

from railpulse.operators.ordering import global_running_sum


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(st.tuples(st.integers(0, 20), st.integers(1, 5)), min_size=1, max_size=120),
       parts=st.integers(1, 9))
def test_running_sum_matches_prefix_sum(spark, rows, parts):
    data = [(k, i, w) for i, (k, w) in enumerate(rows)]
    df = spark.createDataFrame(data, "k INT, i INT, w INT")
    from pyspark.sql import functions as F
    got = {r.i: r._cum for r in global_running_sum(df, ["k", "i"], F.col("w"), num_partitions=parts).collect()}
    total, expect = 0, {}
    for k, i, w in sorted(data):
        total += w
        expect[i] = total
    assert got == expect


def test_exact_median_of_a_hot_group(spark):
    """A group with two thirds of all rows, many of them equal; no range is larger than
    its share, and the values are joined on their range, not gathered by group."""
    from railpulse.operators.ordering import lower_median
    rows = [("hot" if i % 3 else f"g{i % 7}", float((i * 37) % 101) if i % 5 else 7.0) for i in range(3000)] + [(None, 4.0), (None, None), ("empty", None)]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    values = {}
    for g, v in rows:
        if v is not None:
            values.setdefault(g, []).append(v)
    out = lower_median(df, ["g"], "v", "m", 6)
    assert {r.g: r.m for r in out.collect()} == {g: sorted(v)[(len(v) + 1) // 2 - 1] for g, v in values.items()}
    join = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert len(join) == 1 and "_pid" in join[0] and "_p" in join[0]
