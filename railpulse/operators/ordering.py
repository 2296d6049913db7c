"""Order statistics without a single-task global window.

``Window.orderBy(...)`` with no partition key moves the whole input into one
task. Here the input is range-partitioned on the order key instead and sorted
inside each partition, so a row's place in its partition is known without a
second exchange; the per-partition totals (one row per partition, a bound set
by configuration) become offsets. The ranged frame is checkpointed once, so that
all passes see the same partitions, and lineage is cut at that point. NULLs come
last in every order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from railpulse.session import ensure_checkpoint_dir


def _nulls_last(cols: list[str | Column]) -> list[Column]:
    return [F.asc_nulls_last(c) if isinstance(c, str) else c for c in cols]


def _ranged(df: DataFrame, order_cols: list[str | Column], num_partitions: int | None) -> DataFrame:
    """``df`` range-partitioned and sorted, with ``_pid`` (the range) and ``_at``
    (0-based place in it), checkpointed."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _nulls_last(order_cols)
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                .withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True))
    # The id holds the partition above 33 bits, the place in it below.
    return placed.withColumn("_pid", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))


def global_running_sum(df: DataFrame, order_cols: list[str | Column], weight: Column | None = None,
                       out: str = "_cum", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = running sum of ``weight`` (default 1, i.e. a 1-based row
    number) over the total order ``order_cols``.

    Ties in ``order_cols`` are numbered in an arbitrary but consistent order;
    pass a total order to get a deterministic result."""
    if weight is None:
        local = _ranged(df, order_cols, num_partitions).withColumn("_lcum", F.col("_at") + 1)
        part_totals = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_psum"))
    else:
        # A running sum inside each range: the window's exchange on _pid keeps
        # each range whole in one task, bounded by the range, not by the data.
        local = _ranged(df.withColumn("_w", weight.cast("long")), order_cols, num_partitions).withColumn(
            "_lcum", F.sum("_w").over(Window.partitionBy("_pid").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)))
        part_totals = local.groupBy("_pid").agg(F.sum("_w").alias("_psum"))
    # One row per partition: a bounded table, safe to order globally and to
    # broadcast.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part_totals.select(
        "_pid", F.coalesce(F.sum("_psum").over(before), F.lit(0)).alias("_poff"))
    return (local.join(F.broadcast(offsets), "_pid")
                 .withColumn(out, F.col("_poff") + F.col("_lcum"))
                 .drop("_pid", "_at", "_w", "_lcum", "_poff"))


def dense_row_ids(df: DataFrame, order_cols: list[str], id_col: str = "row_id",
                  num_partitions: int | None = None, start: int = 1) -> DataFrame:
    """``start``.. in ``order_cols`` order (byte order for strings, like C-locale
    sorting, NULLs last), as INT."""
    return (global_running_sum(df, order_cols, out="_rid", num_partitions=num_partitions)
            .withColumn(id_col, (F.col("_rid") + (start - 1)).cast("int")).drop("_rid"))


def lower_median(df: DataFrame, group_cols: list[str], value_col: str, out: str = "median",
                 num_partitions: int | None = None) -> DataFrame:
    """Exact lower median per group (the discrete 0.5 percentile: the smallest
    value whose cumulative share reaches one half), NULL values ignored.

    No group is held in one task: values are counted per distinct (group,
    value) with map-side combining and range-partitioned by (group, value). The
    totals per range and group (a row per range, plus one per group) tell in
    which range each group's median lies; only that slice of the group, bounded
    by a range, is then walked."""
    counted = (df.where(F.col(value_col).isNotNull())
                 .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_c")))
    ranged = _ranged(counted, [*group_cols, value_col], num_partitions)
    keys = [f"_g{i}" for i in range(len(group_cols))]
    totals = ranged.groupBy(F.col("_pid").alias("_p"), *[F.col(g).alias(k) for g, k in zip(group_cols, keys)]) \
        .agg(F.sum("_c").alias("_t"))
    group = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_t").over(group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    k = F.ceil(F.sum("_t").over(group) / F.lit(2.0))
    slices = totals.withColumn("_k", k - before).where((F.col("_k") > 0) & (F.col("_k") <= F.col("_t"))) \
        .select("_p", *keys, "_k")
    cond = [F.col("_pid") == F.col("_p"), *[F.col(g).eqNullSafe(F.col(kc)) for g, kc in zip(group_cols, keys)]]
    walked = ranged.join(slices, cond).withColumn("_cum", F.sum("_c").over(
        Window.partitionBy(*group_cols).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)))
    picked = walked.where((F.col("_cum") >= F.col("_k")) & (F.col("_cum") - F.col("_c") < F.col("_k")))
    return picked.select(*group_cols, F.col(value_col).alias(out))
