"""Writers. Base tables are Parquet partitioned by ``date``; a load replaces
exactly the days it carries (dynamic partition overwrite), so running the same
week twice leaves the table unchanged."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F, types as T

from railpulse.session import ensure_checkpoint_dir


class PartialDayError(RuntimeError):
    pass


def write_staged_csv(df: DataFrame, path: str) -> None:
    """Staging copy with a header; as many files as partitions (no single
    forced task)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_csv(df: DataFrame, path: str, null_text: str = "",
               sort_cols: list[str] | None = None) -> None:
    """CSV export, NULL written as ``null_text`` (empty by default).

    ``sort_cols`` orders the output (e.g. date, station name for the daily
    delays): a distributed range sort, files written in key order."""
    if sort_cols:
        df = df.orderBy(*sort_cols)
    df.write.mode("overwrite").option("header", True).option("nullValue", null_text) \
        .option("emptyValue", "\"\"").csv(path)


def export_lookup_json(lookup: DataFrame, path: str) -> None:
    """Lookup as JSON lines (read back without multiLine)."""
    lookup.select("station_id", "station_name").write.mode("overwrite").json(path)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """CREATE OR REPLACE VIEW: a temp view over the (lazy) DataFrame. A staging
    table is one too: nothing to create on storage, nothing to drop afterwards."""
    df.createOrReplaceTempView(name)
    return df


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def newest_per_key(rows: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """One row per ``keys``: the one with the largest ``newest`` columns."""
    order = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in newest])
    return rows.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def read_stored(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The stored table, None before its first load."""
    try:
        return spark.read.parquet(table_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def lost_keys(batch: DataFrame, table_path: str, spark: SparkSession,
              date_col: str = "date", key_col: str = "station_name") -> DataFrame | None:
    """Stored keys that the batch lacks on its own days; None before the first load."""
    stored = read_stored(spark, table_path)
    if stored is None:
        return None
    # Only the batch's days are read back: the semi join lets dynamic
    # partition pruning skip every other date partition of the stored table.
    keys = batch.select(date_col, key_col)
    old = stored.join(keys.select(date_col).distinct(), date_col, "left_semi")
    return old.join(keys, [date_col, key_col], "left_anti").select(date_col, key_col)


def check_whole_days(batch: DataFrame, table_path: str, spark: SparkSession,
                     date_col: str = "date", key_col: str = "station_name") -> None:
    """Refuse a batch that would lose a stored row: a per-date overwrite must
    bring every key (``key_col``) that its days hold already."""
    missing = lost_keys(batch, table_path, spark, date_col, key_col)
    lost = None if missing is None else missing.first()
    if lost is not None:
        raise PartialDayError(f"the batch lacks {lost[1]} on {lost[0]}, which {table_path} holds")


def merge_days(batch: DataFrame, table_path: str, schema: T.StructType, keys: list[str],
               partition_col: str = "date") -> int:
    """Insert or replace rows by ``keys`` in a table partitioned by day: a row of
    the batch replaces the stored row of its key, other rows of the day stay. Only
    the batch's days are read and written, one writer's files per day. The merged
    days are checkpointed before they replace what was read. Returns the number of
    batch rows."""
    spark = batch.sparkSession
    ensure_checkpoint_dir(spark)
    batch = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    stored = read_stored(spark, table_path)
    merged = batch
    if stored is not None:
        old = stored.join(batch.select(partition_col).distinct(), partition_col, "left_semi") \
            .join(batch.select(*keys), keys, "left_anti")
        merged = batch.unionByName(old.select(*batch.columns))
    append_days(merged.checkpoint(eager=True), table_path, schema, partition_col)
    return batch.count()


def append_days(batch: DataFrame, table_path: str, schema: T.StructType,
                partition_col: str | list[str] = "date", check_partial: bool = False, replace_all: bool = False) -> int:
    """Insert a batch into a date-partitioned Parquet table, by column name.

    Only the partitions (days) present in the batch are replaced; other days
    stay. Re-running the same batch is therefore a no-op in effect. The batch
    is rebalanced on the partition column: each day goes to few writers, and
    AQE splits a day that holds far more rows than the others across several
    tasks instead of one.
    Returns the number of rows written, counted during the write itself.
    Rows with a NULL partition value are refused. With ``replace_all`` days that the
    batch does not hold go.
    """
    spark = batch.sparkSession
    parts = [partition_col] if isinstance(partition_col, str) else list(partition_col)
    if check_partial:
        check_whole_days(batch, table_path, spark, parts[0])
    # Rows without a day would share one partition, and each load would replace
    # the last one's: such a row fails the write.
    cols = [F.coalesce(F.col(f.name).cast(f.dataType), F.raise_error(F.lit(f"row without {f.name}")).cast(f.dataType)).alias(f.name)
            if f.name in parts else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    obs = Observation("append_days")
    (batch.select(*cols)
          .observe(obs, F.count(F.lit(1)).alias("rows"))
          .hint("rebalance", *parts)
          .write.mode("overwrite")
          .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
          .partitionBy(*parts)
          .parquet(table_path))
    try:
        return int(obs.get.get("rows", 0))
    except Py4JJavaError as e:  # a plan that Spark finds empty has no task, no metric and no row
        if "assertion failed" not in str(e):
            raise
        return 0


def read_table(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    """A date-partitioned table read back in its declared column order; no file is
    opened to learn its columns."""
    df = spark.read.schema(schema).parquet(table_path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_result(df: DataFrame, path: str) -> None:
    """Store a query result (KPI tables) as Parquet, replacing the last run."""
    df.write.mode("overwrite").parquet(path)
