"""Helpers shared by the operators: table access, bounded Arrow slices, folds
and materialised intermediates in the cluster's shared folder."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from railpulse.session import drop_scratch, ensure_checkpoint_dir, scratch_path

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Words: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
# Bytes of text that one vectorised step holds at a time, whatever the size of
# an Arrow batch; a single longer text is a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts lineage, survives lost executors, gives the planner sizes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing reads any more, and the shuffle files of
    plans that are gone."""
    for t in tables:
        drop_scratch(t.sparkSession, t.scratch_path)
    forget_shuffles(tables[0].sparkSession)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are gone: it does when the driver
    collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder the session names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fold(doc_id: str | Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(n)).cast("int")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold at most ``limit`` bytes of ``column``
    (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts(column: pa.Array) -> list[str]:
    """Texts of a column, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


def ragged_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + length) for each pair."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)
