"""What a load has taken in, and what is still wrong with it.

The ledger of a table holds one row per file version that was read: path,
modification time and length name a version, so a corrected file that lands under
its old name is new work. ``days`` are the days stored from it. The issue table is
a log of events per subject (a file, a week or a day): the newest event says whether
the subject is open or resolved. Both are small append-only Parquet folders beside
the table; a row is only ever added after what it speaks of is stored, so a run that is
lost repeats its work and loses nothing.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from railpulse.sources.sinks import read_stored

FILES = "entry STRING, path STRING, modified TIMESTAMP, length BIGINT, load STRING, days ARRAY<DATE>, at TIMESTAMP"
EVENTS = "subject STRING, path STRING, reason STRING, state STRING, load STRING, at TIMESTAMP"


@dataclass(frozen=True)
class Version:
    path: str
    modified: dt.datetime
    length: int

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


@dataclass(frozen=True)
class Issue:
    subject: str
    path: str | None
    reason: str

    def __str__(self) -> str:
        return f"{self.path}: {self.reason}" if self.path else self.reason


def listing(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """(path, modified, length) of a folder's files; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def blank_files(spark: SparkSession, folder: str, glob: str) -> list[Version]:
    """Files without a byte: Spark's readers pass over them. A listing on the driver,
    as the stream's own is."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{glob}")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return [Version(f.getPath().toString(), dt.datetime.fromtimestamp(f.getModificationTime() / 1000), 0)
            for f in found if f.getLen() == 0 and f.isFile()]


class Ledger:
    def __init__(self, spark: SparkSession, table_path: str):
        self.spark, base = spark, table_path.rstrip("/")
        self.files_path, self.events_path = f"{base}_ledger", f"{base}_issues"

    def _append(self, rows: list[tuple], schema: str, path: str) -> None:
        if rows:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def _read(self, schema: str, path: str) -> DataFrame:
        stored = read_stored(self.spark, path)
        return self.spark.createDataFrame([], schema) if stored is None else stored

    # -- files ---------------------------------------------------------------
    def files(self) -> DataFrame:
        return self._read(FILES, self.files_path)

    def record(self, versions: list[Version], load: str, days: dict[str, list[dt.date]]) -> None:
        """``days`` by file name: those stored from it."""
        now = dt.datetime.now()
        self._append([(uuid.uuid4().hex, v.path, v.modified, v.length, load, days.get(v.name, []), now) for v in versions],
                     FILES, self.files_path)

    def pending(self, folder: str, glob: str, limit: int) -> list[Version]:
        """The oldest file versions of a folder that were not read, at most ``limit``."""
        new = listing(self.spark, folder, glob).join(self.files().select("path", "modified", "length"), ["path", "modified", "length"], "left_anti")
        return [Version(r["path"], r["modified"], r["length"]) for r in new.orderBy("modified", "path").limit(limit).collect()]

    def blank(self, folder: str, glob: str) -> list[Version]:
        """Files without a byte that were not told of before."""
        found = blank_files(self.spark, folder, glob)
        if found:
            told = {(r["path"], r["modified"]) for r in self.files().where("length = 0").select("path", "modified").collect()}
            found = [v for v in found if (v.path, v.modified) not in told]
        return found

    def newest_of_days(self) -> DataFrame:
        """(date, stored_from): when the newest file that a day is stored from was modified."""
        return self.files().select(F.explode("days").alias("date"), "modified").groupBy("date").agg(F.max("modified").alias("stored_from"))

    # -- issues --------------------------------------------------------------
    def settle(self, found: list[Issue], sound: set[str], load: str) -> None:
        """Open the issues found, and resolve those of the subjects that are sound."""
        now = dt.datetime.now()
        rows = [(i.subject, i.path, i.reason, "open", load, now) for i in found]
        done = sound - {i.subject for i in found}
        if done:
            rows += [(r["subject"], r["path"], None, "resolved", load, now)
                     for r in self.open_issues().collect() if r["subject"] in done]  # issues wait for people: few
        self._append(rows, EVENTS, self.events_path)

    def dismiss(self, subject: str, reason: str) -> None:
        """Resolve an issue by hand, saying why."""
        self._append([(subject, None, reason, "resolved", "dismissed", dt.datetime.now())], EVENTS, self.events_path)

    def open_issues(self) -> DataFrame:
        """(subject, path, reason, load, at) of every subject whose newest event is open."""
        events = self._read(EVENTS, self.events_path)
        last = events.groupBy("subject").agg(F.max_by(F.struct("path", "reason", "state", "load", "at"), F.col("at")).alias("last"))
        return last.where("last.state = 'open'").select("subject", "last.path", "last.reason", "last.load", "last.at")
