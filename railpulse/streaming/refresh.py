"""Incremental loads of newly arrived files, and the weekly refresh.

Each landing folder is a Structured Streaming source of file names run with
``trigger(availableNow=True)``: every file not yet recorded in the query's
checkpoint is read once, then the query stops. The stream knows paths only; the ledger
beside the table knows versions, so a corrected file that lands under its old name is
read in a second step, after the stream. A run over an unchanged folder reads
nothing. A micro-batch reads its files by header name and
keeps, per key, the row of the newest file, so a week that lies there twice counts
once; a day that is stored from a newer file is not replaced by an older one. Rows that
cannot be stored go to ``<table>_rejects`` with their reason and file, and so do days
that lack stored rows; the other days of their batch are stored. Days rejected as
partial are tried again, together, at the end of every load that read something.
A file that cannot be loaded (empty, malformed, badly named) or such a day opens an
issue; the batch is committed, so later files still load, and the load fails once the
query has ended. The issue stays open over later runs, and no refresh passes it, until
a sound file or day resolves it or it is dismissed by hand. A batch retried after a
failure writes the same rows again.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from railpulse.constants import DELAYS_ALL, STATIONS_REGIONS, WEATHER_ALL, WEEK_FILE_GLOB, WEEK_FILE_PATTERN
from railpulse.operators import kpis as K
from railpulse.operators import quality as Q
from railpulse.operators.delays import with_reject_reason
from railpulse.operators.weather import enforce_weather_schema, flatten_responses, unequal_arrays, with_flags
from railpulse.session import drop_scratch, scratch_path
from railpulse.sources.readers import CORRUPT, newest_week_file, read_delay_text, read_weather_responses, week_bounds
from railpulse.sources.sinks import append_days, delete_folder, lost_keys, merge_days, newest_per_key, read_table, write_result
from railpulse.streaming.incremental import UNIFIED_ALL, applied, changes, require_unique_days, update_unified
from railpulse.streaming.ledger import Issue, Ledger, Version, listing

# Files of one micro-batch, so that a large backlog runs in bounded steps.
MAX_FILES = 1000
DELAY_KEY = ["date", "station_name"]
WEATHER_KEY = ["date", "region_id"]
NEWEST = ["_modified", "_file"]


class LoadError(RuntimeError):
    """Files that could not be loaded; everything else of the load is stored."""


@dataclass
class LoadResult:
    name: str
    batches: int = 0
    input_rows: int = 0
    superseded: int = 0
    rejected: int = 0
    issues: list[str] = field(default_factory=list)


@dataclass
class Taken:
    """What a batch did: issues found, sound subjects, days stored by file name."""
    issues: list[Issue] = field(default_factory=list)
    sound: set[str] = field(default_factory=set)
    days: dict[str, list[dt.date]] = field(default_factory=dict)


class Load:
    """The load of one table: steps over file versions, each recorded once it is stored."""

    def __init__(self, spark: SparkSession, folder: str, glob: str, table_path: str, max_files: int | None, name: str):
        self.spark, self.folder, self.glob, self.table_path = spark, folder, glob, table_path.rstrip("/")
        self.max_files = max_files or MAX_FILES
        self.ledger = Ledger(spark, table_path)
        self.result = LoadResult(f"{name}_{uuid.uuid4().hex[:8]}")

    def take(self, versions: list[Version], tag: str) -> Taken:
        raise NotImplementedError

    def step(self, versions: list[Version], tag: str) -> None:
        if versions:
            self.result.batches += 1
            self.commit(self.take(versions, tag), versions)

    def commit(self, taken: Taken, versions: list[Version]) -> None:
        self.ledger.settle(taken.issues, taken.sound, self.result.name)
        self.ledger.record(versions, self.result.name, taken.days)
        self.result.issues += [str(i) for i in taken.issues]

    def start(self, checkpoint: str):
        """The running query over the names of new files; it does not read contents."""
        def write_batch(batch: DataFrame, epoch_id: int) -> None:
            found = [Version(r["path"], r["modificationTime"], r["length"]) for r in batch.collect()]  # at most max_files
            self.step(sorted(found, key=lambda v: v.path), f"{self.result.name}_{epoch_id}")

        files = (self.spark.readStream.format("binaryFile").option("pathGlobFilter", self.glob)
                     .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
                     .option("maxFilesPerTrigger", self.max_files).load(self.folder).select("path", "modificationTime", "length"))
        return (files.writeStream.queryName(self.result.name).trigger(availableNow=True)
                     .option("checkpointLocation", checkpoint).foreachBatch(write_batch).start())

    def finish(self) -> None:
        """Versions that the stream passed over: files that landed again under their names."""
        while versions := self.ledger.pending(self.folder, self.glob, self.max_files):
            self.step(versions, f"{self.result.name}_again_{uuid.uuid4().hex[:8]}")
        if blank := self.ledger.blank(self.folder, self.glob):
            self.commit(Taken([Issue(self.subject(v), v.path, "holds no rows") for v in blank]), blank)

    @staticmethod
    def subject(v: Version) -> str:
        """What an issue with a file is about."""
        return v.path

    def quarantine(self, rows: DataFrame, kind: str, tag: str) -> int:
        """Store rejected rows beside the table; a replayed batch replaces its own."""
        rows = rows.where(F.col("reason").isNotNull())
        n = rows.count()
        if n:
            rows.write.mode("overwrite").json(f"{self.table_path}_rejects/{kind}_{tag}")
        return n


class DelayLoad(Load):
    def take(self, versions: list[Version], tag: str) -> Taken:
        unfit: dict[str, str] = {}
        text = read_delay_text(self.spark, [v.path for v in versions], unfit=unfit)
        start, end = week_bounds(F.col("_file"))
        text = text.withColumn("_start", start).withColumn("_end", end).persist()
        try:
            weeks = {r["_file"]: (r["a"], r["b"]) for r in text.groupBy("_file").agg(F.first("_start").alias("a"), F.first("_end").alias("b")).collect()}
            why = {f.rsplit("/", 1)[-1]: reason for f, reason in unfit.items()}
            newest = {self.subject(v): v for v in sorted(versions, key=lambda v: v.modified)}  # of a week's files the newest one counts
            taken = Taken()
            for subject, v in newest.items():
                if v.name not in weeks:
                    taken.issues.append(Issue(subject, v.path, why.get(v.name, "holds no rows")))
                elif None in weeks[v.name]:
                    taken.issues.append(Issue(subject, v.path, "names no week"))
                else:
                    taken.sound.add(subject)
            return self.store(text, tag, taken)
        finally:
            text.unpersist()

    @staticmethod
    def subject(v: Version) -> str:
        """A week, so that any sound file of it settles an issue; else the file."""
        week = re.search(WEEK_FILE_PATTERN, v.name)
        return f"week {week.group(1)} to {week.group(2)}" if week else v.path

    def store(self, text: DataFrame, tag: str, taken: Taken) -> Taken:
        """Type, reject and store delay rows given as text with their file, the file's
        time and its week."""
        date = F.col("date").try_cast("date")
        text = with_reject_reason(text).withColumn("reason", F.coalesce(
            "reason", F.when(F.col("_start").isNull() | F.col("_end").isNull(), "file name"),
            F.when((date < F.col("_start")) | (date > F.col("_end")), "outside the file's week")))
        sound = text.where("reason is null").select(*[F.col(c.name).try_cast(c.dataType).alias(c.name) for c in DELAYS_ALL.fields],
                                                    *NEWEST, "_start", "_end")
        stored_from = F.col("stored_from")
        current = sound.join(self.ledger.newest_of_days(), "date", "left").where(stored_from.isNull() | (F.col("_modified") >= stored_from))
        newest = newest_per_key(current.drop("stored_from"), DELAY_KEY, NEWEST).persist()
        try:
            total, kept = text.count(), newest.count()
            rejected = self.quarantine(text, "delays", tag)
            self.result.input_rows += total
            self.result.rejected += rejected
            self.result.superseded += total - rejected - kept
            lost = lost_keys(newest, self.table_path, self.spark)
            if lost is not None:
                lost = lost.groupBy("date").agg(F.min("station_name").alias("name")).orderBy("date").collect()  # a row per day
            for r in lost or []:
                taken.issues.append(Issue(f"day {r['date']}", None, f"the batch lacks {r['name']} on {r['date']}, which {self.table_path} holds"))
            whole = newest
            if lost:
                partial = F.col("date").isin([r["date"] for r in lost])
                self.result.rejected += self.quarantine(newest.where(partial).withColumn("reason", F.lit("partial day")), "partial", tag)
                whole = newest.where(~partial)
            append_days(whole.select(*DELAYS_ALL.fieldNames()), self.table_path, DELAYS_ALL)
            for r in whole.groupBy("_file").agg(F.collect_set("date").alias("days")).collect():  # a row per file
                taken.days[r["_file"]] = sorted(r["days"])
                taken.sound |= {f"day {d}" for d in r["days"]}
            return taken
        finally:
            newest.unpersist()

    def finish(self) -> None:
        super().finish()
        if self.result.batches:
            self.replay("partial")

    def replay(self, kind: str) -> int:
        """Try rejected rows of a kind (``partial``: days, ``delays``: single rows) again, all
        together; what still does not fit is rejected anew. Returns the rows tried."""
        schema = T.StructType([*[T.StructField(c, T.StringType()) for c in [*DELAYS_ALL.fieldNames(), "_file", "_start", "_end"]],
                               T.StructField("_modified", T.TimestampType())])
        try:
            rows = self.spark.read.schema(schema).json(f"{self.table_path}_rejects/{kind}_*")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return 0
            raise
        rows = rows.select("*", F.regexp_extract("_metadata.file_path", "^(.*)/", 1).alias("_folder")).persist()
        before = replace(self.result, issues=list(self.result.issues))
        try:
            n, folders = rows.count(), [r["_folder"] for r in rows.select("_folder").distinct().collect()]
            text = rows.withColumn("_start", F.col("_start").cast("date")).withColumn("_end", F.col("_end").cast("date")).drop("_folder")
            taken = self.store(text, f"replay_{uuid.uuid4().hex[:8]}", Taken())
            # Their rows and issues were counted when they were read.
            for c in ("input_rows", "rejected", "superseded"):
                setattr(self.result, c, getattr(before, c))
            known = {r["subject"] for r in self.ledger.open_issues().select("subject").collect()}
            taken.issues = [i for i in taken.issues if i.subject not in known]
            files = self.ledger.files().groupBy("path").agg(F.max(F.struct("modified", "length")).alias("last")).collect() if taken.days else []
            versions = [Version(r["path"], r["last"]["modified"], r["last"]["length"]) for r in files]
            self.commit(taken, [v for v in versions if v.name in taken.days])
            # A day that was stored is no issue of this run any more.
            self.result.issues = [i for i in self.result.issues if not any(s.startswith("day ") and f" on {s[4:]}," in i for s in taken.sound)]
            for folder in folders:  # their rows are stored or rejected again
                delete_folder(self.spark, folder)
            return n
        finally:
            rows.unpersist()


class WeatherLoad(Load):
    def __init__(self, *args, strict: bool = False, region_ids: Iterable[int] = range(8)):
        super().__init__(*args)
        self.strict, self.region_ids = strict, list(region_ids)

    def take(self, versions: list[Version], tag: str) -> Taken:
        taken = Taken()
        read = read_weather_responses(self.spark, [v.path for v in versions], keep_corrupt=True).persist()
        try:
            known = F.col("region_id").isin(*self.region_ids)
            reason = F.when(F.col(CORRUPT).isNotNull() | F.col("daily").isNull(), "malformed document") \
                .when(unequal_arrays(), "daily arrays of unequal length") \
                .when(~F.coalesce(known, F.lit(False)), "region of the file name")
            documents = read.withColumn("reason", reason)
            days = flatten_responses(documents.where("reason is null"), extra=("_file", "_modified"))
            typed = enforce_weather_schema(days, extra=("_file", "_modified")).persist()
            sound = typed.where("date is not null")
            stored = {r["_file"]: sorted(r["days"]) for r in sound.groupBy("_file").agg(F.collect_set("date").alias("days")).collect()}
            loaded = {r["_file"] for r in typed.select("_file").distinct().collect()}
            reasons = {r["_file"]: r["reason"] for r in documents.select("_file", "reason").collect()}  # a row per file
            for v in versions:
                why = reasons.get(v.name, "malformed document") or (None if v.name in loaded else "holds no rows")
                if why:
                    taken.issues.append(Issue(self.subject(v), v.path, why))
                else:
                    taken.sound.add(self.subject(v))
                    taken.days[v.name] = stored.get(v.name, [])
            newest = newest_per_key(sound, WEATHER_KEY, NEWEST).drop(*NEWEST)
            total, dated = typed.count(), sound.count()
            rejected = self.quarantine(typed.withColumn("reason", F.when(F.col("date").isNull(), "date")), "weather", tag)
            self.quarantine(documents, "documents", tag)
            kept = merge_days(with_flags(newest, self.strict), self.table_path, WEATHER_ALL, WEATHER_KEY)
            self.result.input_rows += len(versions)
            self.result.rejected += rejected
            self.result.superseded += dated - kept
            assert total == dated + rejected
            typed.unpersist()
            return taken
        finally:
            read.unpersist()


def start_delay_load(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                     max_files: int | None = None):
    """Start the delay load (returns the running query and the load)."""
    load = DelayLoad(spark, landing, WEEK_FILE_GLOB, table_path, max_files, "delay_load")
    return load.start(checkpoint), load


def start_weather_load(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                       max_files: int | None = None, strict: bool = False, region_ids: Iterable[int] = range(8)):
    """Start the weather load (returns the running query and the load).
    ``strict`` fails on a NULL measurement; a file whose region is not one of
    ``region_ids`` (those of the region configuration) is not loaded."""
    load = WeatherLoad(spark, landing, "*.json", table_path, max_files, "weather_load", strict=strict, region_ids=region_ids)
    return load.start(checkpoint), load


def initial_load(spark: SparkSession, csv_path: str, table_path: str) -> int:
    """Batch entry point: load a whole delay CSV (e.g. the initial history); per
    (date, station) the newest file's row counts, unreadable rows fail the load."""
    text = with_reject_reason(read_delay_text(spark, csv_path))
    bad = F.raise_error(F.concat(F.lit("unreadable "), F.col("reason"), F.lit(" in "), F.col("_file")))
    rows = text.select(*[F.when(F.col("reason").isNull(), F.col(c.name).try_cast(c.dataType)).otherwise(bad.cast(c.dataType)).alias(c.name)
                         for c in DELAYS_ALL.fields], *NEWEST)
    rows = newest_per_key(rows, DELAY_KEY, NEWEST)
    n = append_days(rows.drop(*NEWEST), table_path, DELAYS_ALL)
    days = {r["_file"]: sorted(r["days"]) for r in rows.groupBy("_file").agg(F.collect_set("date").alias("days")).collect()}  # a row per file
    versions = [Version(*r) for r in listing(spark, csv_path, "*").collect()]
    Ledger(spark, table_path).record([v for v in versions if v.name in days], f"initial_{uuid.uuid4().hex[:8]}", days)
    return n


def _await(loads: list) -> list[LoadResult]:
    """Wait for every load. The first failed query stops the others and is raised;
    files that could not be loaded are raised once all queries have ended."""
    error = None
    for q, _ in loads:
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001 - re-raised below
            error = error or e
            for other, _ in loads:
                if other.isActive:
                    other.stop()
    if error is not None:
        raise error
    for _, load in loads:
        load.finish()
    issues = [i for _, load in loads for i in load.result.issues]
    if issues:
        raise LoadError("; ".join(issues))
    return [load.result for _, load in loads]


def load_delays(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                max_files: int | None = None) -> LoadResult:
    return _await([start_delay_load(spark, landing, table_path, checkpoint, max_files)])[0]


def load_weather(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                 max_files: int | None = None, strict: bool = False, region_ids: Iterable[int] = range(8)) -> LoadResult:
    return _await([start_weather_load(spark, landing, table_path, checkpoint, max_files, strict, region_ids)])[0]


def replay_rejects(spark: SparkSession, landing: str, table_path: str, kind: str = "delays") -> int:
    """Try the rejected delay rows of a kind again, e.g. after a correction of the
    rules that rejected them. Returns the rows tried."""
    return DelayLoad(spark, landing, WEEK_FILE_GLOB, table_path, None, "replay").replay(kind)


def require_settled(ledgers: list[Ledger]) -> None:
    """Fail while an issue of any load is open."""
    waiting = [f"{r['subject']}: {r['reason']}" for x in ledgers for r in x.open_issues().orderBy("subject").collect()]
    if waiting:
        raise LoadError("open issues: " + "; ".join(waiting))


@dataclass
class RefreshPaths:
    delay_landing: str
    weather_landing: str
    delays_table: str
    weather_table: str
    stations_table: str
    checkpoints: str
    results: str
    regions_table: str | None = None  # the stored region configuration; None: region ids 0 to 7
    unified_table: str | None = None  # None: beside the checkpoints


def refresh(spark: SparkSession, p: RefreshPaths, min_trains: int = 10, max_files: int | None = None,
            strict: bool = False) -> DataFrame:
    """The weekly refresh: both loads side by side (independent sinks), the key
    checks the joins rely on, the changed days of the stored unified table, then the KPI
    tables from it and the quality reports. A failed load, an issue that is still
    open from an earlier one, or a key that is not
    unique stops the refresh before the KPIs are touched. Returns a small summary
    table."""
    ck = p.checkpoints.rstrip("/")
    unified_path = p.unified_table or f"{ck}/unified_all"
    regions = range(8)
    if p.regions_table:
        regions = sorted(r["region_id"] for r in spark.read.parquet(p.regions_table).select("region_id").collect())  # the configuration
    loads = _await([
        start_delay_load(spark, p.delay_landing, p.delays_table, f"{ck}/delays", max_files),
        start_weather_load(spark, p.weather_landing, p.weather_table, f"{ck}/weather", max_files, strict, regions),
    ])
    ledgers = [Ledger(spark, p.delays_table), Ledger(spark, p.weather_table)]
    require_settled(ledgers)
    stations = spark.read.parquet(p.stations_table).select(*STATIONS_REGIONS.fieldNames())
    stations = Q.require_unique(Q.require_unique(stations, ["station_id"], "stations_regions"), ["station_name"], "stations_regions")
    entries, days, mark = changes(spark, unified_path, ledgers, stations)
    require_unique_days(spark, p.delays_table, DELAYS_ALL, DELAY_KEY, days)
    require_unique_days(spark, p.weather_table, WEATHER_ALL, WEATHER_KEY, days)
    delays, weather = read_table(spark, p.delays_table, DELAYS_ALL), read_table(spark, p.weather_table, WEATHER_ALL)
    rewritten = update_unified(spark, unified_path, delays, stations, weather, days)
    applied(spark, unified_path, entries, mark)
    out = p.results.rstrip("/")
    unified = read_table(spark, unified_path, UNIFIED_ALL)
    rows = [(name, "kpi_rows", n) for name, n in kpi_tables(spark, unified, out, min_trains).items()]
    rows += [("unified", "rows_rewritten", rewritten), ("unified", "days_changed", -1 if days is None else len(days))]
    for r in loads:
        rows += [(r.name, m, getattr(r, m)) for m in ("input_rows", "batches", "superseded", "rejected")]
    # The weather must cover the week of the newest delay file, for every region.
    week = newest_week_file(spark, p.delay_landing)
    rows.append(("weather", "missing_cells_newest_week", Q.weather_gaps(weather, week, regions).count()))
    rows.append(("stations", "unmatched_names", Q.unmatched_stations(delays, stations).count()))
    report = Q.dq_stations(stations).first()
    rows += [("stations", c, report[c]) for c in report.asDict()]
    return spark.createDataFrame(rows, "step STRING, metric STRING, value BIGINT")


def kpi_tables(spark: SparkSession, stored: DataFrame, out: str, min_trains: int = 10) -> dict[str, int]:
    """Write every KPI table from the stored unified table; returns the rows of each."""
    median = K.kpi_median_exact(stored)
    score = K.kpi_delay_score(stored, min_trains=min_trains)
    tables = {
        "kpi_median": K.order_kpi_median(median),
        "weather_effect": K.weather_effect(median),
        "kpi_delay_score": score,
        "worst_region_share": K.region_share(score),
        "kpi_delay_score_as_written": K.kpi_delay_score_as_written(stored),
        "kpi_resilience": K.kpi_resilience(stored),
        "kpi_resilience_fixed": K.kpi_resilience(stored, threshold=5.0),
    }
    for name, df in tables.items():
        write_result(df, f"{out}/{name}")
    return {name: spark.read.parquet(f"{out}/{name}").count() for name in tables}


def write_kpis(spark: SparkSession, unified: DataFrame, out: str, min_trains: int = 10) -> dict[str, int]:
    """The KPI tables of a unified table that is not stored: it is, once, in the
    shared folder, so that its joins run once."""
    path = scratch_path(spark, "unified_all")
    try:
        unified.write.parquet(path)
        return kpi_tables(spark, spark.read.schema(unified.schema).parquet(path), out, min_trains)
    finally:
        drop_scratch(spark, path)
