"""Readers. Every text input is read as text, bound by the names in its own
header (files of one folder may order their columns differently), and typed by
an explicit projection; nothing is inferred from the data."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from railpulse.constants import (
    DELAYS_ALL, RAW_RECORDS, REGION_CONFIG, STATION_COORDS, STATION_LOOKUP, WEATHER_RESPONSE, WEEK_FILE_GLOB,
    WEEK_FILE_PATTERN,
)
from railpulse.functions.weather import parse_decimal_comma
from railpulse.operators.delays import enforce_delay_schema
from railpulse.operators.weather import regions_from_config


class MissingColumnError(ValueError):
    pass


class FileNameError(ValueError):
    pass


def header_lines(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, header): the first line of every file that has one, found in one job. Only
    lines are split, nothing is parsed; a file's lines keep their order within its
    first block."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"), "value",
        F.monotonically_increasing_id().alias("_at"))
    return lines.where((F.col("_start") == 0) & (F.trim("value") != "")).groupBy("path").agg(F.min_by("value", "_at").alias("header"))


def read_csv_by_header(spark: SparkSession, paths: str | list[str], columns: list[str], null_text: str = "",
                       glob: str | None = None, unfit: dict[str, str] | None = None) -> DataFrame:
    """CSV files as text columns ``columns``, bound by each file's header.

    Spark binds all files of one read by position, so the files, however many, are
    grouped by their header line and every group is read with its own order. Further
    columns are left out; a missing one is an error that names the file, or an entry
    of ``unfit`` (file -> reason) if that is given. Files without a line have no rows.
    ``_file`` and ``_modified`` say where a row comes from."""
    headers = header_lines(spark, paths, glob)
    orders: dict[tuple, list[str]] = {}
    # A row per distinct header line; the names of its files are what the driver hands
    # to the reader anyway.
    for r in headers.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("files")).collect():
        header = tuple(next(csv.reader([r["header"]])))
        missing = [c for c in columns if c not in header]
        if missing and unfit is None:
            raise MissingColumnError(f"{r['files'][0]} has no column {', '.join(missing)}")
        if missing:
            unfit.update({f: f"has no column {', '.join(missing)}" for f in r["files"]})
        else:
            orders.setdefault(header, []).extend(r["files"])
    parts = [spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in header]))
                 .option("header", True).option("enforceSchema", False).option("nullValue", null_text).csv(files)
                 .select(*[F.col(f"`{c}`") for c in columns], F.col("_metadata.file_name").alias("_file"),
                         F.col("_metadata.file_modification_time").alias("_modified"))
             for header, files in sorted(orders.items())]
    if not parts:
        fields = [T.StructField(c, T.StringType()) for c in [*columns, "_file"]] + [T.StructField("_modified", T.TimestampType())]
        return spark.createDataFrame([], T.StructType(fields))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_raw_records(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw train records. Parquet carries its types; CSV is read as text by
    header name and cast (bad values -> NULL)."""
    if fmt == "parquet":
        return spark.read.schema(RAW_RECORDS).parquet(path)
    raw = read_csv_by_header(spark, path, RAW_RECORDS.fieldNames())
    return raw.select(
        F.col("service_date").try_cast("date").alias("service_date"), "record_type", "origin",
        "destination", F.col("delay").try_cast("double").alias("delay"))


def read_coords(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Station coordinates (station_name, lat, lon), Parquet or CSV by header name."""
    if fmt == "parquet":
        return spark.read.schema(STATION_COORDS).parquet(path)
    raw = read_csv_by_header(spark, path, STATION_COORDS.fieldNames())
    return raw.select("station_name", *[F.col(c).try_cast("double").alias(c) for c in ("lat", "lon")])


def read_station_lookup(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Station lookup JSON: a single array of records (``multi_line``) or
    JSON lines (what Spark's own writer produces). The form is the caller's to
    say; text of the other form fails the read instead of losing rows."""
    raw = spark.read.schema(STATION_LOOKUP).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    if multi_line:  # JSON lines read as one document would keep the first line only
        head = spark.read.text(path).where(F.trim("value") != "").first()
        if head is not None and not head["value"].lstrip().startswith("["):
            raise ValueError(f"{path} is not one JSON array; read it as JSON lines")
    return raw


def read_delay_text(spark: SparkSession, paths: str | list[str], glob: str | None = None,
                    unfit: dict[str, str] | None = None) -> DataFrame:
    """Delay CSVs (weekly files or the initial history) as text, by header name,
    with ``_file`` and ``_modified``."""
    return read_csv_by_header(spark, paths, DELAYS_ALL.fieldNames(), glob=glob, unfit=unfit)


def read_delay_csv(spark: SparkSession, path: str) -> DataFrame:
    """Delay CSV: comma separated, header row, columns bound by name; NULL
    written as empty text."""
    return enforce_delay_schema(read_delay_text(spark, path)).select(*DELAYS_ALL.fieldNames())


def read_weather_initial_csv(spark: SparkSession, path: str) -> DataFrame:
    """The initial weather text: ';' separated, decimal commas, stray blanks,
    10 columns with coordinates. Bound by header name (measure columns by
    their prefix) and normalised to the weather table's 8 columns."""
    raw = spark.read.option("header", True).option("sep", ";").option("inferSchema", False).csv(path)
    cols = {c.strip(): c for c in raw.columns}

    def pick(prefix: str) -> str:
        for k, c in cols.items():
            if k.startswith(prefix):
                return c
        raise ValueError(f"no column starting with {prefix!r} in {list(cols)}")

    def as_int(c: str):
        return F.trim(F.col(f"`{c}`")).try_cast("int")

    return raw.select(
        as_int(pick("location_id")).alias("region_id"),
        F.trim(F.col(f"`{pick('time')}`")).try_cast("date").alias("date"),
        parse_decimal_comma(F.col(f"`{pick('temperature')}`")).alias("temperature_mean_c"),
        parse_decimal_comma(F.col(f"`{pick('precipitation')}`")).alias("precipitation_sum_mm"),
        parse_decimal_comma(F.col(f"`{pick('wind')}`")).alias("wind_gust_max_kmh"),
        as_int(pick("high_temp")).alias("high_temp"),
        as_int(pick("high_wind")).alias("high_wind"),
        as_int(pick("high_precip")).alias("high_precip"),
    )


STATIONS_EXPORT = T.StructType([
    T.StructField("station_name", T.StringType()),
    T.StructField("lat", T.StringType()),
    T.StructField("lon", T.StringType()),
    T.StructField("county", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("location_id", T.StringType()),
    T.StructField("station_id", T.StringType()),
])


def read_stations_csv(spark: SparkSession, path: str, null_text: str = "NA") -> DataFrame:
    """The stations export (7 columns, by header name). Its writer puts the
    text ``NA`` for a missing value, so that text reads as NULL."""
    raw = read_csv_by_header(spark, path, STATIONS_EXPORT.fieldNames(), null_text)
    return raw.select(
        "station_name",
        F.col("lat").try_cast("double").alias("latitude"),
        F.col("lon").try_cast("double").alias("longitude"),
        "county", "region",
        F.col("location_id").try_cast("int").alias("region_id"),
        F.col("station_id").try_cast("int").alias("station_id"),
    )


def read_region_config(spark: SparkSession, path: str) -> DataFrame:
    """Region configuration -> (region_id, region_name, lat, lon)."""
    return regions_from_config(spark.read.schema(REGION_CONFIG).option("multiLine", True).json(path))


REGION_FILE_PATTERN = r"region_(\d+)"


CORRUPT = "_corrupt_record"


def read_weather_responses(spark: SparkSession, paths: str | list[str], keep_corrupt: bool = False) -> DataFrame:
    """Landed weather responses, one JSON document per file; the region id
    comes from the file name (``..._region_<id>...json``). A malformed document
    fails the read; with ``keep_corrupt`` it becomes a row whose ``_corrupt_record``
    holds its text. ``_file`` and ``_modified`` say where a row comes from."""
    schema = T.StructType([*WEATHER_RESPONSE.fields, T.StructField(CORRUPT, T.StringType())]) if keep_corrupt else WEATHER_RESPONSE
    df = (spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE" if keep_corrupt else "FAILFAST")
              .option("columnNameOfCorruptRecord", CORRUPT).json(paths))
    return df.select(
        "*", F.regexp_extract(F.col("_metadata.file_name"), REGION_FILE_PATTERN, 1).try_cast("int").alias("region_id"),
        F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_modification_time").alias("_modified"))


def week_bounds(file_col) -> tuple:
    """(start, end) dates parsed from a weekly file name; NULL when the name
    does not follow the pattern."""
    start = F.nullif(F.regexp_extract(file_col, WEEK_FILE_PATTERN, 1), F.lit(""))
    end = F.nullif(F.regexp_extract(file_col, WEEK_FILE_PATTERN, 2), F.lit(""))
    return start.try_cast("date"), end.try_cast("date")


def newest_week_file(spark: SparkSession, folder: str, glob: str = WEEK_FILE_GLOB) -> DataFrame:
    """One row: the most recently modified weekly file in ``folder`` and the
    week it covers. Listing only: the file contents are never read. A newest file
    whose name does not hold a week is an error, as in the weekly load."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
                  .select("path", "modificationTime"))
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).where("path is not null")
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    start, end = week_bounds(name)
    found = newest.select("path", name.alias("file_name"), start.alias("start_date"), end.alias("end_date"))
    for r in found.where("start_date is null or end_date is null or start_date > end_date").collect():  # one row at most
        raise FileNameError(f"{r['file_name']} names no week")
    return found
