"""Partitioned log stores and catalog tables: pruned date scans and the choice of dates for a run."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITIONS = ["year", "month", "day"]

# The columns of the catalog query, besides the day and the time of a record.
TABLE_COLUMNS = [
    "service_name",
    "endpoint",
    "method",
    "status_code",
    "latency_ms",
    "bytes_response",
    "user_id",
    "instance_id",
]


def _day() -> Column:
    return F.make_date("year", "month", "day")


def read_store(
    spark: SparkSession,
    root: str,
    schema: T.StructType | None = None,
    columns: list[str] | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """A ``year=/month=/day=`` Parquet store; partition columns are integers.

    An unreadable file is an error; with ``tolerant`` it is left out, and ``skipped_files`` names it. Files
    with other columns are matched by name.
    """
    reader = spark.read.option("ignoreCorruptFiles", str(tolerant).lower())
    reader = reader.option("pathGlobFilter", "*.parquet")
    reader = reader.schema(_with_partitions(schema)) if schema else reader.option("mergeSchema", "true")
    table = reader.parquet(root)
    return table.select(*columns, *PARTITIONS) if columns else table


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, bytes)`` and partition columns of the store's files, from the listing alone: one row for each file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    rest = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    return files.select("path", F.col("length").alias("bytes"), *rest)


def skipped_files(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """``(path, bytes)`` of the files that a tolerant read gets no row from: unreadable ones, and empty ones."""
    plain = lambda c: F.regexp_replace(F.regexp_replace(c, "^[a-z]+:/+", "/"), "%20", " ")
    # rows without data columns: only the files' footers are read
    seen = read_store(spark, root, schema, tolerant=True).select(plain(F.col("_metadata.file_path")).alias("seen")).distinct()
    files = listed_files(spark, root).select("path", "bytes")
    return files.join(seen, plain(F.col("path")) == F.col("seen"), "left_anti")


def _with_partitions(schema: T.StructType) -> T.StructType:
    fields = [f for f in schema.fields if f.name not in PARTITIONS]
    return T.StructType(fields + [T.StructField(p, T.IntegerType()) for p in PARTITIONS])


def scan_date_range(
    spark: SparkSession,
    root: str,
    start: str,
    end: str,
    schema: T.StructType | None = None,
    columns: list[str] | None = None,
    tolerant: bool = False,
) -> DataFrame:
    """Rows of the days from ``start`` to ``end``, both included; other partitions are not opened.

    A store with no files gives an empty frame of ``schema``.
    """
    first, last = F.lit(date.fromisoformat(start)), F.lit(date.fromisoformat(end))
    try:
        store = read_store(spark, root, schema, columns, tolerant)
    except AnalysisException:
        if schema is None:
            raise
        empty = spark.createDataFrame([], schema)
        return empty.select(*columns) if columns else empty
    return store.where(_day().between(first, last)).drop(*PARTITIONS)


def scan_table(
    spark: SparkSession, table: str, start: str, end: str, time: str = "timestamp", day: str = "dt"
) -> DataFrame:
    """Log columns of a catalog table by its date partition, with the time of each record.

    A table that has only days is refused: hours, and copies of a record, cannot be told from days.
    """
    source = spark.table(table)
    if time not in source.columns:
        raise ValueError(f"{table} has no time column {time!r}; a date partition is no time of a record")
    names = [c for c in TABLE_COLUMNS if c in source.columns]
    return source.where(F.col(day).between(start, end)).select(day, F.col(time).alias("timestamp"), *names)


def query_table_by_date(
    spark: SparkSession, table: str, start: str, end: str, time: str = "timestamp", day: str = "dt"
) -> DataFrame:
    """The scan as a query result, in the order of days."""
    return scan_table(spark, table, start, end, time, day).orderBy(day)


def table_files(spark: SparkSession, table: str) -> DataFrame | None:
    """Listed files of a catalog table stored in Parquet files, with its partition columns; None for views."""
    if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).tableType in ("TEMPORARY", "VIEW"):
        return None
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return listed_files(spark, rows[0]["data_type"]) if rows else None


def choose_window(
    last_run: str | None,
    lookback_days: int = 30,
    incremental: bool = True,
    force: bool = False,
    today: date | None = None,
) -> tuple[str, str]:
    """First and last day to read.

    A run may happen before its last day is over, so that day is read again: the rest of it would
    otherwise be lost. Records seen twice fall to de-duplication or to the overwrite of whole days.
    """
    today = today or datetime.now(tz=timezone.utc).date()
    if incremental and not force and last_run:
        return str(min(date.fromisoformat(last_run[:10]), today)), str(today)
    return str(today - timedelta(days=lookback_days)), str(today)


def run_windows(
    last_run: Column, today: Column, lookback_days: int = 30, incremental: bool = True, force: bool = False
) -> Column:
    """As ``choose_window``, for a table of runs: a struct of the first and last day as texts."""
    back = F.date_sub(today, lookback_days)
    last = F.substring(last_run, 1, 10).cast("date")
    start = F.when(last.isNotNull(), F.least(last, today)).otherwise(back) if incremental and not force else back
    return F.struct(start.cast("string").alias("start"), today.cast("string").alias("end"))


RUN_STATE = "last_run_date string, last_run_at timestamp"


def last_run_date(spark: SparkSession, path: str) -> str | None:
    """Last day covered by a finished run, from the run-state table."""
    try:
        return spark.read.schema(RUN_STATE).parquet(path).agg(F.max("last_run_date")).first()[0]
    except AnalysisException:
        return None


def record_run(spark: SparkSession, path: str, end: str) -> None:
    """Append one row; called when everything else of the run is written."""
    row = spark.range(1).select(F.lit(end).alias("last_run_date"), F.current_timestamp().alias("last_run_at"))
    row.coalesce(1).write.mode("append").parquet(path)
