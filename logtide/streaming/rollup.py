"""Exact hourly roll-up kept up to date by recomputing the days that new rows touch, once in each run.

Distinct users and percentiles cannot be merged from partial results, and duplicates share a timestamp,
so a day is the unit: its rows are read from the store, de-duplicated, aggregated and replaced.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.operators.features import hourly_traffic
from logtide.operators.normalize import dedupe, normalize_rows
from logtide.scratch import materialize
from logtide.sinks.writers import with_day_partitions
from logtide.sources.access_logs import PARTITIONS, listed_files
from logtide.streaming.ingest import STORE_LAYOUT, run_available, store_schema, write_batch


def read_days(spark: SparkSession, store: str, rows: T.StructType, days: list) -> DataFrame:
    """Rows of some days; only their partitions are opened."""
    table = spark.read.schema(store_schema(rows)).parquet(store)
    return table.where(F.make_date("year", "month", "day").isin(days)).drop(*STORE_LAYOUT)


def refresh_days(
    spark: SparkSession,
    store: str,
    rows: T.StructType,
    days: list,
    rollup: str,
    order: list[str] | None = None,
) -> None:
    """Recompute the roll-up of the given days and replace their partitions."""
    logs = materialize(dedupe(read_days(spark, store, rows, days), order=order), "days")
    table = with_day_partitions(hourly_traffic(logs), "time_bucket")
    (
        table.hint("rebalance", *[F.col(p) for p in PARTITIONS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(rollup)
    )


MARKS = "day date, mark long, marked_at timestamp"


def changed_days(spark: SparkSession, store: str, marks: str) -> DataFrame:
    """``(day, mark)`` of the days whose files in the store are others than when the day was last refreshed.

    Only the listing is read. A file that was written again has a new name, so replays and lost
    checkpoints show as well.
    """
    day = F.make_date("year", "month", "day").alias("day")
    now = listed_files(spark, store).groupBy(day).agg(F.bit_xor(F.xxhash64("path", "bytes")).alias("mark"))
    try:
        done = spark.read.schema(MARKS).parquet(marks)
    except AnalysisException:
        return now
    last = done.groupBy("day").agg(F.max_by("mark", "marked_at").alias("last"))
    return now.join(last, "day", "left").where(~F.col("mark").eqNullSafe(F.col("last"))).drop("last")


def update_rollup(
    raw_stream: DataFrame,
    store: str,
    rollup: str,
    checkpoint: str,
    order: list[str] | None = None,
    time_unit: str = "ns",
) -> list:
    """Ingest all new raw rows, then refresh each day they touch once; returns these days.

    Safe under replay and late files: a day is marked as done only after its roll-up is written, and a run
    that died in between leaves it to the next one.
    """
    spark, marks = raw_stream.sparkSession, f"{rollup.rstrip('/')}-marks"
    rows = normalize_rows(raw_stream, time_unit)
    run_available(rows, lambda batch, number: write_batch(batch, number, store), checkpoint, "rollup")
    touched = materialize(changed_days(spark, store, marks), "touched")
    days = sorted(row["day"] for row in touched.select("day").collect())  # calendar days
    if days:
        refresh_days(spark, store, rows.schema, days, rollup, order)
        touched.withColumn("marked_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(marks)
    return days


def read_rollup(spark: SparkSession, rollup: str) -> DataFrame:
    return spark.read.parquet(rollup).drop(*PARTITIONS)
