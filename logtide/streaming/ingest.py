"""Incremental ingest: new files become normalised rows exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.operators.normalize import DEDUPE_KEYS, normalize_rows
from logtide.sinks.writers import with_day_partitions
from logtide.sources.access_logs import PARTITIONS

BATCH = "batch_id"
STORE_LAYOUT = [*PARTITIONS, BATCH]
HOURLY_MEASURES = ["request_count", "error_rate", "latency_p50", "latency_p95", "bytes_total", "unique_users"]
#: Distinct users of a window are counted exactly up to two to this power.
USERS_LOG2 = 12


def read_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """A stream over the files of a folder. The checkpoint of the query knows which were read.

    What is new is decided by the file, not by its name, so a late file with an earlier name is read.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(source)


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, name: str = "ingest"
) -> None:
    """Process everything that is there, then stop; a failed batch is handed over again as a whole."""
    query = (
        stream.writeStream.queryName(name)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def write_batch(rows: DataFrame, batch: int, store: str) -> None:
    """Write one batch below its days; a replay replaces the same partitions."""
    tagged = with_day_partitions(rows).withColumn(BATCH, F.lit(batch).cast("long"))
    (
        tagged.hint("rebalance", *[F.col(p) for p in PARTITIONS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*STORE_LAYOUT)
        .parquet(store)
    )


def ingest_logs(raw_stream: DataFrame, store: str, checkpoint: str, time_unit: str = "ns") -> None:
    """Normalise new raw rows into the store (duplicates stay until the store is read)."""
    rows = normalize_rows(raw_stream, time_unit)
    run_available(rows, lambda batch, n: write_batch(batch, n, store), checkpoint)


def store_schema(rows: T.StructType) -> T.StructType:
    """Columns of the store written from rows of the given schema."""
    types = {BATCH: T.LongType()}
    return T.StructType(
        list(rows.fields) + [T.StructField(p, types.get(p, T.IntegerType())) for p in STORE_LAYOUT]
    )


def stream_dedupe(
    rows: DataFrame, keys: list[str] | None = None, delay: str = "1 day", time: str = "timestamp"
) -> DataFrame:
    """First arrival per key; a key is forgotten once the watermark has passed it by.

    The state holds the keys of about ``delay`` of traffic: some 100 bytes each, so a day of 10,000 requests a
    second is near 90 GB over all partitions. Use the RocksDB state store, as ``build_session`` sets it.
    """
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys or DEDUPE_KEYS)


def _closed_windows(rows: DataFrame, delay: str | None, freq: str, key: str, time: str) -> DataFrame:
    """Measures of each tumbling window ``w``, in append mode."""
    marked = rows.withWatermark(time, delay) if delay else rows
    windowed = marked.groupBy(F.window(time, freq).alias("w"), key)
    return windowed.agg(
        F.count("status_code").alias("request_count"),
        F.avg(F.when(F.col("status_code") >= 400, 1.0).otherwise(0.0)).alias("error_rate"),
        F.coalesce(F.percentile_approx("latency_ms", 0.5), F.lit(0.0)).alias("latency_p50"),
        F.coalesce(F.percentile_approx("latency_ms", 0.95), F.lit(0.0)).alias("latency_p95"),
        F.coalesce(F.sum("bytes_response"), F.lit(0.0)).alias("bytes_total"),
        F.coalesce(F.theta_sketch_estimate(F.theta_sketch_agg("user_id", USERS_LOG2)), F.lit(0)).alias("unique_users"),
    )


def stream_hourly(
    rows: DataFrame,
    delay: str | None = "2 hours",
    freq: str = "1 hour",
    key: str = "service_name",
    time: str = "timestamp",
) -> DataFrame:
    """Tumbling roll-up for append mode: a window comes out when the watermark passes its end.

    State per window is bounded: sketches stand in for percentiles and distinct users. Percentiles are values of the window
    with a rank error of 1e-4, so exact nearest ranks below 10,000 rows; distinct users are exact up to 4,096 in a window and
    beyond that have a relative standard error of 0.016. ``rows`` from ``stream_dedupe`` carry their own watermark, which
    holds; give ``delay=None`` then. Batch and stream agree if the duplicates are removed first in both.
    """
    return _closed_windows(rows, delay, freq, key, time).select(key, F.col("w.start").alias("time_bucket"), *HOURLY_MEASURES)


def stream_closed_hours(
    rows: DataFrame, delay: str | None = "2 hours", freq: str = "1 hour", key: str = "service_name", time: str = "timestamp"
) -> DataFrame:
    """``stream_hourly`` with ``closed``, the last instant of the window, under the watermark: for stateful steps that follow."""
    windows = _closed_windows(rows, delay, freq, key, time)
    return windows.select(key, F.col("w.start").alias("time_bucket"), F.window_time("w").alias("closed"), *HOURLY_MEASURES)
