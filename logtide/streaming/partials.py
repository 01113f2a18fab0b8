"""An exact hourly roll-up that adds up: percentiles from counts, distinct users from bitmaps.

Each batch of rows leaves three small tables per service and hour: sums, counts of each latency, and bitmaps of users. Those
of several batches are merged by adding and by OR, so an hour is brought up to date without reading its earlier rows, and
any coarser group (a day, a service) comes from the same tables. Users have dense codes, given out as they first appear,
so that their bits lie close together: 32,768 users share a bitmap of 4 kB.

A batch writes its own ``batch_id=`` folders by overwrite, codes first, so a replayed batch changes nothing. Rows are counted
as they come: leave out repeated records before (``incremental_dedupe``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.functions.times import bucket_start
from logtide.operators.features import HOURLY_PERCENTILES
from logtide.operators.numbering import numbered
from logtide.operators.percentiles import percentiles_by_rank

KEYS = ["service_name", "time_bucket"]
SUMS = "service_name string, time_bucket timestamp, rows long, requests long, errors long, bytes double"
LATENCIES = "service_name string, time_bucket timestamp, value double, c long"
USERS = "service_name string, time_bucket timestamp, bucket long, bits binary"
CODES = "user_id string, code long"


def read_part(spark: SparkSession, store: str, name: str, schema: str) -> DataFrame:
    """One of the tables over all batches, empty before the first."""
    try:
        return spark.read.schema(f"{schema}, batch_id long").parquet(f"{store}/{name}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, batch_id long")


def _write(table: DataFrame, store: str, name: str, batch: int) -> None:
    table.write.mode("overwrite").parquet(f"{store}/{name}/batch_id={batch}")


def add_codes(rows: DataFrame, store: str, batch: int) -> DataFrame:
    """``(user_id, code)`` of the batch's users; those that no earlier batch had get the next codes."""
    spark = rows.sparkSession
    users = rows.select(F.col("user_id").cast("string").alias("user_id")).where("user_id IS NOT NULL").distinct()
    known = read_part(spark, store, "codes", CODES).where(F.col("batch_id") < batch).select("user_id", "code")
    last = known.agg(F.coalesce(F.max("code"), F.lit(-1))).first()[0]
    _write(numbered(users.join(known, "user_id", "left_anti"), "code", last + 1), store, "codes", batch)
    fresh = spark.read.schema(CODES).parquet(f"{store}/codes/batch_id={batch}")
    return users.join(known.unionByName(fresh), "user_id")


def add_batch(rows: DataFrame, store: str, batch: int, freq: str = "1 hour") -> None:
    """Write the partial tables of one batch of normalised rows. ``rows`` is read a few times: pass a stored table."""
    rows = rows.withColumn("time_bucket", bucket_start(F.col("timestamp"), freq))
    codes = add_codes(rows, store, batch)
    sums = rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("status_code").alias("requests"),
        F.count(F.when(F.col("status_code") >= 400, 1)).alias("errors"),
        F.coalesce(F.sum("bytes_response"), F.lit(0.0)).cast("double").alias("bytes"),
    )
    _write(sums, store, "sums", batch)
    value = F.col("latency_ms").cast("double")
    counted = rows.select(*KEYS, value.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    _write(counted.groupBy(*KEYS, "value").agg(F.count(F.lit(1)).alias("c")), store, "latencies", batch)
    # each user of an hour once, before the join
    present = rows.select(*KEYS, F.col("user_id").cast("string").alias("user_id")).distinct().join(codes, "user_id")
    bitmaps = present.groupBy(*KEYS, F.bitmap_bucket_number("code").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits")
    )
    _write(bitmaps, store, "users", batch)


def distinct_users(spark: SparkSession, store: str, keys: list[str] = KEYS) -> DataFrame:
    """Exact numbers of distinct users by ``keys``, any of the partial tables' own: bitmaps are joined by OR, then counted."""
    joined = read_part(spark, store, "users", USERS).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return joined.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("unique_users"))


def latency_percentiles(spark: SparkSession, store: str, keys: list[str] = KEYS, quantiles: dict[str, float] | None = None) -> DataFrame:
    """Exact percentiles by ``keys`` from the counts of all batches."""
    counts = read_part(spark, store, "latencies", LATENCIES)
    values = counts.dropna(subset=keys).select(*keys, F.col("value").alias("_v"), F.col("c").alias("_w"))
    return percentiles_by_rank(values, keys, quantiles or HOURLY_PERCENTILES)


def read_partials(spark: SparkSession, store: str, keys: list[str] = KEYS) -> DataFrame:
    """The roll-up of all batches with the columns of ``hourly_traffic``."""
    sums = read_part(spark, store, "sums", SUMS).groupBy(*keys).agg(
        F.sum("requests").alias("request_count"),
        (F.sum("errors") / F.sum("rows")).alias("error_rate"),
        F.sum("bytes").alias("bytes_total"),
    )
    table = sums.join(latency_percentiles(spark, store, keys), keys, "left").join(distinct_users(spark, store, keys), keys, "left")
    return table.select(
        *keys, "request_count", "error_rate", *[F.coalesce(n, F.lit(0.0)).alias(n) for n in HOURLY_PERCENTILES],
        "bytes_total", F.coalesce("unique_users", F.lit(0)).alias("unique_users"),
    )
