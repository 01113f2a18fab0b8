"""Per-service features, the gap-free hourly series, calendar columns and growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from logtide.functions.scores import share
from logtide.functions.times import bucket_start, hours_between, monday_based_weekday
from logtide.operators.percentiles import approx_percentiles, exact_percentiles

SERVICE_PERCENTILES = {"latency_p50": 0.50, "latency_p95": 0.95, "latency_p99": 0.99}
HOURLY_PERCENTILES = {"latency_p50": 0.50, "latency_p95": 0.95}


def _rate(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def _with_percentiles(left: DataFrame, right: DataFrame, keys: list[str], names) -> DataFrame:
    """Left join; a group without any value gets 0."""
    joined = left.join(right, keys, "left")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(0.0)) for n in names})


def request_span(
    logs: DataFrame, key: str = "service_name", time: str = "timestamp"
) -> DataFrame:
    """Active hours (at least 1) and requests per hour."""
    return (
        logs.groupBy(key)
        .agg(F.count(F.lit(1)).alias("total_requests"), _active_hours(time).alias("active_hours"))
        .withColumn("requests_per_hour", F.col("total_requests") / F.col("active_hours"))
    )


def _active_hours(time: str) -> Column:
    return F.greatest(hours_between(F.min(time), F.max(time)), F.lit(1.0))


def peak_ratio(
    logs: DataFrame, key: str = "service_name", time: str = "timestamp", freq: str = "1 hour"
) -> DataFrame:
    """Busiest bucket over the mean of the buckets that have any traffic."""
    counts = (
        logs.select(key, bucket_start(F.col(time), freq).alias("_bucket"))
        .groupBy(key, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.groupBy(key).agg((F.max("_n") / F.avg("_n")).alias("peak_to_avg_ratio"))


def service_features(
    logs: DataFrame, key: str = "service_name", time: str = "timestamp", exact: bool = True
) -> DataFrame:
    """One row per service. ``logs`` is read several times with few columns: pass a stored table.

    ``exact=False`` uses sketches for percentiles and distinct counts, all in one pass.
    """
    distinct = {"unique_users": "user_id", "unique_endpoints": "endpoint", "unique_instances": "instance_id"}
    counter = F.count_distinct if exact else F.approx_count_distinct
    basics = [
        F.count("status_code").alias("total_requests"),
        _rate(F.col("status_code") >= 400).alias("error_rate"),
        _rate(F.col("status_code") >= 500).alias("server_error_rate"),
        F.coalesce(F.avg("bytes_response"), F.lit(0.0)).alias("avg_bytes"),
        *[counter(F.col(c)).alias(name) for name, c in distinct.items()],
        _active_hours(time).alias("active_hours"),
    ]
    if exact:
        table = _with_percentiles(
            logs.groupBy(key).agg(*basics),
            exact_percentiles(logs, [key], "latency_ms", SERVICE_PERCENTILES),
            [key],
            SERVICE_PERCENTILES,
        )
    else:
        table = logs.groupBy(key).agg(*basics, *approx_percentiles("latency_ms", SERVICE_PERCENTILES))
    table = table.withColumn("requests_per_hour", F.col("total_requests") / F.col("active_hours"))
    return table.join(peak_ratio(logs, key, time), key, "left").select(
        key,
        "total_requests",
        "error_rate",
        "server_error_rate",
        *SERVICE_PERCENTILES,
        "avg_bytes",
        *distinct,
        "active_hours",
        "requests_per_hour",
        "peak_to_avg_ratio",
    )


def hourly_traffic(
    logs: DataFrame,
    key: str = "service_name",
    time: str = "timestamp",
    freq: str = "1 hour",
    exact: bool = True,
) -> DataFrame:
    """One row per service and non-empty time bucket of length ``freq``."""
    bucketed = logs.withColumn("time_bucket", bucket_start(F.col(time), freq))
    keys = [key, "time_bucket"]
    counter = F.count_distinct if exact else F.approx_count_distinct
    basics = [
        F.count("status_code").alias("request_count"),
        _rate(F.col("status_code") >= 400).alias("error_rate"),
        F.coalesce(F.sum("bytes_response"), F.lit(0.0)).alias("bytes_total"),
        counter(F.col("user_id")).alias("unique_users"),
    ]
    if exact:
        table = _with_percentiles(
            bucketed.groupBy(*keys).agg(*basics),
            exact_percentiles(bucketed, keys, "latency_ms", HOURLY_PERCENTILES),
            keys,
            HOURLY_PERCENTILES,
        )
    else:
        table = bucketed.groupBy(*keys).agg(*basics, *approx_percentiles("latency_ms", HOURLY_PERCENTILES))
    return table.select(
        *keys, "request_count", "error_rate", *HOURLY_PERCENTILES, "bytes_total", "unique_users"
    )


def _extent(table: DataFrame, bucket: str) -> Column:
    """First and last bucket of the whole table as a scalar subquery."""
    return table.agg(F.struct(F.min(bucket).alias("first"), F.max(bucket).alias("last"))).scalar()


def dense_grid(
    hourly: DataFrame,
    key: str = "service_name",
    bucket: str = "time_bucket",
    freq: str = "1 hour",
) -> DataFrame:
    """Every key × every bucket between the table's first and last; new rows hold 0 everywhere.

    Each row is followed by the empty buckets up to the next row of its key, so one shuffle on the key
    does it: no key × bucket product is built and joined. ``hourly`` is read twice.
    """
    step = F.expr(f"INTERVAL {freq}")
    by_key = Window.partitionBy(key).orderBy(bucket)
    extent = F.col("_extent")
    following = F.lead(bucket).over(by_key)
    starts = F.when(F.row_number().over(by_key) == 1, extent["first"]).otherwise(F.col(bucket))
    stops = F.coalesce(following - step, extent["last"])
    filled = (
        hourly.withColumn("_extent", _extent(hourly, bucket))
        .withColumns({"_start": starts, "_stop": stops})
        .withColumn("_slot", F.explode(F.sequence("_start", "_stop", step)))
    )
    here = F.col("_slot") == F.col(bucket)
    measures = [f for f in hourly.schema.fields if f.name not in (key, bucket)]
    return filled.select(
        key,
        F.col("_slot").alias(bucket),
        *[
            F.when(here, F.col(f.name)).otherwise(F.lit(0).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, T.NumericType)
            else F.when(here, F.col(f.name)).alias(f.name)
            for f in measures
        ],
    )


def calendar_features(series: DataFrame, bucket: str = "time_bucket") -> DataFrame:
    """Hour, Monday-based weekday, weekend and office-hour marks, ISO week."""
    time = F.col(bucket)
    weekday, hour = monday_based_weekday(time), F.hour(time)
    return series.withColumns(
        {
            "hour_of_day": hour,
            "day_of_week": weekday,
            "is_weekend": weekday.isin(5, 6).cast("int"),
            "is_business_hours": hour.between(9, 17).cast("int"),
            "week_of_year": F.weekofyear(time),
        }
    )


def timeseries_features(logs: DataFrame, freq: str = "1 hour", exact: bool = True) -> DataFrame:
    """Hourly aggregate, gap-free grid and calendar columns in one go."""
    return calendar_features(dense_grid(hourly_traffic(logs, freq=freq, exact=exact), freq=freq))


def growth_rates(
    hourly: DataFrame,
    window_days: int = 7,
    key: str = "service_name",
    bucket: str = "time_bucket",
    measure: str = "request_count",
) -> DataFrame:
    """Sum of the last ``window_days`` against the same span before, per key.

    Works on the sparse table: empty buckets add nothing, and on the gap-free grid all keys share the
    same last bucket. No key is reported unless the table spans both windows.
    """
    hours = window_days * 24
    extent = F.col("_extent")
    age = hours_between(F.col(bucket), extent["last"])
    spanned = hours_between(extent["first"], extent["last"]) + 1 >= 2 * hours
    recent, prior = F.col("recent_requests"), F.col("prior_requests")
    pct = (recent - prior) / prior * 100
    return (
        hourly.select(key, bucket, measure)
        .withColumn("_extent", _extent(hourly, bucket))
        .where(spanned & (age < 2 * hours))
        .groupBy(key)
        .agg(
            F.sum(F.when(age < hours, F.col(measure)).otherwise(0)).alias("recent_requests"),
            F.sum(F.when(age >= hours, F.col(measure)).otherwise(0)).alias("prior_requests"),
        )
        .where(prior > 0)
        .withColumn("growth_rate_pct", F.bround(pct, 2))
        .orderBy(F.desc("growth_rate_pct"), key)
    )


def weekend_share(
    series: DataFrame, key: str = "service_name", measure: str = "request_count"
) -> DataFrame:
    """Weekend requests over all requests; 0 without any. Needs no empty buckets."""
    weekend = F.sum(F.when(F.col("is_weekend") == 1, F.col(measure)).otherwise(0))
    return series.groupBy(key).agg(share(weekend, F.sum(measure)).alias("weekend_share"))
