"""Scores of new hours from stored moments, without the hours before them.

Each service's non-empty hours leave one row of moments for each day: number, mean and summed squared deviations of every
scored column. Days are merged by the pairwise formula (Chan, Golub and LeVeque, 1979). Hours without traffic count as 0 in
every column, as on the gap-free grid; how many there are follows from the span of all days, so they are never stored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logtide.functions.scores import largest, z_value
from logtide.functions.times import hours_between
from logtide.operators.anomalies import WINDOW_CUT, WINDOW_MIN_ROWS, WINDOW_SCORED


def day_moments(hourly: DataFrame, columns: list[str] | None = None, key: str = "service_name", bucket: str = "time_bucket") -> DataFrame:
    """One row for each key and day of a sparse hourly table."""
    values = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns or WINDOW_SCORED}
    return hourly.groupBy(key, F.to_date(bucket).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min(bucket).alias("first"), F.max(bucket).alias("last"),
        *[F.avg(v).alias(f"mean_{c}") for c, v in values.items()],
        *[(F.var_pop(v) * F.count(F.lit(1))).alias(f"m2_{c}") for c, v in values.items()],
    )


def store_days(hourly: DataFrame, store: str, columns: list[str] | None = None, key: str = "service_name", bucket: str = "time_bucket") -> None:
    """Replace the moments of the days that ``hourly`` holds, each of them whole."""
    moments = day_moments(hourly, columns, key, bucket)
    moments.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(store)


def read_days(spark: SparkSession, store: str, like: DataFrame) -> DataFrame:
    """The stored moments, empty before the first day."""
    try:
        return spark.read.schema(like.schema).parquet(store)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def merged_moments(days: DataFrame, columns: list[str], key: str = "service_name") -> DataFrame:
    """``(key, rows, mean_*, std_*)`` over all hours from the first to the last of the table, empty ones as 0."""
    rows = (hours_between(F.min("first"), F.max("last")) + 1).alias("rows")
    total = days.agg(rows).scalar()
    own = Window.partitionBy(key)  # one row for each day
    means = {f"_mean_{c}": F.sum(F.col("n") * F.col(f"mean_{c}")).over(own) / F.col("_rows") for c in columns}
    placed = days.withColumn("_rows", total).withColumns(means)
    out = []
    for c in columns:
        mean, apart = F.col(f"_mean_{c}"), F.col(f"mean_{c}") - F.col(f"_mean_{c}")
        empty = (F.max("_rows") - F.sum("n")) * F.max(mean) * F.max(mean)
        spread = F.sum(F.col(f"m2_{c}") + F.col("n") * apart * apart) + empty
        out += [F.max(mean).alias(f"mean_{c}"), F.sqrt(spread / F.max("_rows")).alias(f"std_{c}")]
    return placed.groupBy(key).agg(F.max("_rows").alias("rows"), *out)


def new_window_anomalies(
    hourly: DataFrame, store: str, columns: list[str] | None = None, key: str = "service_name", bucket: str = "time_bucket",
    cut: float = WINDOW_CUT, min_rows: int = WINDOW_MIN_ROWS, freq: str = "1 hour",
) -> DataFrame:
    """Scores of the hours from the first to the last of ``hourly`` (whole days), for every service seen so far.

    Equal to ``window_anomalies`` of the grid over all days, for these hours. Reads the stored moments of earlier days, one row
    for each service and day, and stores those of the new days. ``hourly`` is read twice: pass a stored table.
    """
    spark, columns = hourly.sparkSession, columns or WINDOW_SCORED
    store_days(hourly, store, columns, key, bucket)
    days = read_days(spark, store, day_moments(hourly, columns, key, bucket))
    stats = merged_moments(days, columns, key).where(F.col("rows") >= min_rows)
    span = hourly.agg(F.struct(F.min(bucket).alias("a"), F.max(bucket).alias("b"))).scalar()
    step = F.expr(f"INTERVAL {freq}")
    slots = stats.withColumn("_span", span).withColumn(bucket, F.explode(F.sequence(F.col("_span.a"), F.col("_span.b"), step))).drop("_span")
    table = slots.join(hourly.select(key, bucket, *columns), [key, bucket], "left")
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    score = largest([F.abs(z_value(v, F.col(f"mean_{c}"), F.col(f"std_{c}"))) for c, v in value.items()])
    filled = [F.coalesce(F.col(c), F.lit(0)).cast(hourly.schema[c].dataType).alias(c) for c in columns]
    return table.select(key, bucket, *filled, F.bround(score, 4).alias("anomaly_score")).withColumn(
        "is_anomaly", F.col("anomaly_score") > cut
    )
