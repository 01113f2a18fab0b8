"""Unusual services and unusual hours by standard scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logtide.functions.scores import largest, z_value
from logtide.operators.scaling import largest_z, scale_scores, standardize

# The columns that are scored, the cuts and the least amount of data.
SERVICE_SCORED = ["requests_per_hour", "error_rate", "latency_p95", "peak_to_avg_ratio"]
WINDOW_SCORED = ["request_count", "error_rate", "latency_p50", "latency_p95"]
WINDOW_CUT = 3.0
WINDOW_MIN_ROWS = 24
SERVICE_CUT = 2.5
SERVICE_MIN_ROWS = 10


def window_anomalies(
    series: DataFrame,
    key: str = "service_name",
    columns: list[str] | None = None,
    cut: float = WINDOW_CUT,
    min_rows: int = WINDOW_MIN_ROWS,
) -> DataFrame:
    """Score every bucket against its own service's series by the largest standard score.

    A group is one service's buckets, so its size is bounded by the time span, not by traffic.
    Services with fewer than ``min_rows`` buckets are left out.
    """
    columns = [c for c in (columns or WINDOW_SCORED) if c in series.columns]
    whole = Window.partitionBy(key)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    # the moments are columns of their own, so each is computed once
    stats = {f"_mean_{c}": F.avg(v).over(whole) for c, v in filled.items()}
    stats |= {f"_std_{c}": F.stddev_pop(v).over(whole) for c, v in filled.items()}
    stats["_rows"] = F.count(F.lit(1)).over(whole)
    score = largest(
        [F.abs(z_value(v, F.col(f"_mean_{c}"), F.col(f"_std_{c}"))) for c, v in filled.items()]
    )
    return (
        series.withColumns(stats)
        .where(F.col("_rows") >= min_rows)
        .withColumn("anomaly_score", F.bround(score, 4))
        .withColumn("is_anomaly", F.col("anomaly_score") > cut)
        .drop(*stats)
    )


def service_anomalies_zscore(
    features: DataFrame,
    columns: list[str] | None = None,
    cut: float = SERVICE_CUT,
    min_rows: int = SERVICE_MIN_ROWS,
) -> DataFrame:
    """Score every service by its largest standard score, then scale scores to [0, 1].

    With fewer than ``min_rows`` services all scores are 0 and nothing is flagged.
    """
    columns = [c for c in (columns or SERVICE_SCORED) if c in features.columns]
    enough = features.agg(F.count(F.lit(1)) >= min_rows).scalar()
    scored = standardize(features, columns).withColumn("_raw", largest_z(columns))
    scaled = scale_scores(scored, "_raw").withColumn("_enough", enough)
    return scaled.withColumns(
        {
            "anomaly_score": F.when(F.col("_enough"), F.col("anomaly_score")).otherwise(0.0),
            "is_anomaly": F.col("_enough") & (F.col("_raw") > cut),
        }
    ).select(*features.columns, "anomaly_score", "is_anomaly")


def top_anomalies(
    scored: DataFrame, n: int = 10, tie_breakers: list[str] | None = None
) -> DataFrame:
    """The ``n`` highest flagged scores; ties by key."""
    ties = tie_breakers or [c for c in ("service_name", "time_bucket") if c in scored.columns]
    return scored.where("is_anomaly").orderBy(F.desc("anomaly_score"), *ties).limit(n)
