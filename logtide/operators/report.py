"""Rule-based findings: totals, leaders, alerts, capacity and cost insights, and the nested report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logtide.functions.scores import first_match, share
from logtide.operators.anomalies import top_anomalies
from logtide.operators.features import weekend_share
from logtide.operators.forecast import upper_peaks

KEY = "service_name"

# The recommendation texts of service alerts, each with the column and the cut that choose it.
ADVICE = [
    ("error_rate", 0.15, "High error rate — investigate health, dependencies, and recent deployments"),
    ("latency_p95", 2000, "High P95 latency — check DB bottlenecks, connection pools, or downstream timeouts"),
    ("requests_per_hour", 10000, "Unexpected traffic volume — verify for DDoS, runaway client, or missing rate limit"),
]
DEFAULT_TEXT = "Anomalous profile — review recent config changes and compare with baseline"

# Section and category of each cost insight, and how many services it names.
IDLE = ("aws_compute", "Idle Services", 8)
FLAT = ("aws_compute", "Over-provisioned (Flat Traffic)", 0)
SPOT = ("aws_compute", "Spot Instance Candidates", 8)
PREEMPT = ("aws_compute", "Pre-emptive Auto-Scaling", 5)
REUSE = ("architectural", "Reusability Candidates", 8)
DEPRECATE = ("architectural", "Deprecation Candidates", 8)


# ---------------------------------------------------------------- traffic summary


def report_totals(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count(F.lit(1)).alias("total_services_analysed"),
        F.coalesce(F.sum("total_requests"), F.lit(0)).alias("total_requests"),
    )


def top_services(features: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` services with the most requests; ties by name."""
    shown = [KEY, "total_requests", "requests_per_hour", "error_rate", "latency_p95", "cluster_label"]
    return (
        features.orderBy(F.desc("total_requests"), KEY)
        .limit(n)
        .select(*[c for c in shown if c in features.columns])
    )


def cluster_breakdown(clustered: DataFrame) -> DataFrame:
    return (
        clustered.groupBy("cluster_label")
        .agg(
            F.count(KEY).alias("service_count"),
            F.sum("total_requests").alias("total_requests"),
            F.avg("error_rate").alias("avg_error_rate"),
            F.avg("latency_p95").alias("avg_latency_p95"),
        )
        .orderBy(F.desc("total_requests"), "cluster_label")
    )


def fast_growing(growth: DataFrame, threshold: float = 50, n: int = 10) -> DataFrame:
    return growth.where(F.col("growth_rate_pct") > threshold).orderBy(F.desc("growth_rate_pct"), KEY).limit(n)


def declining(
    growth: DataFrame, threshold: float = -20, n: int = 10, mildest_first: bool = False
) -> DataFrame:
    """Services that lose traffic, the worst first (``mildest_first`` turns the list round)."""
    rate = F.desc("growth_rate_pct") if mildest_first else F.asc("growth_rate_pct")
    return growth.where(F.col("growth_rate_pct") < threshold).orderBy(rate, KEY).limit(n)


# ---------------------------------------------------------------- alerts


def recommendation() -> Column:
    """Advice for an unusual service; the first rule that holds decides."""
    return first_match([(F.col(column) > cut, text) for column, cut, text in ADVICE], DEFAULT_TEXT)


def service_alerts(anomalies: DataFrame, threshold: float = 0.75, n: int = 10) -> DataFrame:
    """Flagged services with a score of at least ``threshold``, with advice."""
    flagged = top_anomalies(anomalies.where(F.col("anomaly_score") >= threshold), n)
    return flagged.select(
        F.col(KEY).alias("service"),
        F.bround("anomaly_score", 3).alias("anomaly_score"),
        F.bround("error_rate", 3).alias("error_rate"),
        F.bround("latency_p95", 1).alias("latency_p95_ms"),
        recommendation().alias("recommendation"),
    )


def window_alerts(scored: DataFrame, n: int = 10) -> DataFrame:
    shown = [KEY, "time_bucket", "anomaly_score", "request_count", "error_rate"]
    return top_anomalies(scored, n).select(*shown)


# ---------------------------------------------------------------- capacity


def forecast_peak_windows(forecasts: DataFrame, n: int = 20) -> DataFrame:
    return (
        upper_peaks(forecasts)
        .orderBy(F.desc(F.bround("peak_upper", 1)), KEY)
        .limit(n)
        .select(KEY, "peak_time", F.bround("peak_upper", 1).alias("peak_rph_upper"))
    )


def _with_current(forecasts: DataFrame, features: DataFrame) -> DataFrame:
    """Forecast peaks next to the current rate; a service unknown to ``features`` drops out."""
    return upper_peaks(forecasts).join(features.select(KEY, "requests_per_hour"), KEY)


def scale_recommendations(forecasts: DataFrame, features: DataFrame) -> DataFrame:
    """Services whose forecast peak is more than 1.3 times their mean rate."""
    current, factor = F.col("requests_per_hour"), F.col("factor")
    ratio = F.when(current > 0, F.col("peak_upper") / F.nullif(current, F.lit(0.0))).otherwise(1.0)
    action = F.format_string(
        "Pre-scale by %.1f× before forecasted peak at %s",
        factor,
        F.concat(F.date_format("peak_time", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")),
    )
    return (
        _with_current(forecasts, features)
        .withColumn("factor", ratio)
        .where(factor > 1.3)
        .select(
            F.col(KEY).alias("service"),
            F.bround(current, 1).alias("current_avg_rph"),
            F.bround("peak_upper", 1).alias("forecast_peak_rph"),
            F.bround(factor, 2).alias("recommended_scale_factor"),
            F.when(factor > 2.5, "high").otherwise("medium").alias("urgency"),
            action.alias("action"),
        )
        .orderBy(F.desc("recommended_scale_factor"), "service")
    )


# ---------------------------------------------------------------- cost insights


def idle_services(features: DataFrame, below_rph: float = 1.0) -> DataFrame:
    return features.where(F.col("requests_per_hour") < below_rph)


def overprovisioned(features: DataFrame, below_ratio: float = 1.5, below_rph: float = 100) -> DataFrame:
    return features.where(
        (F.col("peak_to_avg_ratio") < below_ratio) & (F.col("requests_per_hour") < below_rph)
    )


def spot_candidates(series: DataFrame, below_share: float = 0.1) -> DataFrame:
    """Services that are quiet at weekends; nothing unless the data holds a weekend hour."""
    any_weekend = series.agg(F.max("is_weekend") == 1).scalar()
    shares = weekend_share(series).where(F.col("weekend_share") < below_share)
    return shares.where(any_weekend)


def preemptive_scaling(forecasts: DataFrame, features: DataFrame, above: float = 2.5) -> DataFrame:
    """Services forecast to peak above ``above`` times their mean rate."""
    current = F.col("requests_per_hour")
    return _with_current(forecasts, features).where((current > 0) & (F.col("peak_upper") > current * above))


def reusability_candidates(features: DataFrame, above_rph: float = 100) -> DataFrame:
    return features.where(F.col("requests_per_hour") > above_rph)


def deprecation_candidates(
    features: DataFrame, below_requests: int = 100, above_errors: float = 0.2
) -> DataFrame:
    return features.where(
        (F.col("total_requests") < below_requests) & (F.col("error_rate") > above_errors)
    )


def cacheable_endpoints(
    logs: DataFrame,
    min_requests: int = 100,
    min_get_share: float = 0.9,
    min_ok_share: float = 0.9,
    max_variation: float = 0.5,
) -> DataFrame:
    """Busy endpoints that are nearly all GET and 200 with steady latency, busiest first."""
    variation = F.stddev_pop("latency_ms") / F.nullif(F.avg("latency_ms"), F.lit(0.0))
    return (
        logs.groupBy(KEY, "endpoint")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            share(F.count_if(F.col("method") == "GET"), F.count(F.lit(1))).alias("get_share"),
            share(F.count_if(F.col("status_code") == 200), F.count(F.lit(1))).alias("ok_share"),
            F.coalesce(variation, F.lit(0.0)).alias("latency_variation"),
        )
        .where(
            (F.col("request_count") >= min_requests)
            & (F.col("get_share") >= min_get_share)
            & (F.col("ok_share") >= min_ok_share)
            & (F.col("latency_variation") <= max_variation)
        )
        .orderBy(F.desc("request_count"), KEY, "endpoint")
    )


@dataclass
class CostRules:
    """Cuts of the six cost findings."""

    idle_rph: float = 1.0
    flat_ratio: float = 1.5
    flat_rph: float = 100
    spot_share: float = 0.1
    peak_factor: float = 2.5
    reuse_rph: float = 100
    retire_requests: int = 100
    retire_errors: float = 0.2


def cost_insights(
    features: DataFrame, series: DataFrame, forecasts: DataFrame | None = None, rules: CostRules | None = None
) -> DataFrame:
    """All findings that name services, as long rows ``(section, category, service_count, sample_services)``.

    Every service is looked at once and carries its categories; a category without services has no row.
    """
    r = rules or CostRules()
    rate = F.col("requests_per_hour")
    any_weekend = series.agg(F.max("is_weekend") == 1).scalar()
    table = features.join(weekend_share(series).select(KEY, "weekend_share"), KEY, "full")
    peak = F.lit(None).cast("double")
    if forecasts is not None:
        table = table.join(upper_peaks(forecasts).select(KEY, "peak_upper"), KEY, "left")
        peak = F.col("peak_upper")
    found = [
        (IDLE, rate < r.idle_rph),
        (FLAT, (F.col("peak_to_avg_ratio") < r.flat_ratio) & (rate < r.flat_rph)),
        (SPOT, (F.col("weekend_share") < r.spot_share) & any_weekend),
        (PREEMPT, (rate > 0) & (peak > rate * r.peak_factor)),
        (REUSE, rate > r.reuse_rph),
        (DEPRECATE, (F.col("total_requests") < r.retire_requests) & (F.col("error_rate") > r.retire_errors)),
    ]
    kinds = [
        F.when(
            rule,
            F.struct(
                F.lit(section).alias("section"),
                F.lit(category).alias("category"),
                F.lit(examples).alias("examples"),
                (-rate if (section, category, examples) == REUSE else F.lit(0.0)).alias("by"),
            ),
        )
        for (section, category, examples), rule in found
    ]
    tagged = table.select(KEY, F.explode(F.array_compact(F.array(*kinds))).alias("k")).select(KEY, "k.*")
    by = ["section", "category"]
    most = max(examples for _, _, examples in (IDLE, FLAT, SPOT, PREEMPT, REUSE, DEPRECATE))
    # the rank filter also runs before the shuffle: few rows of each category move
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("by", KEY))
    top = tagged.withColumn("_r", rank).where(F.col("_r") <= most)
    pairs = F.array_sort(F.collect_list(F.when(F.col("_r") <= F.col("examples"), F.struct("_r", KEY))))
    names = top.groupBy(*by).agg(F.transform(pairs, lambda p: p[KEY]).alias("sample_services"))
    return tagged.groupBy(*by).agg(F.count(F.lit(1)).alias("service_count")).join(names, by)


# ---------------------------------------------------------------- assembly


def _rows(section: DataFrame, *order: Column | str) -> Column:
    """A bounded section as one array of structs, in the section's own order."""
    struct = F.struct(*section.columns)
    if not order:
        return section.agg(F.collect_list(struct)).scalar()
    keyed = F.sort_array(F.collect_list(F.struct(*order, struct.alias("row"))))
    return section.agg(F.transform(keyed, lambda k: k["row"])).scalar()


def assemble_report(
    clustered: DataFrame,
    forecasts: DataFrame,
    anomalies: DataFrame,
    scored_windows: DataFrame,
    growth: DataFrame,
    series: DataFrame,
    start_date: str,
    end_date: str,
    top_n: int = 20,
    score_threshold: float = 0.75,
    growth_threshold: float = 50,
) -> DataFrame:
    """One nested row with the five sections. All lists are short: top-k, one per label or category.

    Scale recommendations are as many as services were forecast.
    """
    totals = report_totals(clustered).select(F.struct("*")).scalar()
    one = clustered.sparkSession.range(1).withColumn("_t", totals)

    def falling(column: str) -> Column:
        return (-F.col(column)).alias("_by")

    return one.select(
        F.struct(
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("generated_at"),
            F.struct(F.lit(start_date).alias("start"), F.lit(end_date).alias("end")).alias("date_range"),
            F.col("_t.total_services_analysed").alias("total_services_analysed"),
            F.col("_t.total_requests").alias("total_requests"),
        ).alias("metadata"),
        F.struct(
            _rows(top_services(clustered, top_n), falling("total_requests")).alias("top_services"),
            _rows(cluster_breakdown(clustered), falling("total_requests")).alias("cluster_breakdown"),
            _rows(fast_growing(growth, growth_threshold), falling("growth_rate_pct")).alias(
                "fast_growing_services"
            ),
            _rows(declining(growth), "growth_rate_pct").alias("declining_services"),
        ).alias("traffic_summary"),
        F.struct(
            _rows(service_alerts(anomalies, score_threshold), falling("anomaly_score")).alias("service_alerts"),
            _rows(window_alerts(scored_windows), falling("anomaly_score")).alias("time_window_alerts"),
        ).alias("anomaly_alerts"),
        F.struct(
            _rows(forecast_peak_windows(forecasts), falling("peak_rph_upper")).alias("forecast_peak_windows"),
            _rows(scale_recommendations(forecasts, clustered), falling("recommended_scale_factor")).alias(
                "scale_recommendations"
            ),
        ).alias("capacity_plan"),
        _rows(cost_insights(clustered, series, forecasts), "section", "category").alias("cost_optimization"),
    )
