from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logtide.operators import report as rp
from logtide.operators.features import calendar_features

T0 = datetime(2024, 1, 1)
FEATURES = (
    "service_name string, total_requests long, requests_per_hour double, error_rate double, latency_p95 double,"
    " peak_to_avg_ratio double, cluster_label string"
)


def features(spark):
    rows = [
        ("idle", 50, 0.5, 0.3, 10.0, 1.2, "idle"),
        ("flat", 500, 20.0, 0.0, 20.0, 1.4, "idle"),
        ("busy", 90000, 500.0, 0.1, 3000.0, 4.0, "bursty"),
        ("flood", 900000, 20000.0, 0.01, 30.0, 4.0, "bursty"),
        ("bad", 99, 5.0, 0.2, 30.0, 4.0, "bursty"),
    ]
    return spark.createDataFrame(rows, FEATURES)


def names(df, column="service_name"):
    return [r[column] for r in df.collect()]


def test_totals_and_top(spark):
    assert tuple(rp.report_totals(features(spark)).first()) == (5, 990649)
    assert tuple(rp.report_totals(features(spark).limit(0)).first()) == (0, 0)
    assert names(rp.top_services(features(spark), 2)) == ["flood", "busy"]
    ties = features(spark).withColumn("total_requests", F.lit(1).cast("long"))
    assert names(rp.top_services(ties, 3)) == ["bad", "busy", "flat"]


def test_breakdown(spark):
    got = [(r.cluster_label, r.service_count, r.total_requests) for r in rp.cluster_breakdown(features(spark)).collect()]
    assert got == [("bursty", 3, 990099), ("idle", 2, 550)]


def test_growth_lists(spark):
    rows = [(f"s{i:02d}", 1, 1, float(p)) for i, p in enumerate([50, 51, 200, -20, -21, -90, *range(60, 72)])]
    df = spark.createDataFrame(rows, "service_name string, recent_requests long, prior_requests long, growth_rate_pct double")
    assert names(rp.fast_growing(df), "growth_rate_pct") == [200.0, *map(float, range(71, 62, -1))]
    assert names(rp.declining(df), "growth_rate_pct") == [-90.0, -21.0]
    assert names(rp.declining(df, mildest_first=True), "growth_rate_pct") == [-21.0, -90.0]


@pytest.mark.parametrize(
    "error, latency, rate, start",
    [
        (0.16, 5000.0, 1.0, "High error rate"),
        (0.15, 2001.0, 99999.0, "High P95 latency"),
        (0.0, 2000.0, 10001.0, "Unexpected traffic volume"),
        (0.0, 0.0, 10000.0, "Anomalous profile"),
    ],
)
def test_first_matching_advice(spark, error, latency, rate, start):
    df = spark.createDataFrame([(error, latency, rate)], ["error_rate", "latency_p95", "requests_per_hour"])
    assert df.select(rp.recommendation()).first()[0].startswith(start)


def test_service_alerts(spark):
    scored = features(spark).withColumns(
        {
            "anomaly_score": F.when(F.col("service_name") == "bad", 0.74999).otherwise(0.87654),
            "is_anomaly": F.col("service_name") != "flat",
        }
    )
    got = rp.service_alerts(scored).collect()
    assert [(r.service, r.anomaly_score, r.latency_p95_ms) for r in got] == [
        ("busy", 0.877, 3000.0),
        ("flood", 0.877, 30.0),
        ("idle", 0.877, 10.0),
    ]


def test_rules_that_name_services(spark):
    f = features(spark)
    assert names(rp.idle_services(f)) == ["idle"]
    assert sorted(names(rp.overprovisioned(f))) == ["flat", "idle"]
    assert sorted(names(rp.reusability_candidates(f))) == ["busy", "flood"]
    assert names(rp.deprecation_candidates(f)) == ["idle"]


def forecasts(spark):
    rows = [("busy", T0, 1.0, 0.0, 650.0), ("flood", T0, 1.0, 0.0, 90000.0), ("gone", T0, 1.0, 0.0, 5.0), ("bad", T0, 1.0, 0.0, 7.0)]
    return spark.createDataFrame(
        rows, "service_name string, time_bucket timestamp, forecast double, lower_bound double, upper_bound double"
    )


def test_scale_recommendations(spark):
    got = rp.scale_recommendations(forecasts(spark), features(spark)).collect()
    assert [(r.service, r.recommended_scale_factor, r.urgency) for r in got] == [
        ("flood", 4.5, "high"),
        ("bad", 1.4, "medium"),
    ]
    assert got[0].action == "Pre-scale by 4.5× before forecasted peak at 2024-01-01 00:00:00+00:00"
    assert names(rp.preemptive_scaling(forecasts(spark), features(spark))) == ["flood"]
    assert names(rp.forecast_peak_windows(forecasts(spark), 2)) == ["flood", "busy"]


def series(spark, hours):
    rows = [(s, T0 + timedelta(hours=h), n) for s, counts in hours.items() for h, n in counts.items()]
    return calendar_features(
        spark.createDataFrame(rows, "service_name string, time_bucket timestamp, request_count long")
    )


def test_spot_needs_a_weekend_in_the_data(spark):
    saturday = 5 * 24
    weekday_only = series(spark, {"a": {0: 5}, "b": {1: 5}})
    assert rp.spot_candidates(weekday_only).count() == 0
    full = series(spark, {"a": {0: 95, saturday: 5}, "b": {0: 9, saturday: 1}, "zero": {0: 0}})
    assert sorted(names(rp.spot_candidates(full))) == ["a", "zero"]


def test_cost_insights(spark):
    full = series(spark, {"a": {0: 95, 120: 5}})
    got = {r.category: r for r in rp.cost_insights(features(spark), full, forecasts(spark)).collect()}
    assert {c: r.service_count for c, r in got.items()} == {
        "Idle Services": 1,
        "Over-provisioned (Flat Traffic)": 2,
        "Spot Instance Candidates": 1,
        "Pre-emptive Auto-Scaling": 1,
        "Reusability Candidates": 2,
        "Deprecation Candidates": 1,
    }
    assert got["Reusability Candidates"].sample_services == ["flood", "busy"]
    assert got["Over-provisioned (Flat Traffic)"].sample_services == []
    busy_only = features(spark).where("service_name = 'busy'")
    left = rp.cost_insights(busy_only, series(spark, {"a": {0: 1}})).collect()
    assert [r.category for r in left] == ["Reusability Candidates"]


def test_insights_name_a_bounded_number_of_services(spark):
    many = spark.range(500).select(
        F.format_string("s%03d", "id").alias("service_name"),
        F.lit(1).cast("long").alias("total_requests"),
        F.lit(0.1).alias("requests_per_hour"),
        F.lit(0.0).alias("error_rate"),
        F.lit(5.0).alias("peak_to_avg_ratio"),
    )
    got = rp.cost_insights(many, series(spark, {"a": {0: 1}})).collect()
    assert [(r.service_count, r.sample_services) for r in got] == [(500, [f"s{i:03d}" for i in range(8)])]


def test_cacheable_endpoints(spark):
    rows = [("a", "/good", "GET", 200, 10.0)] * 100 + [("a", "/post", "POST", 200, 10.0)] * 100
    rows += [("a", "/rare", "GET", 200, 10.0)] * 9 + [("a", "/jumpy", "GET", 200, float(i**3)) for i in range(100)]
    rows += [("a", "/bad", "GET", 500, 10.0)] * 100
    df = spark.createDataFrame(rows, ["service_name", "endpoint", "method", "status_code", "latency_ms"])
    got = rp.cacheable_endpoints(df).collect()
    assert [(r.endpoint, r.request_count, r.latency_variation) for r in got] == [("/good", 100, 0.0)]
