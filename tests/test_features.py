import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.operators import features as fe
from logtide.operators.percentiles import exact_percentiles, percentiles_by_rank

T0 = datetime(2024, 1, 1)
LOG = (
    "timestamp timestamp, service_name string, endpoint string, status_code int, latency_ms double,"
    " bytes_response double, user_id string, instance_id string"
)


def logs(spark, rows):
    return spark.createDataFrame(rows, LOG)


def row(hours, service="a", endpoint="/x", status=200, latency=1.0, size=10.0, user="u", pod="p"):
    return (T0 + timedelta(hours=hours), service, endpoint, status, latency, size, user, pod)


QUANTILES = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


@pytest.mark.parametrize("by_rank", [True, False])
def test_percentiles_equal_numpy(spark, by_rank):
    rng = np.random.default_rng(3)
    groups = {
        "one": [5.0],
        "two": [2.0, 1.0],
        "ties": [7.0] * 50 + [8.0],
        "wide": list(10.0 ** rng.uniform(-300, 300, 400)),
        "signed": list(rng.normal(0, 1, 500)) + [0.0, -0.0],
        "narrow": list(1e9 + rng.uniform(0, 1e-6, 300)),
        "powers": [s * 2.0**k for k in range(-20, 21) for s in (1, -1)],
        "near powers": [np.nextafter(2.0**k, side) for k in range(-9, 10) for side in (0, np.inf)],
        "ends": [-math.inf, 0.0, 1.0, math.inf, math.inf],
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    rows += [("one", None), ("one", math.nan), ("nothing", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, _v double")
    if by_rank:
        found = percentiles_by_rank(df.where("_v is not null and not isnan(_v)"), ["g"], QUANTILES)
    else:
        found = exact_percentiles(df.where("g != 'ends'"), ["g"], "_v", QUANTILES)
    got = {r.g: r for r in found.collect()}
    assert set(got) == set(groups) - (set() if by_rank else {"ends"})
    for g, values in groups.items():
        if g == "ends":
            continue
        for name, q in QUANTILES.items():
            assert got[g][name] == pytest.approx(np.percentile(values, q * 100), rel=1e-12, abs=1e-300), (g, name)
    if by_rank:
        assert got["ends"].p50 == 1.0 and got["ends"].p100 == math.inf


def test_percentiles_without_key_and_with_hot_group(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(1).alias("g"), (F.col("id") % 977 + 0.25).alias("v")
    )
    values = np.arange(30000) % 977 + 0.25
    whole = exact_percentiles(df, [], "v", {"p95": 0.95}).first()
    assert whole.p95 == pytest.approx(np.percentile(values, 95), rel=1e-12)
    hot = exact_percentiles(df, ["g"], "v", {"p95": 0.95}).where("g = 1").first()
    ids = np.arange(30000)
    assert hot.p95 == pytest.approx(np.percentile(values[ids % 3 != 0], 95), rel=1e-12)


def test_service_features(spark):
    df = logs(
        spark,
        [
            row(0, latency=1.0, size=None, user="u1"),
            row(0.25, latency=2.0, status=404, user="u2"),
            row(2, latency=4.0, status=503, endpoint="/y", user="u1", pod="q"),
            row(5, "quiet", latency=None, size=None),
        ],
    )
    got = {r.service_name: r.asDict() for r in fe.service_features(df).collect()}
    a, quiet = got["a"], got["quiet"]
    assert a["total_requests"] == 3 and a["active_hours"] == 2.0 and a["requests_per_hour"] == 1.5
    assert a["error_rate"] == pytest.approx(2 / 3) and a["server_error_rate"] == pytest.approx(1 / 3)
    assert a["latency_p50"] == 2.0 and a["latency_p95"] == pytest.approx(3.8) and a["avg_bytes"] == 10.0
    assert (a["unique_users"], a["unique_endpoints"], a["unique_instances"]) == (2, 2, 2)
    assert a["peak_to_avg_ratio"] == pytest.approx(2 / 1.5)  # the empty hour does not count
    assert quiet["active_hours"] == 1.0 and quiet["requests_per_hour"] == 1.0
    assert quiet["latency_p99"] == 0.0 and quiet["avg_bytes"] == 0.0 and quiet["peak_to_avg_ratio"] == 1.0
    approx = {r.service_name: r for r in fe.service_features(df, exact=False).collect()}
    assert approx["a"].unique_users == 2 and approx["a"].latency_p50 == 2.0
    span = {r.service_name: r for r in fe.request_span(df).collect()}
    assert span["a"].requests_per_hour == 1.5


def test_hourly_other_bucket_sizes(spark):
    df = logs(spark, [row(0), row(5, latency=3.0, status=500), row(30, size=None, latency=None)])
    day = fe.hourly_traffic(df, freq="1 day").orderBy("time_bucket").collect()
    assert [(r.time_bucket, r.request_count) for r in day] == [(T0, 2), (T0 + timedelta(days=1), 1)]
    assert day[0].error_rate == 0.5 and day[0].latency_p50 == 2.0 and day[0].bytes_total == 20.0
    assert day[1].latency_p50 == 0.0 and day[1].bytes_total == 0.0


def test_grid_has_every_bucket_of_every_service(spark):
    df = logs(spark, [row(0), row(3), row(7), row(2, "late"), row(4, "late"), row(1, "once")])
    hourly = fe.hourly_traffic(df)
    grid = fe.dense_grid(hourly).orderBy("service_name", "time_bucket").collect()
    assert len(grid) == 3 * 8
    counts = {(r.service_name, (r.time_bucket - T0).seconds // 3600): r.request_count for r in grid}
    assert sum(counts.values()) == 6
    for service, hours in {"a": {0, 3, 7}, "late": {2, 4}, "once": {1}}.items():
        assert {h for (s, h), n in counts.items() if s == service and n} == hours
    empty = next(r for r in grid if r.service_name == "once" and r.request_count == 0)
    assert (empty.error_rate, empty.latency_p95, empty.bytes_total, empty.unique_users) == (0.0, 0.0, 0.0, 0)


def test_calendar(spark):
    days = [datetime(2024, 1, 7, 23), datetime(2024, 12, 30, 9), datetime(2021, 1, 3, 17), datetime(2024, 1, 1, 18)]
    df = spark.createDataFrame([(d,) for d in days], ["time_bucket"])
    got = {r.time_bucket: r for r in fe.calendar_features(df).collect()}
    for d in days:
        r = got[d]
        assert (r.hour_of_day, r.day_of_week, r.week_of_year) == (d.hour, d.weekday(), d.isocalendar()[1])
        assert r.is_weekend == (d.weekday() >= 5) and r.is_business_hours == (9 <= d.hour <= 17)


def series(spark, counts_by_service):
    rows = [
        (s, T0 + timedelta(hours=h), n) for s, counts in counts_by_service.items() for h, n in enumerate(counts) if n
    ]
    return spark.createDataFrame(rows, "service_name string, time_bucket timestamp, request_count long")


def test_growth(spark):
    data = {
        "up": [1] * 168 + [2] * 168,
        "down": [3] * 168 + [1] * 168,
        "new": [0] * 168 + [5] * 168,
        "third": [3] * 168 + [4] * 168,
    }
    sparse = series(spark, data)
    got = [(r.service_name, r.recent_requests, r.prior_requests, r.growth_rate_pct) for r in fe.growth_rates(sparse).collect()]
    assert got == [("up", 336, 168, 100.0), ("third", 672, 504, 33.33), ("down", 168, 504, -66.67)]
    assert [tuple(r) for r in fe.growth_rates(fe.dense_grid(sparse)).collect()] == got


@pytest.mark.parametrize("hours, services", [(335, 0), (336, 1)])
def test_growth_needs_two_whole_windows(spark, hours, services):
    assert fe.growth_rates(series(spark, {"a": [1] * hours})).count() == services


def test_weekend_share(spark):
    week = [0] * 168
    week[0], week[5 * 24] = 3, 1  # Monday and Saturday
    df = fe.calendar_features(series(spark, {"a": week, "weekday": [2]}))
    assert {r.service_name: r.weekend_share for r in fe.weekend_share(df).collect()} == {"a": 0.25, "weekday": 0.0}


def test_time_series_in_one_call(spark):
    got = fe.timeseries_features(logs(spark, [row(0), row(2)])).collect()
    assert len(got) == 3 and {"hour_of_day", "request_count"} <= set(got[0].asDict())
