from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.operators import anomalies as an
from logtide.operators import forest as fo
from logtide.operators.features import dense_grid
from logtide.operators.running import new_window_anomalies, store_days
from logtide.operators.scaling import scale_scores

T0 = datetime(2024, 1, 1)


def windows(spark, data):
    rows = [
        (s, T0 + timedelta(hours=h), int(n), 0.0, 1.0, 2.0) for s, counts in data.items() for h, n in enumerate(counts)
    ]
    return spark.createDataFrame(
        rows,
        "service_name string, time_bucket timestamp, request_count long, error_rate double,"
        " latency_p50 double, latency_p95 double",
    )


def test_window_scores(spark):
    rng = np.random.default_rng(0)
    spiky, flat = rng.poisson(50, 100), [5] * 30
    spiky[17] = 200
    got = an.window_anomalies(windows(spark, {"spiky": spiky, "flat": flat, "short": [1] * 22 + [99]})).collect()
    z = np.abs((spiky - spiky.mean()) / spiky.std())
    by_hour = {r.time_bucket: r for r in got if r.service_name == "spiky"}
    for h in range(100):
        r = by_hour[T0 + timedelta(hours=h)]
        assert r.anomaly_score == pytest.approx(z[h], abs=6e-5) and r.is_anomaly == (round(z[h], 4) > 3.0)
    assert {(r.anomaly_score, r.is_anomaly) for r in got if r.service_name == "flat"} == {(0.0, False)}
    assert not [r for r in got if r.service_name == "short"]


def test_twenty_four_rows_are_enough_and_three_is_not_over_the_cut(spark):
    # one of ten equal values stands out by exactly 3 deviations
    counts = [0] * 9 + [1]
    got = an.window_anomalies(windows(spark, {"a": counts}), min_rows=10).collect()
    assert max(r.anomaly_score for r in got) == 3.0 and not any(r.is_anomaly for r in got)
    assert an.window_anomalies(windows(spark, {"a": [1, 2] * 12})).count() == 24
    assert an.window_anomalies(windows(spark, {"a": [1] * 23})).count() == 0


def services(spark, rows):
    return spark.createDataFrame(
        [(f"s{i:04d}", *map(float, r)) for i, r in enumerate(rows)],
        "service_name string, requests_per_hour double, error_rate double, latency_p95 double, peak_to_avg_ratio double",
    )


def test_service_zscores(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(10, 1, (40, 4))
    x[:, 2] = 7.0  # constant
    x[3, 0] = 30
    got = an.service_anomalies_zscore(services(spark, x)).orderBy("service_name").collect()
    deviations = x.std(axis=0)
    z = np.abs((x - x.mean(axis=0)) / np.where(deviations > 1e-9, deviations, np.inf)).max(axis=1)
    want = (z - z.min()) / (z.max() - z.min() + 1e-8)
    assert [r.anomaly_score for r in got] == pytest.approx(list(want), abs=6e-5)
    assert [r.is_anomaly for r in got] == list(z > 2.5)


@pytest.mark.parametrize("score", [an.service_anomalies_zscore, fo.service_anomalies_iforest])
def test_nine_services_are_too_few(spark, score):
    got = score(services(spark, [[1, 1, 1, 1]] * 8 + [[99, 99, 99, 99]])).collect()
    assert {(r.anomaly_score, r.is_anomaly) for r in got} == {(0.0, False)}


def test_equal_scores_scale_to_zero(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], ["raw"])
    assert [r.anomaly_score for r in scale_scores(df, "raw").collect()] == [0.0, 0.0]


def test_top_anomalies(spark):
    df = spark.createDataFrame(
        [("b", 4.0, True), ("a", 4.0, True), ("c", 9.0, False), ("d", 5.0, True)],
        "service_name string, anomaly_score double, is_anomaly boolean",
    )
    assert [r.service_name for r in an.top_anomalies(df, 2).collect()] == ["d", "a"]


@pytest.mark.parametrize("n", [60, 1500])
def test_forest_ranks_planted_outliers_first(spark, n):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (n, 4))
    x[:3] += 8
    df = services(spark, x)
    got = fo.service_anomalies_iforest(df, contamination=0.05).collect()
    scores = sorted(got, key=lambda r: -r.anomaly_score)
    assert {r.service_name for r in scores[:3]} == {"s0000", "s0001", "s0002"}
    assert scores[0].anomaly_score == 1.0 and scores[-1].anomaly_score == 0.0
    assert sum(r.is_anomaly for r in got) == pytest.approx(0.05 * n, abs=1)
    again = fo.service_anomalies_iforest(df.repartition(5), contamination=0.05).collect()
    assert sorted(again) == sorted(got)


def test_forest_bounds_and_reuse(spark):
    rng = np.random.default_rng(8)
    df = services(spark, rng.normal(0, 1, (700, 4)))
    rows = fo._tree_rows(df, "service_name", an.SERVICE_SCORED, 20, 256, 42).groupBy("tree").count().collect()
    assert len(rows) == 20 and {r["count"] for r in rows} == {256}
    forest = fo.fit_forest(df, an.SERVICE_SCORED, trees=20)
    assert max(r["count"] for r in forest.groupBy("tree").count().collect()) <= 511
    a = fo.service_anomalies_iforest(df, trees=20)
    b = fo.service_anomalies_iforest(df, forest=forest)
    assert sorted(a.collect()) == sorted(b.collect())


def test_identical_rows_get_equal_scores(spark):
    got = fo.service_anomalies_iforest(services(spark, [[1, 2, 3, 4]] * 12)).collect()
    assert {(r.anomaly_score, r.is_anomaly) for r in got} == {(0.0, False)}


def test_average_path_matches_the_paper():
    assert fo.average_path(1) == 0 and fo.average_path(2) == 1
    assert float(fo.average_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_each_tree_scales_by_its_own_rows(spark):
    """Two single-split trees, of 4 and 2 rows: the score follows from the paper's formula."""
    nodes = [(0, 0, 0, 1.0, 1, 2, 0.0, 4), (0, 1, -1, 0.0, -1, -1, 2.0, 4), (0, 2, -1, 0.0, -1, -1, 1.0, 4), (1, 0, -1, 0.0, -1, -1, 1.0, 2)]
    forest = spark.createDataFrame(nodes, fo.NODE_SCHEMA)
    got = fo.score_forest(spark.createDataFrame([(0.0,), (5.0,)], "a double"), forest, ["a"]).orderBy("a").collect()
    c = float(fo.average_path(4))
    assert [r.raw_score for r in got] == pytest.approx([2 ** -((2 / c + 1) / 2), 2 ** -((1 / c + 1) / 2)])


def test_the_least_number_of_rows_is_an_argument(spark):
    few = services(spark, [[1, 1, 1, 1]] * 4 + [[99, 99, 99, 99]])
    assert max(r.anomaly_score for r in fo.service_anomalies_iforest(few, min_rows=5).collect()) == 1.0


def test_new_hours_score_as_in_the_whole_series(spark, tmp_path):
    rng, rows = np.random.default_rng(5), []
    for s, begin in (("a", 0), ("b", 0), ("late", 50)):  # one service comes later
        for h in range(begin, 96):
            if rng.random() < 0.7 or h in (0, 95):
                rows.append((s, datetime(2024, 1, 1) + timedelta(hours=h), int(rng.integers(1, 50)) + 300 * (h == 90), float(rng.random()), None if h % 5 == 0 else float(rng.random()), 5.0))
    hourly = spark.createDataFrame(rows, "service_name string, time_bucket timestamp, request_count long, error_rate double, latency_p50 double, latency_p95 double")
    store, day = str(tmp_path / "moments"), F.to_date("time_bucket")
    for d in ("2024-01-01", "2024-01-02", "2024-01-03"):
        store_days(hourly.where(day == d), store)
    store_days(hourly.where(day == "2024-01-02"), store)  # a replay
    last = hourly.where(day == "2024-01-04")
    want = an.window_anomalies(dense_grid(hourly)).where(day == "2024-01-04").where(F.col("time_bucket") >= last.agg(F.min("time_bucket")).first()[0])
    read = lambda df: {(r.service_name, r.time_bucket): (r.request_count, r.anomaly_score, r.is_anomaly) for r in df.collect()}
    got = read(new_window_anomalies(last, store))
    assert got == read(want) and any(flag for *_, flag in got.values())
    assert read(new_window_anomalies(last, store)) == got
    assert new_window_anomalies(hourly.where(day == "2024-01-01").limit(3), str(tmp_path / "few")).count() == 0
