import tracemalloc
from datetime import datetime, timedelta

import numpy as np
import pytest

from logtide.operators import forecast as fc

T0 = datetime(2024, 1, 1)


def generated(hours, seed, alpha=0.3, beta=0.05, gamma=0.1, phi=0.95, noise=3.0):
    """Noisy series of the model itself, with known parameters."""
    rng = np.random.default_rng(seed)
    level, trend, season, y = 100.0, 0.5, 20 * np.sin(np.arange(24) * np.pi / 12), []
    for t in range(hours):
        base, s = level + phi * trend, season[t % 24]
        value = base + s + rng.normal(0, noise)
        y.append(value)
        fresh = alpha * (value - s) + (1 - alpha) * base
        trend = beta * (fresh - level) + (1 - beta) * phi * trend
        season[t % 24] = gamma * (value - base) + (1 - gamma) * s
        level = fresh
    return np.array(y)


def series(spark, data):
    rows = [(s, T0 + timedelta(hours=h), float(v)) for s, y in data.items() for h, v in enumerate(y)]
    return spark.createDataFrame(rows, "service_name string, time_bucket timestamp, request_count double")


def test_fit_beats_true_parameters_and_repeating_the_last_day():
    ours, naive = [], []
    for seed in range(6):
        y = generated(504 + 24, seed)
        fit = fc.fit_series(y[:504])
        true = tuple(np.array([p]) for p in (0.3, 0.05, 0.1, 0.95))
        assert fit["sse"] <= fc._best_starts(y[:504], true)[1][0] * 1.001
        h = np.arange(1, 25)
        damping = fit["phi"] * (1 - fit["phi"] ** h) / (1 - fit["phi"])
        ahead = fit["level"] + damping * fit["trend"] + np.array(fit["season"])
        ours.append(np.abs(ahead - y[504:]).mean())
        naive.append(np.abs(y[480:504] - y[504:]).mean())
    assert np.mean(ours) < np.mean(naive)


def test_recursion_matches_the_plain_form():
    y = generated(72, 1)
    alpha, beta, gamma, phi = 0.4, 0.1, 0.2, 0.9
    steps = fc._predictions(y, tuple(np.array([p]) for p in (alpha, beta, gamma, phi)))
    rng = np.random.default_rng(0)
    start = rng.normal(0, 1, 26)
    level, trend, season = start[0], start[1], list(start[2:])
    for t, value in enumerate(y):
        base, s = level + phi * trend, season[t % 24]
        assert next(steps)[0] @ np.append(start, 1.0) == pytest.approx(base + s)
        fresh = alpha * (value - s) + (1 - alpha) * base
        trend = beta * (fresh - level) + (1 - beta) * phi * trend
        season[t % 24] = gamma * (value - base) + (1 - gamma) * s
        level = fresh


def test_forecasts_of_the_busiest_long_enough_series(spark):
    data = {"big": generated(72, 1), "bigger": generated(96, 2) * 3, "short": [1e6] * 47, "flat": [0.0] * 60}
    states = fc.fit_forecasts(series(spark, data), top_n=3)
    got = fc.forecast(states, horizon_hours=30).orderBy("service_name", "time_bucket").collect()
    assert {r.service_name for r in got} == {"big", "bigger"} and len(got) == 60
    first = next(r for r in got if r.service_name == "big")
    assert first.time_bucket == T0 + timedelta(hours=72)
    for r in got:
        assert 0 <= r.lower_bound <= r.forecast <= r.upper_bound
        assert r.forecast == round(r.forecast, 2)
    state = {r.service_name: r for r in states.collect()}["big"]
    assert state.hours == 72 and len(state.season) == 24
    half = first.upper_bound - first.forecast
    assert half == pytest.approx(1.96 * state.resid_std, abs=0.011)
    wide = fc.forecast(states, 1, level=0.99).where("service_name = 'big'").first()
    assert wide.upper_bound - wide.forecast == pytest.approx(2.576 * state.resid_std, abs=0.011)


def test_all_zero_series_forecasts_zero(spark):
    got = fc.forecast(fc.fit_forecasts(series(spark, {"flat": [0.0] * 48}))).collect()
    assert len(got) == 24 and {(r.forecast, r.lower_bound, r.upper_bound) for r in got} == {(0.0, 0.0, 0.0)}


def test_holes_in_a_series_count_as_zero(spark):
    df = series(spark, {"a": [5.0] * 72}).where("hour(time_bucket) != 3")
    at_three = [r for r in fc.forecast(fc.fit_forecasts(df)).collect() if r.time_bucket.hour == 3]
    assert at_three[0].forecast == pytest.approx(0.0, abs=0.05)


def test_one_bad_series_does_not_stop_the_others(spark):
    data = {"bad": [float("inf")] * 60, "good": generated(60, 3)}
    data["short"] = [1.0] * 20
    states = fc.fit_forecasts(series(spark, data))
    assert {r.service_name: r.status for r in states.collect()} == {"bad": "failed", "good": "fitted", "short": "too_short"}
    assert {r.service_name for r in fc.forecast(states).collect()} == {"good"}
    longer = fc.fit_forecasts(series(spark, data), min_hours=61).collect()
    assert {r.status for r in longer} == {"too_short", "failed"} - ({"failed"} if len(data["bad"]) < 61 else set())


def test_memory_of_a_fit_does_not_grow_with_the_series():
    y = generated(24 * 365, 5)
    tracemalloc.start()
    fc._best_starts(y, fc._to_parameters(np.full((108, 4), 0.3)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6


FORECAST = "service_name string, time_bucket timestamp, forecast double, lower_bound double, upper_bound double"


def hour(h):
    return T0 + timedelta(hours=h)


def forecasts(spark):
    rows = [
        ("a", hour(1), 5.0, 1.0, 9.0),
        ("a", hour(2), 7.0, 1.0, 8.0),
        ("a", hour(3), 7.0, 1.0, 9.0),
        ("b", hour(1), 50.04, 1.0, 90.0),
        ("c", hour(1), 1.0, 0.0, 0.0),
    ]
    return spark.createDataFrame(rows, FORECAST)


def test_peaks_take_the_first_of_ties(spark):
    got = [tuple(r) for r in fc.peak_windows(forecasts(spark)).collect()]
    assert got == [("b", hour(1), 50.0, 90.0), ("a", hour(2), 7.0, 8.0), ("c", hour(1), 1.0, 0.0)]
    upper = {r.service_name: r for r in fc.upper_peaks(forecasts(spark)).collect()}
    assert upper["a"].peak_upper == 9.0 and upper["a"].peak_time == hour(1)


@pytest.mark.parametrize(
    "capacity, headroom, status",
    [
        (10.0, 10.0, "well_provisioned"),
        (9.9, 9.1, "under_provisioned"),
        (18.0, 50.0, "well_provisioned"),
        (19.0, 52.6, "over_provisioned"),
        (0.0, 0.0, "under_provisioned"),
    ],
)
def test_headroom(spark, capacity, headroom, status):
    known = spark.createDataFrame([("a", capacity)], ["service_name", "capacity"])
    got = {r.service_name: r for r in fc.capacity_headroom(forecasts(spark), known).collect()}
    assert (got["a"].headroom_pct, got["a"].status) == (headroom, status)
    assert (got["b"].headroom_pct, got["b"].status, got["b"].current_capacity) == (33.3, "well_provisioned", 135.0)
    assert (got["c"].headroom_pct, got["c"].status) == (0.0, "under_provisioned")


def test_headroom_without_capacity(spark):
    got = fc.capacity_headroom(forecasts(spark).where("service_name != 'c'")).collect()
    assert {(r.headroom_pct, r.status) for r in got} == {(33.3, "well_provisioned")}


def hourly(spark, values, begin=datetime(2024, 3, 1)):
    rows = [(name, begin + timedelta(hours=h), int(v)) for name, own in values.items() for h, v in enumerate(own)]
    return spark.createDataFrame(rows, "service_name string, time_bucket timestamp, request_count long").repartition(3)


def brute_roll(y, alpha, beta, gamma, phi):
    """Level, trend and the next 24 seasonal terms, an hour at a time."""
    level, trend = float(np.mean(y[:24])), 0.0
    season = {h: y[h] - level for h in range(24)}
    for t in range(24, len(y)):
        base, s, before = level + phi * trend, season[t % 24], level
        level = alpha * (y[t] - s) + (1 - alpha) * base
        season[t % 24] = gamma * (y[t] - base) + (1 - gamma) * s
        trend = beta * (level - before) + (1 - beta) * phi * trend
    return level, trend, [season[t % 24] for t in range(len(y), len(y) + 24)]


def test_states_rolled_forward_equal_the_recursion(spark):
    rng = np.random.default_rng(6)
    values = {f"s{k}": rng.integers(0, 40, 24 + n) for k, n in enumerate([0, 1, 23, 24, 25, 90])}
    parameters = {"alpha": 0.3, "beta": 0.1, "gamma": 0.2, "phi": 0.9}
    series = hourly(spark, values)
    start = fc.start_states(series, **parameters, resid_std=1.5)
    got = {r.service_name: r for r in fc.roll_forward(start, series).collect()}
    for name, y in values.items():
        level, trend, season = brute_roll(y, **parameters)
        r = got[name]
        assert (r.level, r.trend, r.hours, r.status) == (pytest.approx(level), pytest.approx(trend), len(y), "fitted")
        assert r.season == pytest.approx(season) and r.last_second % 86400 == 3600 * ((len(y) - 1) % 24)
    # in two steps as in one, and a second time changes nothing
    half = series.where("time_bucket < '2024-03-02 12:00:00'")
    twice = fc.roll_forward(fc.roll_forward(start, half), series)
    again = fc.roll_forward(twice, series)
    for table in (twice, again):
        assert {r.service_name: (r.level, r.last_second) for r in table.collect()} == {
            k: (pytest.approx(r.level), r.last_second) for k, r in got.items()
        }


def test_gaps_and_unfitted_states(spark):
    series = hourly(spark, {"whole": range(60), "gap": range(60)}).where("service_name = 'whole' OR time_bucket <> '2024-03-02 20:00:00'")
    rolled = fc.roll_forward(fc.start_states(series, 0.3, 0.1, 0.2, 0.9, 1.0), series)
    assert {r.service_name: r.status for r in rolled.collect()} == {"whole": fc.FITTED, "gap": fc.FAILED}
    short = fc.fit_forecasts(hourly(spark, {"few": range(5)}))
    assert fc.roll_forward(short, series).collect() == short.collect()
    assert fc.forecast(rolled).select("service_name").distinct().count() == 1


def test_stored_states_are_rolled_until_too_old(spark, tmp_path):
    path = str(tmp_path / "states")
    day = [10 + 5 * (h % 24 > 8) for h in range(24)]
    old, new = hourly(spark, {"a": day * 4, "b": day * 4}), hourly(spark, {"a": day * 6, "b": day * 6, "c": [100] * 144})
    first = fc.current_states(old, path, top_n=2).collect()
    assert {r.service_name for r in first} == {"a", "b"} and fc.stored_states(spark, path, 7).count() == 2
    second = {r.service_name: r for r in fc.current_states(new, path, top_n=2).collect()}
    assert set(second) == {"a", "c"}  # the busiest two now: one rolled forward, one fitted
    fitted = {r.service_name: r for r in first}["a"]
    assert (second["a"].alpha, second["a"].phi) == (fitted.alpha, fitted.phi) and second["a"].last_second == fitted.last_second + 48 * 3600
    assert fc.stored_states(spark, path, -1) is None and fc.stored_states(spark, str(tmp_path / "none"), 7) is None
    later = hourly(spark, {"a": day * 3}, datetime(2024, 5, 1))  # a gap since the stored hours: a fit
    assert fc.current_states(later, path, top_n=1).first().hours == 72
