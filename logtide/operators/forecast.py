"""Hourly traffic forecasts per service, their peaks and the room left below capacity.

Additive Holt-Winters with a damped trend and a 24 h season (Holt 1957, Winters 1960, Gardner and
McKenzie 1985). Fitting one service's hourly series is the only Python step; a fitted model is one row
of states, and forecasts are plain column expressions over that table, stored or fresh.
"""

from __future__ import annotations

import itertools
import logging
import uuid
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.scratch import materialize

log = logging.getLogger(__name__)

SEASON = 24
MIN_HOURS = 48
MAX_FIT_TASKS = 2000
STATES = (
    "alpha double, beta double, gamma double, phi double, level double, trend double, "
    "season array<double>, last_second long, resid_std double, sse double, hours int, status string"
)
FITTED, TOO_SHORT, FAILED = "fitted", "too_short", "failed"


# ---------------------------------------------------------------- fitting one series


def _to_parameters(u: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unit-cube coordinates to (alpha, beta <= alpha, gamma <= 1 - alpha, phi in [0.8, 0.995])."""
    alpha = 1e-4 + u[:, 0] * (1 - 2e-4)
    return alpha, u[:, 1] * alpha, u[:, 2] * (1 - alpha), 0.8 + u[:, 3] * 0.195


def _predictions(y: np.ndarray, parameters: tuple[np.ndarray, ...]):
    """Run the recursion for many parameter sets at once, as a linear map of the start state.

    Columns 0..25 follow a unit start level, trend or season; the last one follows the data. Yields the
    one-step predictions (set, column) of each hour, and the end states at last.
    """
    alpha, beta, gamma, phi = (p[:, None] for p in parameters)
    size = SEASON + 3
    level = np.zeros((len(alpha), size))
    trend, season = np.zeros_like(level), np.zeros((SEASON, len(alpha), size))
    level[:, 0], trend[:, 1] = 1.0, 1.0
    for i in range(SEASON):
        season[i, :, 2 + i] = 1.0
    for t, value in enumerate(y):
        s = season[t % SEASON]
        damped = phi * trend
        base = level + damped
        yield base + s
        fresh = (1 - alpha) * base - alpha * s
        fresh[:, -1] += (alpha * value)[:, 0]
        trend = beta * (fresh - level) + (1 - beta) * damped
        s = (1 - gamma) * s - gamma * base
        s[:, -1] += (gamma * value)[:, 0]
        season[t % SEASON] = s
        level = fresh
    yield level, trend, season


def _best_starts(y: np.ndarray, parameters: tuple[np.ndarray, ...]):
    """Least-squares start state of each parameter set, the squared error it leaves, and the end states.

    Only the products of the columns are summed up while time goes by, so memory does not grow with the
    length of the series.
    """
    size = SEASON + 3
    products = np.zeros((len(parameters[0]), size, size))
    steps = _predictions(y, parameters)
    for value in y:
        row = next(steps)
        row[:, -1] = value - row[:, -1]  # what the start state has to explain
        products += row[:, :, None] * row[:, None, :]
    across, along, rest = products[:, :-1, :-1], products[:, :-1, -1], products[:, -1, -1]
    starts = np.einsum("cij,cj->ci", np.linalg.pinv(across, rcond=1e-10, hermitian=True), along)
    errors = rest - 2 * (along * starts).sum(axis=1) + np.einsum("ci,cij,cj->c", starts, across, starts)
    return starts, np.maximum(errors, 0.0), next(steps)


def fit_series(y: np.ndarray, rounds: int = 7) -> dict:
    """Least squared one-step error over parameters and start state together.

    The start state is solved for exactly, so the search only covers four numbers: a grid, then ever
    smaller boxes around the best set.
    """
    grid = itertools.product((0.03, 0.15, 0.4, 0.8), (0.02, 0.2, 0.6), (0.02, 0.2, 0.6), (0.2, 0.7, 0.95))
    tried = np.array(list(grid))
    steps = np.array(list(itertools.product((-1, 0, 1), repeat=4)))
    if not np.isfinite(y).all():
        raise ValueError("the series holds values that are not finite")
    best, best_error, width = tried[0], np.inf, np.array([0.2, 0.25, 0.25, 0.25])
    for _ in range(rounds):
        _, errors, _ = _best_starts(y, _to_parameters(tried))
        i = int(np.argmin(errors))
        if errors[i] < best_error:
            best, best_error = tried[i], errors[i]
        tried = np.clip(best + steps * width, 0.0, 1.0)
        width = width * 0.5
    parameters = _to_parameters(best[None, :])
    starts, _, (level, trend, season) = _best_starts(y, parameters)
    state = np.append(starts[0], 1.0)
    left = y - np.array([row[0] @ state for row, _ in zip(_predictions(y, parameters), y)])
    ahead = len(y) + np.arange(SEASON)
    alpha, beta, gamma, phi = (float(p[0]) for p in parameters)
    return {
        "alpha": alpha,
        "beta": beta,
        "gamma": gamma,
        "phi": phi,
        "level": float(level[0] @ state),
        "trend": float(trend[0] @ state),
        "season": [float(season[t % SEASON, 0] @ state) for t in ahead],
        "resid_std": float(np.std(left)),
        "sse": float(left @ left),
        "hours": len(y),
    }


def _fit_group(rows: pd.DataFrame, key: str, min_hours: int) -> pd.DataFrame:
    """States of one service; a series that is too short or cannot be fitted gives its status only."""
    columns = [key, *[c.split()[0] for c in STATES.split(", ")]]
    states = dict.fromkeys(columns) | {key: rows[key].iloc[0], "status": FAILED}
    try:
        hours = rows["hour"].to_numpy()
        y = np.zeros(int(hours.max() - hours.min()) + 1)
        states["hours"] = len(y)
        y[hours - hours.min()] = rows["value"].to_numpy(dtype=float)
        if len(y) < min_hours:
            states["status"] = TOO_SHORT
        else:
            states |= {"last_second": int(hours.max()) * 3600, **fit_series(y), "status": FITTED}
    except (ValueError, ArithmeticError, np.linalg.LinAlgError) as problem:
        log.warning("no forecast for %s: %s", states[key], problem)
    return pd.DataFrame([[states[c] for c in columns]], columns=columns)


# ---------------------------------------------------------------- Spark operators


def busiest(
    series: DataFrame, n: int, key: str = "service_name", measure: str = "request_count"
) -> DataFrame:
    """The ``n`` keys with the largest total; ties by key."""
    totals = series.groupBy(key).agg(F.sum(measure).alias("total"))
    return totals.orderBy(F.desc("total"), key).limit(n)


def fit_forecasts(
    series: DataFrame,
    top_n: int = 20,
    key: str = "service_name",
    bucket: str = "time_bucket",
    measure: str = "request_count",
    min_hours: int = MIN_HOURS,
) -> DataFrame:
    """One row of model states per service among the ``top_n`` busiest.

    ``status`` says whether the service was fitted, has fewer than ``min_hours`` hours, or failed. A group handed to Python is one service's hourly series, whose size is the time span.
    """
    chosen = series.join(busiest(series, top_n, key, measure).select(key), key, "left_semi")
    hour = F.call_function("div", F.unix_seconds(F.col(bucket)), F.lit(3600).cast("bigint"))
    series = chosen.select(key, hour.alias("hour"), F.col(measure).cast("double").alias("value"))
    key_type = chosen.schema[key].dataType.simpleString()
    # few rows but much work each: as many tasks as series, which size-based coalescing would undo
    return series.repartition(min(top_n, MAX_FIT_TASKS), key).groupBy(key).applyInPandas(
        lambda rows: _fit_group(rows, key, min_hours), f"{key} {key_type}, {STATES}"
    )


def forecast(
    states: DataFrame, horizon_hours: int = 24, level: float = 0.95, key: str = "service_name"
) -> DataFrame:
    """Mean and band for each of the next hours of every fitted service.

    The band has the width of the one-step error at every horizon, so it covers less than ``level``
    far ahead.
    """
    z = round(NormalDist().inv_cdf(0.5 + level / 2), 3)
    step = F.col("step")
    damping = F.col("phi") * (1 - F.pow("phi", step)) / (1 - F.col("phi"))
    mean = F.greatest(
        F.col("level")
        + damping * F.col("trend")
        + F.col("season")[F.pmod(step - 1, F.lit(SEASON)).cast("int")],
        F.lit(0.0),
    )
    return (
        states.where(F.col("status") == FITTED)
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon_hours))))
        .withColumns({"_mean": mean, "_half": F.col("resid_std") * z})
        .select(
            key,
            F.timestamp_seconds(F.col("last_second") + step * 3600).alias("time_bucket"),
            F.bround("_mean", 2).alias("forecast"),
            F.bround(F.greatest(F.col("_mean") - F.col("_half"), F.lit(0.0)), 2).alias("lower_bound"),
            F.bround(F.col("_mean") + F.col("_half"), 2).alias("upper_bound"),
        )
    )


def start_states(
    series: DataFrame, alpha: float, beta: float, gamma: float, phi: float, resid_std: float,
    key: str = "service_name", bucket: str = "time_bucket", measure: str = "request_count",
) -> DataFrame:
    """States with given parameters after the first season of a gap-free hourly series; shorter series have none."""
    value = F.col(measure).cast("double")
    first = series.agg(F.min(bucket)).scalar()
    day = series.where(F.col(bucket) < first + F.expr(f"INTERVAL {SEASON} HOURS"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(bucket).alias("t"), value.alias("v")))), lambda r: r["v"])
    held = day.groupBy(key).agg(F.avg(value).alias("level"), ordered.alias("_y"), F.max(F.unix_seconds(bucket)).alias("last_second"))
    fixed = {"alpha": alpha, "beta": beta, "gamma": gamma, "phi": phi, "resid_std": resid_std}
    return held.where(F.size("_y") == SEASON).select(
        key, "level", F.lit(0.0).alias("trend"), F.transform("_y", lambda y: y - F.col("level")).alias("season"), "last_second",
        F.lit(SEASON).alias("hours"), *[F.lit(float(v)).alias(n) for n, v in fixed.items()], F.lit(FITTED).alias("status"),
    )


def roll_forward(
    states: DataFrame, series: DataFrame, key: str = "service_name", bucket: str = "time_bucket", measure: str = "request_count"
) -> DataFrame:
    """The states after the hours of ``series`` that came since, with the parameters they have: no fit.

    Only those hours are read; each is one step of the recursion, a fold over the service's own new hours, whose
    number is the time since the fit. ``series`` has no gaps (``dense_grid``); a service that misses hours in it
    is marked as failed. Without new hours a state stays as it is, and so does one that never was fitted.
    """
    last = states.where(F.col("status") == FITTED).select(key, F.col("last_second").alias("_last"))
    second = F.unix_seconds(F.col(bucket))
    fresh = series.select(key, second.alias("_t"), F.col(measure).cast("double").alias("_v")).join(last, key).where("_t > _last")
    steps = fresh.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_t", "_v"))).alias("_new"))

    def step(state: Column, row: Column) -> Column:
        season, damped = state["season"], F.col("phi") * state["trend"]
        base = state["level"] + damped
        level = F.col("alpha") * (row["_v"] - season[0]) + (1 - F.col("alpha")) * base
        return F.struct(
            level.alias("level"),
            (F.col("beta") * (level - state["level"]) + (1 - F.col("beta")) * damped).alias("trend"),
            F.concat(
                F.slice(season, 2, SEASON - 1), F.array(F.col("gamma") * (row["_v"] - base) + (1 - F.col("gamma")) * season[0])
            ).alias("season"),
        )

    joined = states.join(steps, key, "left").withColumn("_new", F.coalesce("_new", F.array().cast("array<struct<_t:bigint,_v:double>>")))
    n = F.size("_new")
    until = F.coalesce(F.element_at("_new", F.when(n > 0, -1))["_t"], F.col("last_second"))
    # a lambda's state must have one type throughout
    begin = F.struct(F.col("level").cast("double").alias("level"), F.col("trend").cast("double").alias("trend"), F.col("season").cast("array<double>").alias("season"))
    rolled = joined.withColumns({"_state": F.aggregate("_new", begin, step), "_until": until})
    whole = F.coalesce(F.col("_until") - F.col("last_second") == n * 3600, F.lit(True))
    out = {
        **{c: F.col(f"_state.{c}") for c in ("level", "trend", "season")},
        "last_second": F.col("_until"), "hours": (F.col("hours") + n).cast("int"), "status": F.when(whole, F.col("status")).otherwise(FAILED),
    }
    return rolled.select(*[out.get(c, F.col(c)).alias(c) for c in states.columns])


STORED = "version string, fitted_at timestamp"


def store_states(states: DataFrame, path: str) -> None:
    """Keep fitted states in a folder of their own; the last write, one row in ``versions``, makes them the newest."""
    spark, version = states.sparkSession, uuid.uuid4().hex
    states.write.parquet(f"{path}/{version}/states")
    row = spark.createDataFrame([(version,)], "version string").withColumn("fitted_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(f"{path}/versions")


def stored_states(spark: SparkSession, path: str, max_age_days: float) -> DataFrame | None:
    """The newest stored states, unless they are older than ``max_age_days``."""
    try:
        versions = spark.read.schema(STORED).parquet(f"{path}/versions")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    age = (F.unix_micros(F.current_timestamp()) - F.unix_micros("fitted_at")) / 86_400_000_000
    newest = versions.withColumn("age", age).orderBy(F.desc("fitted_at"), "version").first()
    return spark.read.parquet(f"{path}/{newest['version']}/states") if newest and newest["age"] <= max_age_days else None


def current_states(
    series: DataFrame, path: str | None, top_n: int = 20, max_age_days: float = 7, key: str = "service_name", bucket: str = "time_bucket"
) -> DataFrame:
    """States of the ``top_n`` busiest services at the end of ``series``.

    Stored ones that are young enough, and that the series still follows without a gap, are rolled forward; only services
    without such states are fitted. A run in which all are fitted is stored.
    """
    held = stored_states(series.sparkSession, path, max_age_days) if path else None
    if held is None:
        states = materialize(fit_forecasts(series, top_n), "states")
        if path:
            store_states(states, path)
        return states
    chosen = materialize(busiest(series, top_n, key).select(key), "busiest")
    first = series.agg(F.min(F.unix_seconds(bucket))).scalar()
    usable = held.join(chosen, key, "left_semi").where((F.col("status") == FITTED) & (F.col("last_second") + 3600 >= first))
    rolled = materialize(roll_forward(usable, series, key, bucket).where(F.col("status") == FITTED), "rolled")
    rest = series.join(rolled.select(key), key, "left_anti").join(chosen, key, "left_semi")
    return rolled.unionByName(materialize(fit_forecasts(rest, top_n), "states"))


def _first_largest(row: Column, value: str, time: str = "time_bucket") -> Column:
    """``row`` where ``value`` is largest, the earliest of ties."""
    return F.max_by(row, F.struct(F.col(value), -F.unix_micros(time)))


def peak_windows(forecasts: DataFrame, key: str = "service_name") -> DataFrame:
    """Time and size of each service's largest forecast, highest first."""
    row = F.struct(F.col("time_bucket").alias("t"), "forecast", "upper_bound")
    return (
        forecasts.groupBy(key)
        .agg(_first_largest(row, "forecast").alias("p"))
        .select(
            key,
            F.col("p.t").alias("peak_time"),
            F.bround("p.forecast", 1).alias("peak_forecast"),
            F.bround("p.upper_bound", 1).alias("peak_upper_bound"),
        )
        .orderBy(F.desc("peak_forecast"), key)
    )


def upper_peaks(forecasts: DataFrame, key: str = "service_name") -> DataFrame:
    """Largest upper bound of each service and its first time."""
    return forecasts.groupBy(key).agg(
        F.max("upper_bound").alias("peak_upper"),
        _first_largest(F.col("time_bucket"), "upper_bound").alias("peak_time"),
    )


def capacity_headroom(
    forecasts: DataFrame, capacity: DataFrame | None = None, key: str = "service_name"
) -> DataFrame:
    """Room between the largest upper bound and capacity, tightest first.

    ``capacity`` has the key and ``capacity``; where it is unknown, half as much again as the peak is
    assumed.
    """
    peaks = upper_peaks(forecasts, key)
    if capacity is None:
        known = peaks.withColumn("capacity", F.lit(None).cast("double"))
    else:
        known = peaks.join(capacity.select(key, F.col("capacity").cast("double")), key, "left")
    current, peak = F.col("current"), F.col("peak_upper")
    room = F.when(current > 0, (current - peak) / F.nullif(current, F.lit(0.0)) * 100).otherwise(0.0)
    status = (
        F.when(F.col("room") < 10, "under_provisioned")
        .when(F.col("room") > 50, "over_provisioned")
        .otherwise("well_provisioned")
    )
    return (
        known.withColumn("current", F.coalesce("capacity", peak * 1.5))
        .withColumn("room", room)
        .select(
            key,
            F.bround(peak, 1).alias("peak_forecast_upper"),
            F.bround(current, 1).alias("current_capacity"),
            F.bround("room", 1).alias("headroom_pct"),
            status.alias("status"),
        )
        .orderBy("headroom_pct", key)
    )
