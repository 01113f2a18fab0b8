"""Unusual hours on a stream: each closed hour is scored against its own service's hours before it.

A service's state is one row: how many hours it has had, and the mean and the summed squared deviations of every scored column
(Welford, 1962). Hours wait in a map until the watermark has passed their end, are taken in the order of time then, and
leave as scored rows; so hours that arrive out of order, in one batch or in several, give the same scores. An hour after the
watermark is late and changes nothing. A service without hours for ``idle`` loses its state, and starts anew when it returns.

State and progress are kept by the query's checkpoint: a batch that is done again starts from the state before it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from logtide.operators.anomalies import WINDOW_CUT, WINDOW_MIN_ROWS, WINDOW_SCORED
from logtide.session import ROCKSDB

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
IDLE = timedelta(days=30)
MOMENTS = "hours long, last long, means array<double>, squares array<double>"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within the block keep state in RocksDB, which timers and maps of state need."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def score_and_add(moments: tuple, at: int, values: list[float]) -> tuple[int, float, tuple]:
    """Hours before this one, its largest standard score against them, and the moments with it."""
    hours, _, means, squares = moments
    score = 0.0
    for x, mean, square in zip(values, means, squares):
        std = math.sqrt(square / hours) if hours else 0.0
        if std > 0:
            score = max(score, abs(x - mean) / std)
    moved = [mean + (x - mean) / (hours + 1) for x, mean in zip(values, means)]
    grown = [square + (x - mean) * (x - new) for x, mean, new, square in zip(values, means, moved, squares)]
    return hours, score, (hours + 1, at, moved, grown)


class HourScores(StatefulProcessor):
    """Scores of one service's hours; rows in are (key, time_bucket in ms, hour's end in ms, scored columns)."""

    def __init__(self, key: str, columns: list[str], idle: timedelta):
        self.out = Row(key, "_bucket", *columns, "hours_before", "_score")
        self.columns, self.idle = columns, int(idle.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.moments = handle.getValueState("moments", MOMENTS)
        self.waiting = handle.getMapState("waiting", "bucket long", "end long, scored array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        for row in rows:
            bucket, end = row["_bucket"], row["_end"]
            # an hour that comes twice waits once
            self.waiting.updateValue((bucket,), (end, [float(row[c] or 0.0) for c in self.columns]))
            self.handle.registerTimer(end)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        now = expiredTimerInfo.getExpiryTimeInMs()
        due = sorted((bucket[0], *value) for bucket, value in self.waiting.iterator() if value[0] <= now)
        moments = self.moments.get() if self.moments.exists() else None
        if moments is not None and not due and moments[1] + self.idle <= now:
            self.moments.clear()
            return
        if not due:  # an earlier timer has taken them
            return
        zero = [0.0] * len(self.columns)
        moments = moments or (0, 0, zero, zero)
        for bucket, end, values in due:
            self.waiting.removeKey((bucket,))
            if end - moments[1] >= self.idle:
                moments = (0, 0, zero, zero)
            hours, score, moments = score_and_add(moments, end, list(values))
            yield self.out(*key, bucket, *values, hours, score)
        self.moments.update(tuple(moments))
        self.handle.registerTimer(moments[1] + self.idle)


def stream_window_scores(
    hours: DataFrame,
    key: str = "service_name",
    columns: list[str] | None = None,
    cut: float = WINDOW_CUT,
    min_rows: int = WINDOW_MIN_ROWS,
    idle: timedelta = IDLE,
) -> DataFrame:
    """``(key, time_bucket, columns, hours_before, anomaly_score, is_anomaly)`` of hours with ``min_rows`` hours before them.

    ``hours`` is a stream of (key, time_bucket, closed, columns), with a watermark on ``closed``, the last instant of the hour,
    such as ``stream_closed_hours`` gives. Only hours with requests come, so hours without any are no part of the moments.
    Start the query within ``keyed_state``. A null value counts as 0, and rows without a key as a service of their own.
    """
    columns = columns or WINDOW_SCORED
    rows = hours.select(
        key, "closed", F.unix_millis("time_bucket").alias("_bucket"), (F.unix_millis("closed") + 1).alias("_end"),
        *[F.col(c).cast("double").alias(c) for c in columns],
    )
    kinds = ", ".join(
        [f"`{key}` {hours.schema[key].dataType.simpleString()}, _bucket long", *[f"`{c}` double" for c in columns], "hours_before long, _score double"]
    )
    scored = rows.groupBy(key).transformWithState(HourScores(key, columns, idle), kinds, "append", "eventTime")
    return (
        scored.where(F.col("hours_before") >= min_rows)
        .select(key, F.timestamp_millis("_bucket").alias("time_bucket"), *columns, "hours_before", F.bround("_score", 4).alias("anomaly_score"))
        .withColumn("is_anomaly", F.col("anomaly_score") > cut)
    )
