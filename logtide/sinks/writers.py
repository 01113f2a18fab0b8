"""Partitioned log stores, raw-file conversion and JSON reports."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.operators.normalize import normalize_logs
from logtide.sources.access_logs import PARTITIONS

log = logging.getLogger(__name__)


def with_day_partitions(logs: DataFrame, time: str = "timestamp") -> DataFrame:
    """Calendar columns of the store layout, in UTC."""
    return logs.withColumns({"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time)})


def write_logs(
    logs: DataFrame,
    root: str,
    time: str = "timestamp",
    compression: str = "snappy",
    mode: str = "overwrite",
    files_per_day: int | None = None,
) -> None:
    """Write ``year=/month=/day=`` Parquet; overwriting replaces only the days that occur in ``logs``.

    Rows are gathered by day before writing, so a task does not open a file per day. Adaptive execution
    splits large days; ``files_per_day`` fixes the split instead, by a hash of the row's time.
    """
    table = with_day_partitions(logs, time)
    if files_per_day:
        part = F.pmod(F.xxhash64(time), F.lit(files_per_day))
        table = table.repartition(*PARTITIONS, part)
    else:
        table = table.hint("rebalance", *[F.col(p) for p in PARTITIONS])
    (
        table.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*PARTITIONS)
        .parquet(root)
    )


def convert_raw(
    spark: SparkSession,
    source: str,
    fmt: str,
    schema: T.StructType,
    root: str,
    order: list[str] | None = None,
    **options: str,
) -> DataFrame:
    """Read raw CSV or JSON files, normalise them and write a partitioned Parquet store."""
    raw = spark.read.format(fmt).schema(schema).options(**options).load(source)
    logs = normalize_logs(raw, order=order)
    write_logs(logs, root)
    return spark.read.schema(with_day_partitions(logs).schema).parquet(root).drop(*PARTITIONS)


def report_name(now: datetime | None = None) -> str:
    return f"report_{(now or datetime.now(tz=timezone.utc)).strftime('%Y%m%d_%H%M%S')}.json"


def write_report(report: DataFrame, folder: str, name: str | None = None, copy_to: str | None = None) -> str:
    """Write the one-row report as JSON below ``folder``; a second copy may fail without harm."""
    path = f"{folder.rstrip('/')}/{name or report_name()}"
    # written once, then copied from there: the plan behind the report does not run again
    report.coalesce(1).write.mode("overwrite").json(path)
    if copy_to:
        spark = report.sparkSession
        try:
            spark.read.text(path).coalesce(1).write.mode("overwrite").text(
                f"{copy_to.rstrip('/')}/{path.rsplit('/', 1)[1]}"
            )
        except Exception as problem:  # best effort by contract
            log.warning("second copy of the report failed: %s", problem)
    return path
