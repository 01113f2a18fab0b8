"""Standardising feature tables against statistics of the whole table.

The statistics are one row, read through a scalar subquery: no window without partitions and no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.functions.scores import largest, min_max, z_value


def moments(table: DataFrame, columns: list[str]) -> DataFrame:
    """One row: number of rows, and mean and population deviation of each column, NULL as 0."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    return table.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.avg(v).alias(f"mean_{c}") for c, v in zip(columns, filled)],
        *[F.stddev_pop(v).alias(f"std_{c}") for c, v in zip(columns, filled)],
    )


def apply_moments(
    table: DataFrame, stats: DataFrame, columns: list[str], prefix: str = "z_"
) -> DataFrame:
    """Add ``prefix + column`` for every column, scaled by a ``moments`` row (own or stored)."""
    one = stats.select(F.struct("*")).scalar()
    scaled = table.withColumn("_m", one)
    return scaled.withColumns(
        {
            f"{prefix}{c}": z_value(
                F.coalesce(F.col(c).cast("double"), F.lit(0.0)),
                F.col("_m")[f"mean_{c}"],
                F.col("_m")[f"std_{c}"],
            )
            for c in columns
        }
    ).drop("_m")


def standardize(table: DataFrame, columns: list[str], prefix: str = "z_") -> DataFrame:
    """Zero mean, unit population deviation; a constant column becomes 0. ``table`` is read twice."""
    return apply_moments(table, moments(table, columns), columns, prefix)


def largest_z(columns: list[str], prefix: str = "z_") -> Column:
    return largest([F.abs(F.col(f"{prefix}{c}")) for c in columns])


def scale_scores(scored: DataFrame, raw: str, out: str = "anomaly_score") -> DataFrame:
    """Min-max scale one score column over the whole table, four decimals."""
    ends = scored.agg(F.struct(F.min(raw).alias("low"), F.max(raw).alias("high"))).scalar()
    return (
        scored.withColumn("_ends", ends)
        .withColumn(out, min_max(F.col(raw), F.col("_ends")["low"], F.col("_ends")["high"]))
        .drop("_ends")
    )
