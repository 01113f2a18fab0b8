"""Exact, interpolated percentiles that no single task has to hold.

The built-in ``percentile`` keeps every distinct value of a group in one buffer, and sketches of a hot
group all meet in one task. So the wanted ranks are found digit by digit, for tables of any size alike:
values are counted per coarse slice of the number line, then only those in a slice that holds a wanted
rank are counted per fine slice, then per value. Every count is combined on the map side and spread over the cluster by slice, and what one task
sorts is bounded whatever the data: the slices of a key, at most 2**22 fine slices, or the at most 2**22
doubles that share a fine slice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# 52 bits of a double follow its power of two
COARSE_BITS = 8
FINE_BITS = 22
INFINITE_SLICE = 2**40


def _slices(value: Column) -> tuple[Column, Column]:
    """Coarse and fine slice of a double: power of two and leading bits, then the following bits.

    Scaling by a power of two is exact, so both are monotone in the value even where the logarithm is
    off by one near a power.
    """
    size, sign = F.abs(value), F.signum(value).cast("bigint")
    power = F.floor(F.log2(size))
    lead = (size / F.pow(F.lit(2.0), power) - 1) * float(2**COARSE_BITS)
    coarse = (power + 1100) * 2**COARSE_BITS + F.floor(lead)
    fine = F.floor((lead - F.floor(lead)) * float(2**FINE_BITS))
    infinite = size == float("inf")
    return (
        F.when(value == 0, 0).otherwise(sign * F.when(infinite, INFINITE_SLICE).otherwise(coarse)),
        F.when((value == 0) | infinite, 0).otherwise(sign * fine),
    )


def _ranks(quantiles: list[float]) -> dict[str, Column]:
    """0-based ranks below and above each quantile among ``_n`` values."""
    out = {}
    for i, q in enumerate(quantiles):
        position = F.lit(q) * (F.col("_n") - 1)
        out[f"_r{2 * i}"], out[f"_r{2 * i + 1}"] = F.floor(position), F.ceil(position)
    return out


def _narrow(counted: DataFrame, within: list[str], by: str, ranks: list[str]) -> DataFrame:
    """Rows of ``counted`` that hold a wanted rank, with that rank inside the row, else NULL."""
    group = Window.partitionBy(*within)
    before = F.sum("_c").over(group.orderBy(by).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")
    placed = counted.withColumn("_before", before)
    inside = {
        r: F.when(
            (F.col(r) >= F.col("_before")) & (F.col(r) < F.col("_before") + F.col("_c")),
            F.col(r) - F.col("_before"),
        )
        for r in ranks
    }
    wanted = reduce(lambda a, b: a | b, [F.col(r).isNotNull() for r in ranks])
    return placed.withColumns(inside).where(wanted).drop("_before", "_c")


def _count_within(
    values: DataFrame, wanted: DataFrame, keys: list[str], slices: list[str], by: str, ranks: list[str]
) -> DataFrame:
    """Counts per ``by`` of the values in the wanted slices.

    Grouping by the key as a struct, not by the joined columns, puts the exchange after the map-side
    combine, so a skewed join partition may be split.
    """
    near = values.join(wanted.select("_k.*", *slices, "_n", *ranks), [*keys, *slices])
    return near.groupBy("_k", *dict.fromkeys([*slices, by])).agg(
        F.sum("_w").alias("_c"), F.max("_n").alias("_n"), *[F.max(r).alias(r) for r in ranks]
    )


def exact_percentiles(df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """One row per key: the percentiles of the non-null values under the given output names.

    ``df`` is read three times, with the key and value columns only: pass a stored table. A key without
    values has no row, nor has a NULL key.
    """
    value_column = F.col(value).cast("double")
    values = df.select(*keys, value_column.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return percentiles_by_rank(values.dropna(subset=keys) if keys else values, keys, quantiles)


def percentiles_by_rank(values: DataFrame, keys: list[str], quantiles: dict[str, float]) -> DataFrame:
    """Percentiles of the column ``_v`` per key, for groups of any size. ``_w``, if there, says how often a value counts."""
    named = keys or ["_all"]
    values = values.withColumn("_all", F.lit(0))
    if "_w" not in values.columns:
        values = values.withColumn("_w", F.lit(1).cast("long"))
    coarse, fine = _slices(F.col("_v"))
    values = values.select(
        *named, "_v", "_w", F.struct(*named).alias("_k"), coarse.alias("_s"), fine.alias("_f")
    )
    rank_of = _ranks(list(quantiles.values()))
    ranks = list(rank_of)

    first = values.groupBy("_k", "_s").agg(F.sum("_w").alias("_c"))
    first = first.withColumn("_n", F.sum("_c").over(Window.partitionBy("_k"))).withColumns(rank_of)
    wanted = _narrow(first, ["_k"], "_s", ranks)
    second = _count_within(values, wanted, named, ["_s"], "_f", ranks)
    wanted = _narrow(second, ["_k", "_s"], "_f", ranks)
    third = _count_within(values, wanted, named, ["_s", "_f"], "_v", ranks)
    found = _narrow(third, ["_k", "_s", "_f"], "_v", ranks)

    at = [F.max(F.when(F.col(r).isNotNull(), F.col("_v"))) for r in ranks]
    picked = found.groupBy("_k").agg(
        F.max("_n").alias("_n"), *[v.alias(r) for v, r in zip(at, ranks)]
    )
    out = []
    for i, (name, q) in enumerate(quantiles.items()):
        low, high = F.col(ranks[2 * i]), F.col(ranks[2 * i + 1])
        position = F.lit(q) * (F.col("_n") - 1)
        share = position - F.floor(position)
        # equal neighbours, infinite ones included, need no interpolation
        out.append(F.when(low == high, low).otherwise(low + (high - low) * share).alias(name))
    return picked.select(*[F.col(f"_k.{k}") for k in keys], *out)


def approx_percentiles(value: str, quantiles: dict[str, float], accuracy: int = 10_000) -> list[Column]:
    """Sketch percentiles as plain aggregates: one pass, a data point instead of an interpolation."""
    return [
        F.coalesce(F.percentile_approx(value, q, accuracy), F.lit(0.0)).alias(name)
        for name, q in quantiles.items()
    ]
