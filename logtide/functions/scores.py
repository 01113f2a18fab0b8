"""Numeric expressions shared by the scaling, anomaly and report operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable_deviation(mean: Column, deviation: Column) -> Column:
    """``deviation``, or NULL where it is nothing but floating-point noise around ``mean``."""
    floor = F.greatest(F.lit(1.0), F.abs(mean)) * 1e-12
    return F.when(deviation > floor, deviation)


def z_value(value: Column, mean: Column, deviation: Column) -> Column:
    """Standard score; a constant column scores 0."""
    return F.coalesce((value - mean) / usable_deviation(mean, deviation), F.lit(0.0))


def largest(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.greatest(*columns)


def min_max(score: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1], four decimals; equal scores become 0."""
    return F.bround((score - low) / (high - low + 1e-8), 4)


def share(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 where there is no whole."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def first_match(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """Text of the first rule that holds."""
    chain = reduce(lambda acc, rule: acc.when(*rule), rules[1:], F.when(*rules[0]))
    return chain.otherwise(otherwise)
