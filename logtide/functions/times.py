"""Time expressions. All of them expect a UTC session (``logtide.session.use_utc``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TICKS_PER_SECOND = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}


def to_instant(column: Column, dtype: T.DataType, unit: str = "ns") -> Column:
    """Read a timestamp out of any column type; what cannot be read becomes NULL.

    Texts are read per row in the ISO forms, without a zone as UTC. Numbers are epoch ticks of ``unit``.
    """
    if isinstance(dtype, T.TimestampType):
        return column
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp")
    if isinstance(dtype, T.StringType):
        # a bare time of day, with its colon up front, would be read as today's
        return F.when(~F.instr(F.ltrim(column), ":").between(1, 5), F.try_to_timestamp(column))
    if isinstance(dtype, T.IntegralType):
        ticks = TICKS_PER_SECOND[unit]
        ticks_in = column.cast("bigint")
        if ticks > 1_000_000:
            per_micro = F.lit(ticks // 1_000_000).cast("bigint")
            micros = F.call_function("div", ticks_in - F.pmod(ticks_in, per_micro), per_micro)
        else:
            micros = F.try_multiply(ticks_in, F.lit(1_000_000 // ticks).cast("bigint"))
        return F.timestamp_micros(micros)
    if isinstance(dtype, T.NumericType):
        micros = F.floor(column.cast("double") / F.lit(TICKS_PER_SECOND[unit]) * 1e6)
        return F.timestamp_micros(micros.try_cast("bigint"))
    return F.lit(None).cast("timestamp")


def bucket_start(time: Column, freq: str = "1 hour") -> Column:
    """Start of the tumbling bucket of length ``freq`` that holds ``time``."""
    return F.window(time, freq)["start"]


def hours_between(first: Column, last: Column) -> Column:
    return (F.unix_micros(last) - F.unix_micros(first)) / F.lit(3.6e9)


def monday_based_weekday(time: Column) -> Column:
    """0 = Monday … 6 = Sunday."""
    return F.weekday(time)
