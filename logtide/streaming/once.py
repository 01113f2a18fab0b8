"""De-duplication across runs: each record enters the store once, whichever run brings it again.

Every batch leaves, for each day, a blocked Bloom filter of its keys (Putze, Sanders and Singler, 2007): all bits of a key lie in
one block of 32,768 bits, a stored bitmap of 4 kB. A new row meets the one block of each earlier batch of its day; a row whose bits are
not all set is new for certain. The others, few but for true repeats, are settled by a join with the store, of which
only the days of such rows are opened. So a run reads filters in proportion to its own days, and old rows only where it must.

A batch's rows go to the store first and its filters last, both by overwrite: a replayed batch replaces what it wrote, and reads
only filters of earlier batches. Of equal records the earliest batch's stays, within a batch the first by ``order``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.operators.normalize import DEDUPE_KEYS, dedupe
from logtide.scratch import materialize
from logtide.streaming.ingest import BATCH, store_schema, write_batch

BLOCK_BITS = 32_768
#: Keys for one block and bits for each key: about one row in 1,400 is looked up for nothing, for each earlier batch of its day.
KEYS_PER_BLOCK, BITS_PER_KEY = 2048, 8
FILTERS = "day date, block long, bits binary, blocks long, batch_id long"


def _hash(keys: list[str], salt: int) -> Column:
    return F.xxhash64(F.lit(salt), *[F.col(k) for k in keys])


def _positions(keys: list[str]) -> Column:
    """The bits of a key within its block, by double hashing."""
    one, two = F.pmod(_hash(keys, 1), F.lit(BLOCK_BITS)), F.pmod(_hash(keys, 2), F.lit(BLOCK_BITS // 2)) * 2 + 1
    return F.array(*[F.pmod(one + two * i, F.lit(BLOCK_BITS)) for i in range(BITS_PER_KEY)])


def _block(keys: list[str], blocks: Column) -> Column:
    return F.pmod(_hash(keys, 0), blocks)


def _set(bits: Column, position: Column) -> Column:
    """Whether a bitmap has the bit, as ``bitmap_construct_agg`` lays bits out."""
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, F.pmod(position, F.lit(8)).cast("int")) == 1


def _day(time: str) -> Column:
    return F.to_date(time)


def make_filters(rows: DataFrame, keys: list[str], time: str = "timestamp") -> DataFrame:
    """``(day, block, bits, blocks)``: the filter of each day, with blocks in proportion to the day's rows. ``rows`` is read twice."""
    sizes = rows.groupBy(_day(time).alias("day")).agg(F.ceil(F.count(F.lit(1)) / KEYS_PER_BLOCK).alias("blocks"))
    placed = rows.select(_day(time).alias("day"), *keys).join(F.broadcast(sizes), "day")  # a row for each day
    bit = placed.select("day", "blocks", _block(keys, F.col("blocks")).alias("block"), F.explode(_positions(keys)).alias("bit"))
    return bit.groupBy("day", "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def read_filters(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(FILTERS).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILTERS)


def perhaps_known(rows: DataFrame, filters: DataFrame, keys: list[str], time: str = "timestamp") -> DataFrame:
    """The rows that some filter of their day has all bits of; each once."""
    generations = filters.select("day", BATCH, "blocks").distinct()  # a row for each day and batch
    met = rows.withColumn("day", _day(time)).join(F.broadcast(generations), "day")
    met = met.withColumn("block", _block(keys, F.col("blocks")))
    hit = met.join(filters.drop("blocks"), ["day", BATCH, "block"]).where(F.forall(_positions(keys), lambda p: _set(F.col("bits"), p)))
    return hit.select(*rows.columns).dropDuplicates(keys)


def add_once(
    rows: DataFrame, batch: int, store: str, filters: str, keys: list[str] | None = None, order: list[str] | None = None, time: str = "timestamp"
) -> list:
    """Write those rows of a batch that no earlier batch has; returns the days of the store that were opened for it."""
    spark = rows.sparkSession
    keys = [k for k in (keys or DEDUPE_KEYS) if k in rows.columns]
    fresh = materialize(dedupe(rows, keys, order), "fresh")
    known = read_filters(spark, filters).where(F.col(BATCH) < batch)
    doubtful = materialize(perhaps_known(fresh, known, keys, time), "doubtful")
    days = sorted(r["day"] for r in doubtful.select(_day(time).alias("day")).distinct().collect())  # calendar days
    if days:
        held = read_store(spark, store, fresh.schema).where(F.make_date("year", "month", "day").isin(days) & (F.col(BATCH) < batch))
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
        repeats = doubtful.alias("n").join(held.select(*keys).alias("o"), same, "left_semi").select(*keys)
        pairs = [F.col(f"f.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
        fresh = materialize(fresh.alias("f").join(repeats.alias("r"), pairs, "left_anti"), "new")
    write_batch(fresh, batch, store)
    make_filters(fresh, keys, time).write.mode("overwrite").parquet(f"{filters}/{BATCH}={batch}")
    return days


def read_store(spark: SparkSession, store: str, rows: T.StructType) -> DataFrame:
    return spark.read.schema(store_schema(rows)).parquet(store)
