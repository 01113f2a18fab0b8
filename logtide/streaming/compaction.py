"""Small files of many batches merged into large ones, while readers and writers go on.

A store of ingested batches gets a file for each batch and day, so its files grow with the number of runs. ``compact`` merges the
batches since the last time into one generation, with files of the session's advisory size, and merges it with the newest generations as
long as those are no larger: a row is rewritten a logarithmic number of times, and few generations are left. A manifest names the live generations and the
last batch they hold. It is written last, as a version of its own; readers follow the newest complete version, so they see the old set
or the new set, never half of one. A compaction that dies leaves files that no manifest names, and the next one starts from the manifest again.

Batches up to the manifest's last one are read from generations only, so a batch must be complete, and not be written again with other
rows, once it is compacted: pass ``through`` to leave batches out that are still being written.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.sources.access_logs import PARTITIONS
from logtide.streaming.ingest import BATCH, store_schema

MANIFEST = "version long, generation string, first_batch long, last_batch long, row_count long"
DONE = "_SUCCESS"


@dataclass(frozen=True)
class Generation:
    generation: str
    first_batch: int
    last_batch: int
    row_count: int


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, files = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def _exists(spark: SparkSession, path: str) -> bool:
    folder, files = _files(spark, path)
    return files.exists(folder)


def read_manifest(spark: SparkSession, compacted: str) -> tuple[int, list[Generation]]:
    """Number of the newest complete version, 0 before the first, and its generations from old to new."""
    versions = sorted((int(n.split("=")[1]) for n in _names(spark, f"{compacted}/manifest") if n.startswith("version=")), reverse=True)
    for version in versions:
        path = f"{compacted}/manifest/version={version}"
        if _exists(spark, f"{path}/{DONE}"):
            # a logarithmic number of rows
            rows = spark.read.schema(MANIFEST.split(", ", 1)[1]).parquet(path).orderBy("first_batch").collect()
            return version, [Generation(*r) for r in rows]
    return 0, []


def _since(spark: SparkSession, store: str, rows: T.StructType, after: int) -> DataFrame:
    """Rows of the batches after the given one; only their folders are read."""
    return spark.read.schema(store_schema(rows)).parquet(store).where(F.col(BATCH) > after)


def read_compacted(spark: SparkSession, store: str, compacted: str, rows: T.StructType) -> DataFrame:
    """All rows of the store: live generations, and the batches after them. Filters on days prune both."""
    _, live = read_manifest(spark, compacted)
    found = _since(spark, store, rows, live[-1].last_batch if live else -1).drop(BATCH)
    layout = T.StructType([f for f in store_schema(rows).fields if f.name != BATCH])
    for one in live:
        found = found.unionByName(spark.read.schema(layout).parquet(f"{compacted}/{one.generation}"))
    return found


def _write(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", *[F.col(p) for p in PARTITIONS]).write.partitionBy(*PARTITIONS).parquet(path)


def compact(spark: SparkSession, store: str, compacted: str, rows: T.StructType, through: int | None = None) -> int:
    """Merge the batches up to ``through`` (default: all) that no generation holds; returns the number of live generations.

    One compaction at a time: two that end together would write the same version, and the second one stops with an error.
    """
    version, live = read_manifest(spark, compacted)
    after = live[-1].last_batch if live else -1
    fresh = _since(spark, store, rows, after)
    if through is not None:
        fresh = fresh.where(F.col(BATCH) <= through)
    seen = fresh.agg(F.min(BATCH).alias("first"), F.max(BATCH).alias("last"), F.count(F.lit(1)).alias("n")).first()
    if not seen["n"]:
        return len(live)
    merged, parts, count, first = list(live), [fresh.drop(BATCH)], seen["n"], seen["first"]
    layout = parts[0].schema
    while merged and merged[-1].row_count <= count:
        old = merged.pop()
        parts.append(spark.read.schema(layout).parquet(f"{compacted}/{old.generation}"))
        count, first = count + old.row_count, old.first_batch
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    name = f"generation-{uuid.uuid4().hex}"
    _write(table, f"{compacted}/{name}")
    merged.append(Generation(name, first, seen["last"], count))
    publish(spark, compacted, version + 1, merged)
    return len(merged)


def publish(spark: SparkSession, compacted: str, version: int, live: list[Generation]) -> None:
    """Make a set of generations the one that readers see."""
    table = spark.createDataFrame([(version, g.generation, g.first_batch, g.last_batch, g.row_count) for g in live], MANIFEST)
    path = f"{compacted}/manifest/version={version}"
    # what a compaction that died while it wrote this version has left is written over, a complete version is not
    mode = "errorifexists" if _exists(spark, f"{path}/{DONE}") else "overwrite"
    table.drop("version").coalesce(1).write.mode(mode).parquet(path)


def remove_obsolete(spark: SparkSession, compacted: str) -> list[str]:
    """Delete generations that the newest manifest does not name; run it when no older reader is left and no compaction runs."""
    version, live = read_manifest(spark, compacted)
    keep = {g.generation for g in live}
    gone = [n for n in _names(spark, compacted) if n.startswith("generation-") and n not in keep] if version else []
    for name in gone:
        folder, files = _files(spark, f"{compacted}/{name}")
        files.delete(folder, True)
    return gone
