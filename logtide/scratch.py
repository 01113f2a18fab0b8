"""Written tables that cut lineage.

Anything read more than once, and every round of an iterative job, is written to the shared folder
named by ``spark.checkpoint.dir`` and read back. A lost executor then costs a re-read, not a re-run,
and each reader prunes columns for itself.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of this session; a local one is made up only for a local master."""
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="logtide-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_SCOPES: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables written within the block go to a folder of their own, which is deleted at its end."""
    _SCOPES.append(f"scope-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        path = f"{scratch_root(spark)}/logtide/{'/'.join(_SCOPES)}"
        _SCOPES.pop()
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call gets."""
    return "/".join([scratch_root(spark), "logtide", *_SCOPES, f"{name}-{uuid.uuid4().hex}"])


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and return a reader of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that never sends it whole to the driver and every executor.

    The size of a written table is that of its files, where repeated names and numbers take little room;
    in a broadcast they take many times as much, all of it on the driver first.
    """
    return df.hint("merge")
