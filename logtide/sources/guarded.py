"""Scan-size guard and stored query results."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MB = 1024 * 1024
DOLLARS_PER_TB = 5.0


class ScanLimitExceeded(RuntimeError):
    pass


def scan_size(files: DataFrame) -> DataFrame:
    """Files, megabytes and estimated cost of listed files, ``(path, bytes, …)``, after any filter on them.

    ``listed_files`` has the partition columns, so the filter of a scan also prunes the listing, and no
    data is read.
    """
    mb = F.coalesce(F.sum("bytes"), F.lit(0)) / F.lit(float(MB))
    return files.agg(F.count(F.lit(1)).alias("files"), mb.alias("scan_mb")).withColumn(
        "est_cost_usd", F.col("scan_mb") / MB * DOLLARS_PER_TB
    )


def guard_scan(files: DataFrame, max_mb: float = 1000) -> float:
    """Megabytes of the listed files, or an error if they are over ``max_mb``; before the scan is paid."""
    mb = scan_size(files).first()["scan_mb"]
    if mb > max_mb:
        raise ScanLimitExceeded(
            f"scan of {mb:.0f} MB is over the limit of {max_mb} MB; add partition filters"
        )
    return mb


def input_mark(files: DataFrame) -> str | None:
    """Number, total size and a hash of the listed files' paths and sizes; None if there is no file."""
    row = files.agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b"), F.bit_xor(F.xxhash64("path", "bytes")).alias("x")
    ).first()
    return "|".join(str(v) for v in row) if row["n"] else None


def result_key(text: str, mark: str) -> str:
    """Key of a stored result: query text and state of its input files, so new data is a miss."""
    return hashlib.sha256(f"{text}\n{mark}".encode()).hexdigest()[:16]


def cached_result(query: DataFrame, text: str, files: DataFrame | None, cache_dir: str, use_cache: bool = True) -> DataFrame:
    """``query``, read back from ``cache_dir`` if ``text`` ran on the same ``files`` before.

    ``files`` lists what the query reads, after pruning. Without files nothing is known of the inputs'
    state, and nothing is stored. A folder counts only with the mark of a finished write.
    """
    mark = input_mark(files) if files is not None else None
    if mark is None:
        return query
    spark = query.sparkSession
    path = f"{cache_dir.rstrip('/')}/{result_key(text, mark)}"
    if not (use_cache and _finished(spark, path)):
        query.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return spark.read.schema(query.schema).parquet(path)


def _finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has ended."""
    try:
        return not spark.read.format("binaryFile").load(f"{path}/_SUCCESS").select("path").isEmpty()
    except AnalysisException:
        return False


def cached_query(spark: SparkSession, sql: str, cache_dir: str, use_cache: bool = True) -> DataFrame:
    """Result of ``sql`` over files, stored by its text and the files it may read (without pruning)."""
    query = spark.sql(sql)
    paths = query.inputFiles()
    files = None
    if paths:
        roots = sorted({p.rsplit("/", 1)[0] for p in paths})  # folders, not files
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(roots)
        files = files.select("path", F.concat_ws("|", "length", "modificationTime").alias("bytes"))
        files = files.withColumn("bytes", F.xxhash64("bytes") % 1_000_000_007)
    return cached_result(query, sql, files, cache_dir, use_cache)
