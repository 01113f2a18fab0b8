"""Session set-up shared by the bench, the tests and the registered queries."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_utc(spark: SparkSession) -> SparkSession:
    """Bucket, parse and print every instant in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app: str = "logtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # exact sketches and percentiles keep one buffer per group; many services is normal
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
        # keys of a day of streaming de-duplication do not fit on the heap
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_SHIPPED = "logtide.shipped"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application, so that Python steps can import it there.

    Not needed where the package is installed on every node; harmless there.
    """
    if os.environ.get(_SHIPPED) == spark.sparkContext.applicationId:
        return spark
    root = os.path.dirname(os.path.abspath(__file__))
    # the driver serves the file from here as long as it runs
    folder = tempfile.mkdtemp(prefix="logtide-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "logtide.zip")
    with zipfile.ZipFile(path, "w") as package:
        for place, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(place, name)
                package.write(file, os.path.join("logtide", os.path.relpath(file, root)))
    spark.sparkContext.addPyFile(path)
    os.environ[_SHIPPED] = spark.sparkContext.applicationId
    return spark
