import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.operators.features import hourly_traffic
from logtide.operators.numbering import numbered
from logtide.operators.percentiles import exact_percentiles
from logtide.streaming.partials import add_batch, distinct_users, latency_percentiles, read_partials

SCHEMA = "service_name string, timestamp timestamp, status_code int, latency_ms double, bytes_response double, user_id string"


def logs(spark, n, seed=1):
    rng, begin = random.Random(seed), datetime(2024, 1, 1)
    rows = [
        (
            rng.choice(["a", "a", "b", None]), begin + timedelta(minutes=rng.randrange(300)), rng.choice([200, 200, 404, 500, None]),
            rng.choice([None, float("nan"), 1.0, 1.0, rng.random() * 100]), rng.choice([None, 10.5, 3.0]), rng.choice([None, *map(str, range(60))]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA).withColumn("part", (F.monotonically_increasing_id() % 3).cast("int"))


def hours(df):
    columns = ["service_name", "time_bucket", "request_count", "error_rate", "latency_p50", "latency_p95", "bytes_total", "unique_users"]
    return {(r[0], r[1]): r[2:] for r in map(tuple, df.where("service_name IS NOT NULL").select(*columns).collect())}


def same(got, want):
    assert got.keys() == want.keys()
    assert all(a == pytest.approx(want[k], rel=1e-9) for k, a in got.items())


def test_batches_add_up_to_the_whole(spark, tmp_path):
    rows, store = logs(spark, 900).cache(), str(tmp_path)
    whole = hours(hourly_traffic(rows))
    for batch in range(3):
        add_batch(rows.where(F.col("part") == batch), store, batch)
        if batch < 2:
            same(hours(read_partials(spark, store)), hours(hourly_traffic(rows.where(F.col("part") <= batch))))
    same(hours(read_partials(spark, store)), whole)
    add_batch(rows.where(F.col("part") == 1), store, 1)  # a replay
    same(hours(read_partials(spark, store)), whole)


def test_coarser_groups_come_from_the_same_tables(spark, tmp_path):
    rows, store = logs(spark, 600, 2).cache(), str(tmp_path)
    for batch in range(3):
        add_batch(rows.where(F.col("part") == batch), store, batch)
    got = dict(map(tuple, distinct_users(spark, store, ["service_name"]).collect()))
    assert got == dict(map(tuple, rows.groupBy("service_name").agg(F.count_distinct("user_id")).collect()))
    quantiles = {"p10": 0.1, "p99": 0.99}
    read = lambda df: sorted(map(tuple, df.collect()))
    want = read(exact_percentiles(rows, ["service_name"], "latency_ms", quantiles))
    assert np.allclose([r[1:] for r in read(latency_percentiles(spark, store, ["service_name"], quantiles))], [r[1:] for r in want])


def test_codes_have_no_gaps(spark, tmp_path):
    store = str(tmp_path)
    first = spark.createDataFrame([("a", datetime(2024, 1, 1), 200, 1.0, 1.0, f"u{k % 7}") for k in range(50)], SCHEMA)
    second = spark.createDataFrame([("a", datetime(2024, 1, 1), 200, 1.0, 1.0, f"u{k % 11}") for k in range(50)], SCHEMA)
    add_batch(first.repartition(3), store, 0)
    add_batch(second.repartition(4), store, 1)
    codes = sorted(r.code for r in spark.read.parquet(f"{store}/codes").collect())
    assert codes == list(range(11))
    add_batch(first.limit(0), store, 2)
    assert read_partials(spark, store).first().unique_users == 11
    assert sorted(r.n for r in numbered(first.repartition(5), "n", 3).collect()) == list(range(3, 53))


def test_before_the_first_batch(spark, tmp_path):
    assert read_partials(spark, str(tmp_path / "none")).count() == 0
