import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logtide.operators.normalize import DEDUPE_KEYS, dedupe
from logtide.streaming.once import add_once, make_filters, perhaps_known, read_filters, read_store

SCHEMA = "event_id long, timestamp timestamp, service_name string, endpoint string, instance_id string"


def logs(spark, n, ids, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        t = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(96))
        rows.append((ids + k, t, rng.choice("ab"), rng.choice(["/x", "/y"]), rng.choice(["p", "q", None])))
    return spark.createDataFrame(rows, SCHEMA)


def read(df):
    return sorted(map(str, df.select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect()))


def test_runs_equal_one_deduplication(spark, tmp_path):
    store, filters = str(tmp_path / "s"), str(tmp_path / "f")
    batches = [logs(spark, 300, 1000 * b, b) for b in range(3)]
    for number, rows in enumerate(batches):
        add_once(rows.repartition(3), number, store, filters, order=["event_id"])
    whole = dedupe(batches[0].unionByName(batches[1]).unionByName(batches[2]), order=["event_id"])
    assert read(read_store(spark, store, whole.schema)) == read(whole)
    add_once(batches[1], 1, store, filters, order=["event_id"])  # a replay
    assert read(read_store(spark, store, whole.schema)) == read(whole)
    assert add_once(batches[0].limit(0), 3, store, filters, order=["event_id"]) == []
    assert read(read_store(spark, store, whole.schema)) == read(whole)


def test_only_days_with_repeats_are_opened(spark, tmp_path):
    store, filters = str(tmp_path / "s"), str(tmp_path / "f")
    rows = [(k, datetime(2024, 1, 1 + k % 4, 5, k // 4), "a", f"/{k}", "p") for k in range(200)]
    first = spark.createDataFrame(rows, SCHEMA)
    assert add_once(first, 0, store, filters) == []
    again = spark.createDataFrame([(900, *rows[1][1:]), (901, *rows[5][1:]), (902, datetime(2024, 1, 3, 9), "a", "/new", "p")], SCHEMA)
    assert [str(d) for d in add_once(again, 1, store, filters)] == ["2024-01-02"]
    assert read_store(spark, store, first.schema).count() == 201


def test_filters_miss_no_key_and_doubt_few_others(spark, tmp_path):
    rows = logs(spark, 10, 0, 1).drop("event_id").crossJoin(spark.range(600)).withColumn("endpoint", F.col("id").cast("string")).drop("id")
    rows = rows.dropDuplicates(DEDUPE_KEYS).cache()
    path = str(tmp_path)
    make_filters(rows, DEDUPE_KEYS).write.parquet(f"{path}/batch_id=0")
    filters = read_filters(spark, path)
    assert perhaps_known(rows, filters, DEDUPE_KEYS).count() == rows.count()
    others = rows.withColumn("endpoint", F.concat(F.lit("other"), "endpoint"))
    assert perhaps_known(others, filters, DEDUPE_KEYS).count() < 0.005 * rows.count()
