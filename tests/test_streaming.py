from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logtide.operators.features import hourly_traffic
from logtide.operators.normalize import DEDUPE_KEYS, normalize_logs, normalize_rows
from logtide.streaming import ingest as si
from logtide.streaming import rollup as ro

T0 = datetime(2024, 1, 1)
RAW = "n int, ts timestamp, svc string, status int, latency double, bytes_sent double, user string"


def rows(spark, start, count, offset=0):
    data = [
        (offset + i, start + timedelta(minutes=7 * i), f"s{i % 3}", 500 if i % 5 == 0 else 200, float(i % 11), 5.0, f"u{i % 4}")
        for i in range(count)
    ]
    return spark.createDataFrame(data, RAW)


def add_file(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def test_batches_late_file_and_replay_equal_the_batch_result(spark, tmp_path):
    raw, store, rollup, progress = (str(tmp_path / n) for n in ("raw", "store", "rollup", "progress"))
    first = rows(spark, T0, 300)
    parts = [
        first.where("n < 150"),
        first.where("n >= 150"),
        first.where("n % 10 = 0").withColumn("n", F.col("n") + 1000),  # copies, a day late
        rows(spark, T0 - timedelta(days=2), 50, 5000),  # late rows of earlier days
    ]
    for part in parts:
        add_file(part, raw)
        stream = si.read_new_files(spark, raw, first.schema)
        ro.update_rollup(stream, store, rollup, progress, ["n"])
    expected = hourly_traffic(normalize_logs(spark.read.parquet(raw), order=["n"]))
    columns = expected.columns
    want = sorted(expected.collect())
    assert sorted(ro.read_rollup(spark, rollup).select(*columns).collect()) == want
    # the same files again under a lost checkpoint: batches are written over, not added
    before = spark.read.parquet(store).count()
    ro.update_rollup(si.read_new_files(spark, raw, first.schema), store, rollup, str(tmp_path / "p2"), ["n"])
    assert sorted(ro.read_rollup(spark, rollup).select(*columns).collect()) == want
    assert spark.read.parquet(store).count() >= before


def test_each_touched_day_is_refreshed_once_a_run(spark, tmp_path, monkeypatch):
    raw, store, rollup, progress = (str(tmp_path / n) for n in ("raw", "store", "rollup", "progress"))
    refreshed = []
    plain = ro.refresh_days
    monkeypatch.setattr(ro, "refresh_days", lambda s, st, r, days, *rest: (refreshed.append(len(days)), plain(s, st, r, days, *rest)))
    three_days = rows(spark, T0, 600)
    for k in range(5):
        add_file(three_days.where(F.col("n") % 5 == k), raw)

    def update():
        stream = si.read_new_files(spark, raw, three_days.schema, max_files_per_batch=1)
        return len(ro.update_rollup(stream, store, rollup, progress, ["n"]))

    assert (update(), refreshed) == (3, [3])  # five batches touch each day
    assert (update(), refreshed) == (0, [3])
    add_file(rows(spark, T0 + timedelta(days=1), 5, 9000), raw)
    assert (update(), refreshed) == (1, [3, 1])
    expected = hourly_traffic(normalize_logs(spark.read.parquet(raw), order=["n"]))
    assert sorted(ro.read_rollup(spark, rollup).select(*expected.columns).collect()) == sorted(expected.collect())


def test_only_new_files_are_read(spark, tmp_path):
    raw, store, progress = (str(tmp_path / n) for n in ("raw", "store", "progress"))
    seen = []

    def ingest():
        stream = normalize_rows(si.read_new_files(spark, raw, rows(spark, T0, 1).schema))

        def handle(batch, number):
            seen.append(batch.count())
            si.write_batch(batch, number, store)

        si.run_available(stream, handle, progress)

    add_file(rows(spark, T0, 10), raw)
    ingest()
    add_file(rows(spark, T0 - timedelta(days=9), 4), raw)
    ingest()
    ingest()
    assert seen == [10, 4] and spark.read.parquet(store).count() == 14


def test_a_failed_batch_is_done_again(spark, tmp_path):
    raw, store, progress = (str(tmp_path / n) for n in ("raw", "store", "progress"))
    add_file(rows(spark, T0, 20), raw)
    schema = rows(spark, T0, 1).schema

    def fail_after_write(batch, number):
        si.write_batch(batch, number, store)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        si.run_available(normalize_rows(si.read_new_files(spark, raw, schema)), fail_after_write, progress)
    si.ingest_logs(si.read_new_files(spark, raw, schema), store, progress)
    assert spark.read.parquet(store).count() == 20


def drain(stream, tmp_path, name):
    out, progress = str(tmp_path / name), str(tmp_path / f"{name}-progress")
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def test_streaming_dedupe_across_batches(spark, tmp_path):
    raw = str(tmp_path / "raw")
    df = rows(spark, T0, 60)
    for part in (df, df.withColumn("n", F.col("n") + 100), rows(spark, T0 + timedelta(hours=1), 60)):
        add_file(part, raw)
        stream = si.stream_dedupe(normalize_rows(si.read_new_files(spark, raw, df.schema)))
        got = drain(stream, tmp_path, "out")
    expected = normalize_rows(spark.read.parquet(raw)).select(*DEDUPE_KEYS).distinct()
    assert sorted(got.select(*DEDUPE_KEYS).collect()) == sorted(expected.collect())


def test_streaming_hours_come_out_once_and_late_rows_do_not(spark, tmp_path):
    raw = str(tmp_path / "raw")
    df = rows(spark, T0, 200)  # about 23 hours
    add_file(df, raw)
    stream = si.stream_hourly(normalize_rows(si.read_new_files(spark, raw, df.schema)))
    first = drain(stream, tmp_path, "out")
    last = T0 + timedelta(minutes=7 * 199)
    due = hourly_traffic(normalize_rows(df)).where(
        F.col("time_bucket") + F.expr("INTERVAL 1 HOUR") <= F.lit(last - timedelta(hours=2))
    )
    key = ["service_name", "time_bucket", "request_count", "error_rate", "bytes_total", "unique_users"]
    assert sorted(first.select(*key).collect()) == sorted(due.select(*key).collect())
    count = first.count()
    add_file(rows(spark, T0, 5, 900), raw)  # beyond the watermark
    assert drain(stream, tmp_path, "out").count() == count
