import json
import os
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from logtide import scratch
from logtide.operators.forecast import MIN_HOURS, stored_states
from logtide.plans.usage_run import Settings, run
from logtide.sinks import writers
from logtide.sources import access_logs as src
from logtide.sources import guarded

T0 = datetime(2024, 1, 30)


def daily(spark, days=5, start=T0):
    rows = [(start + timedelta(days=d, hours=h), f"s{h % 3}", 200, float(h)) for d in range(days) for h in range(24)]
    return spark.createDataFrame(rows, "timestamp timestamp, service_name string, status_code int, latency_ms double")


def test_date_range_is_inclusive_and_pruned(spark, tmp_path):
    root, logs = str(tmp_path / "store"), daily(spark)
    writers.write_logs(logs, root)
    assert os.path.isdir(f"{root}/year=2024/month=2/day=1")
    got = src.scan_date_range(spark, root, "2024-01-31", "2024-02-02", logs.schema, ["timestamp", "latency_ms"])
    assert got.columns == ["timestamp", "latency_ms"]
    assert sorted({r.timestamp.date() for r in got.collect()}) == [date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 2)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "make_date" in plan.split("PartitionFilters:")[1][:200]


def test_zero_padded_folders_are_read(spark, tmp_path):
    daily(spark, 1).drop("x").coalesce(1).write.parquet(str(tmp_path / "store/year=2024/month=01/day=05"))
    got = src.scan_date_range(spark, str(tmp_path / "store"), "2024-01-05", "2024-01-05", daily(spark, 1).schema)
    assert got.count() == 24 and "year" not in got.columns


def test_no_store_gives_an_empty_frame(spark, tmp_path):
    schema = daily(spark).schema
    got = src.scan_date_range(spark, str(tmp_path / "none"), "2024-01-01", "2024-01-02", schema)
    assert got.schema == schema and got.isEmpty()


def test_bad_files_are_skipped_and_schemas_merged(spark, tmp_path):
    root = str(tmp_path / "store")
    writers.write_logs(daily(spark, 1).drop("latency_ms"), root)
    writers.write_logs(daily(spark, 1, T0 + timedelta(days=1)), root)
    with open(f"{root}/year=2024/month=1/day=30/bad.parquet", "wb") as f:
        f.write(b"no parquet at all")
    schema = daily(spark).schema
    got = src.read_store(spark, root, schema, tolerant=True)
    assert got.count() == 48 and got.where("latency_ms is null").count() == 24
    assert [os.path.basename(r.path) for r in src.skipped_files(spark, root, schema).collect()] == ["bad.parquet"]
    with pytest.raises(Exception):
        src.read_store(spark, root, schema).collect()


def test_rewriting_a_day_leaves_the_others(spark, tmp_path):
    root = str(tmp_path / "store")
    writers.write_logs(daily(spark, 3), root, compression="gzip")
    writers.write_logs(daily(spark, 1).limit(5), root, files_per_day=2)
    got = spark.read.parquet(root).groupBy("day").count().collect()
    assert {r.day: r["count"] for r in got} == {30: 5, 31: 24, 1: 24}


def as_table(spark, path, logs):
    """An external table with a partition for each day."""
    name = "t_" + os.path.basename(path)
    day = F.date_format("timestamp", "yyyy-MM-dd")
    logs.withColumn("dt", day).write.partitionBy("dt").option("path", path).mode("overwrite").saveAsTable(name)
    return name


def test_table_scan_keeps_times_and_opens_the_days_only(spark, tmp_path):
    name = as_table(spark, str(tmp_path / "scan"), daily(spark))
    got = src.query_table_by_date(spark, name, "2024-01-31", "2024-02-01")
    assert got.columns == ["dt", "timestamp", "service_name", "status_code", "latency_ms"]
    days = [str(r.dt) for r in got.collect()]
    assert days == sorted(days) and len(days) == 48 and got.select("timestamp").distinct().count() == 48
    plan = src.scan_table(spark, name, "2024-01-31", "2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "Exchange" not in plan
    daily(spark).select(F.to_date("timestamp").alias("dt"), "service_name").createOrReplaceTempView("only_days")
    with pytest.raises(ValueError, match="no time column"):
        src.scan_table(spark, "only_days", "2024-01-31", "2024-02-01")


def test_guard(spark, tmp_path):
    root, logs = str(tmp_path / "store"), daily(spark)
    writers.write_logs(logs, root)
    days = F.make_date("year", "month", "day").between(F.lit(date(2024, 1, 30)), F.lit(date(2024, 1, 31)))
    listed = src.listed_files(spark, root)
    assert listed.count() == 5 and listed.where(days).count() == 2
    size = guarded.scan_size(listed.where(days)).first()
    assert 0 < size.scan_mb < 1 and size.files == 2 and size.est_cost_usd == pytest.approx(size.scan_mb / 1024 / 1024 * 5)
    assert guarded.guard_scan(listed.where(days), size.scan_mb) == size.scan_mb
    with pytest.raises(guarded.ScanLimitExceeded):
        guarded.guard_scan(listed.where(days), size.scan_mb / 2)


def test_results_are_stored_by_the_pruned_files(spark, tmp_path):
    path, cache = str(tmp_path / "data"), str(tmp_path / "results")
    name = as_table(spark, path, daily(spark, 3))

    def stored():
        files = src.table_files(spark, name).where("dt <= '2024-01-31'")
        return guarded.cached_result(src.scan_table(spark, name, "2024-01-30", "2024-01-31"), "q", files, cache).count()

    assert stored() == stored() == 48 and len(os.listdir(cache)) == 1
    daily(spark, 1, T0 + timedelta(days=9)).withColumn("dt", F.lit("2024-02-08")).write.partitionBy("dt").mode("append").parquet(path)
    assert stored() == 48 and len(os.listdir(cache)) == 1  # a new day changes no older range
    (folder,) = os.listdir(cache)
    os.remove(f"{cache}/{folder}/_SUCCESS")  # as if the write had died
    assert stored() == 48 and os.path.exists(f"{cache}/{folder}/_SUCCESS")


def test_without_files_nothing_is_stored(spark, tmp_path):
    cache = str(tmp_path / "results")
    for value in (1, 100):
        spark.range(value, value + 1).createOrReplaceTempView("changing")
        assert guarded.cached_query(spark, "SELECT sum(id) AS s FROM changing", cache).first().s == value
    assert not os.path.exists(cache)


def test_cached_query_sees_new_files(spark, tmp_path):
    data, cache = str(tmp_path / "data"), str(tmp_path / "cache")
    sql = f"SELECT count(*) AS n FROM parquet.`{data}`"
    daily(spark, 1).write.parquet(data)
    assert guarded.cached_query(spark, sql, cache).first().n == 24
    assert guarded.cached_query(spark, sql, cache).first().n == 24
    assert len(os.listdir(cache)) == 1
    daily(spark, 1).write.mode("append").parquet(data)
    assert guarded.cached_query(spark, sql, cache).first().n == 48
    assert len(os.listdir(cache)) == 2
    assert guarded.cached_query(spark, sql, cache, use_cache=False).first().n == 48


def test_window_choice():
    today = date(2024, 3, 31)
    assert src.choose_window(None, today=today) == ("2024-03-01", "2024-03-31")
    assert src.choose_window("2024-03-29", today=today) == ("2024-03-29", "2024-03-31")
    assert src.choose_window("2024-03-29", force=True, today=today) == ("2024-03-01", "2024-03-31")
    assert src.choose_window("2024-03-29", incremental=False, lookback_days=2, today=today) == ("2024-03-29", "2024-03-31")
    assert src.choose_window("2024-04-02", today=today) == ("2024-03-31", "2024-03-31")


def test_report_name():
    assert writers.report_name(datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)) == "report_20240102_030405.json"


def test_report_copy_may_fail(spark, tmp_path):
    report = spark.range(1).select(F.struct(F.lit(1).alias("a")).alias("s"))
    path = writers.write_report(report, str(tmp_path / "r"), "x.json", copy_to="nosuchscheme://x")
    assert spark.read.json(path).first().s.a == 1
    writers.write_report(report, str(tmp_path / "r"), "y.json", copy_to=str(tmp_path / "copy"))
    assert spark.read.json(str(tmp_path / "copy/y.json")).first().s.a == 1


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    assert scratch.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Cluster:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Cluster)


def test_a_whole_run(spark, tmp_path):
    store, state, reports = (str(tmp_path / n) for n in ("store", "state", "reports"))
    hours = [(T0 + timedelta(hours=h), f"svc-{s}", 500 if (h + s) % 9 == 0 else 200, 10.0 * s + h % 5, f"/x/{h % 3}") for h in range(MIN_HOURS + 24) for s in range(12)]
    logs = spark.createDataFrame(
        hours, "timestamp timestamp, service_name string, status_code int, latency_ms double, endpoint string"
    )
    writers.write_logs(logs, store)
    settings = Settings(lookback_days=30, n_clusters=3, forecast_top_n=2, save_models_to=str(tmp_path / "models"))
    args = dict(store=store, schema=logs.schema, settings=settings)
    done = run(spark, state, reports, today=date(2024, 2, 2), **args)
    assert done["status"] == "done"
    (part,) = [f for f in os.listdir(done["report"]) if f.endswith(".json")]
    with open(f"{done['report']}/{part}") as f:
        report = json.loads(f.read())
    assert report["metadata"]["total_services_analysed"] == 12
    assert report["metadata"]["total_requests"] == 12 * (MIN_HOURS + 24)
    assert report["metadata"]["date_range"] == {"start": "2024-01-03", "end": "2024-02-02"}
    assert len(report["traffic_summary"]["top_services"]) == 12
    assert len(report["capacity_plan"]["forecast_peak_windows"]) == 2
    assert sum(c["service_count"] for c in report["traffic_summary"]["cluster_breakdown"]) == 12
    assert set(report) == {"metadata", "traffic_summary", "anomaly_alerts", "capacity_plan", "cost_optimization"}
    assert src.last_run_date(spark, state) == "2024-02-02"
    assert stored_states(spark, f"{settings.save_models_to}/forecasts", 7).count() == 2
    assert done["rows"] == {"input_rows": 864, "dropped_rows": 0, "duplicate_rows": 0} and -1 <= done["silhouette"] <= 1
    # nothing since the last day of that run: the state stays
    assert run(spark, state, reports, today=date(2024, 2, 3), **args)["status"] == "no_new_data"
    assert src.last_run_date(spark, state) == "2024-02-02"
    assert run(spark, str(tmp_path / "s2"), reports, today=date(2030, 1, 1), **args)["status"] == "no_new_data"
    bad = str(tmp_path / "bad")
    writers.write_logs(logs.withColumn("status_code", F.lit(1)), bad)
    out = run(spark, str(tmp_path / "s3"), reports, today=date(2024, 2, 2), **(args | {"store": bad}))
    assert out["status"] == "empty_after_parsing" and src.last_run_date(spark, str(tmp_path / "s3")) is None


def test_a_run_over_a_table_keeps_every_request(spark, tmp_path):
    rows = [(T0 + timedelta(seconds=60 * k), f"s{k % 3 // 2}", 200, 1.0 + k % 7, "/x", "pod") for k in range(2880)]
    logs = spark.createDataFrame(rows, "timestamp timestamp, service_name string, status_code int, latency_ms double, endpoint string, instance_id string")
    name = as_table(spark, str(tmp_path / "runs"), logs)
    reports, state, cache = (str(tmp_path / n) for n in ("reports", "state", "cache"))
    settings = Settings(n_clusters=2, cache_dir=cache, copy_report_to=str(tmp_path / "copies"), save_models_to=str(tmp_path / "m"))
    before = set(os.listdir(f"{scratch.scratch_root(spark)}/logtide")) if os.path.exists(f"{scratch.scratch_root(spark)}/logtide") else set()
    done = run(spark, state, reports, table=name, settings=settings, today=date(2024, 2, 1))
    assert done["status"] == "done" and done["rows"]["input_rows"] == 2880 and done["rows"]["duplicate_rows"] == 0
    assert spark.read.json(done["report"]).first().metadata.total_requests == 2880
    assert os.listdir(tmp_path / "copies") == os.listdir(reports)
    assert not {f for f in set(os.listdir(f"{scratch.scratch_root(spark)}/logtide")) - before if f.startswith("scope-")}
    small = Settings(n_clusters=2, max_scan_mb=1e-6)
    with pytest.raises(guarded.ScanLimitExceeded):
        run(spark, str(tmp_path / "s2"), reports, table=name, settings=small, today=date(2024, 2, 1))


@pytest.mark.parametrize("options", [{}, {"lookback_days": 3}, {"incremental": False}, {"force": True}])
def test_windows_of_many_runs_are_those_of_one(spark, options):
    today, runs = date(2024, 3, 1), [None, "2024-02-28", "2024-03-01T05:00:00", "2024-04-09", "2023-12-31"]
    df = spark.createDataFrame([(r,) for r in runs], "r string")
    got = {row.r: tuple(row.w) for row in df.select("r", src.run_windows(F.col("r"), F.lit(today), **options).alias("w")).collect()}
    assert got == {r: src.choose_window(r, today=today, **options) for r in runs}
