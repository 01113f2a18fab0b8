import math
import random
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from logtide.plans import registry
from logtide.session import use_utc
from logtide.sources.fixtures import raw_access_logs
from logtide.streaming.alerts import keyed_state, score_and_add, stream_window_scores

T0 = datetime(2024, 1, 1)
HOURS = "service_name string, time_bucket timestamp, request_count long, error_rate double"
COLUMNS = ["request_count", "error_rate"]


def hours(n, seed, service="a"):
    rng = random.Random(seed)
    return [(service, T0 + timedelta(hours=k), rng.randrange(50), rng.choice([0.0, 0.1, None])) for k in range(n)]


def add_file(spark, rows, folder):
    spark.createDataFrame(rows, HOURS).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, progress, out, idle=timedelta(days=30), fail=False):
    source = spark.readStream.schema(HOURS).option("maxFilesPerTrigger", 1).parquet(folder)
    marked = source.withColumn("closed", F.col("time_bucket") + F.expr("INTERVAL 1 HOUR - INTERVAL 1 MICROSECOND")).withWatermark("closed", "3 hours")
    with keyed_state(spark):
        scored = stream_window_scores(marked, columns=COLUMNS, min_rows=2, cut=1.5, idle=idle)
        query = scored.writeStream.option("checkpointLocation", progress).trigger(availableNow=True).outputMode("append").start(out, format="parquet")
        query.awaitTermination()
    return sorted(map(tuple, spark.read.schema(scored.schema).parquet(out).collect()), key=str)


def plain(rows, until, idle=timedelta(days=30)):
    """Every hour up to ``until`` against all hours of its service before it."""
    out = []
    for service in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == service), key=lambda r: r[1])
        past = []
        for _, at, *values in own:
            values = [float(v or 0.0) for v in values]
            if past and at - past[-1][0] >= idle:
                past = []
            score = 0.0
            for k, x in enumerate(values):
                before = [p[1][k] for p in past]
                mean = sum(before) / max(len(before), 1)
                std = math.sqrt(sum((b - mean) ** 2 for b in before) / max(len(before), 1))
                if std > 1e-12:
                    score = max(score, abs(x - mean) / std)
            if len(past) >= 2 and at + timedelta(hours=1) <= until:
                out.append((service, at, *values, len(past), score, score))
            past.append((at, values))
    return out


def assert_same(got, want):
    want = sorted(want, key=str)
    assert [(r[0], r[1], r[4]) for r in got] == [(r[0], r[1], r[4]) for r in want]
    assert all(abs(g[5] - w[5]) < 1e-3 and g[6] == (g[5] > 1.5) for g, w in zip(got, want))


def test_hours_in_any_order_over_batches_equal_the_plain_definition(spark, tmp_path):
    raw, progress, out = (str(tmp_path / n) for n in ("raw", "progress", "out"))
    rows = hours(40, 1) + hours(40, 2, "b") + hours(40, 3, None)
    rows = [r for r in rows if r[0]] + hours(3, 4, "few")
    rng = random.Random(5)
    batches = [[r for r in rows if lo <= (r[1] - T0).total_seconds() / 3600 < lo + 10] for lo in (0, 10, 20, 30)]
    # the last two hours of a batch arrive with the next one, within the delay
    for one, other in zip(batches, batches[1:]):
        last = max(r[1] for r in one)
        other += [r for r in one if r[1] >= last - timedelta(hours=1) and r[0] == "b"]
        one[:] = [r for r in one if not (r[1] >= last - timedelta(hours=1) and r[0] == "b")]
    for batch in batches:
        rng.shuffle(batch)
        add_file(spark, batch, raw)
    got = run(spark, raw, progress, out)
    assert_same(got, plain(rows, T0 + timedelta(hours=36)))
    # nothing new: nothing is added; then a late hour changes nothing, and new hours go on from the stored moments
    assert run(spark, raw, progress, out) == got
    add_file(spark, [("a", T0 + timedelta(hours=5, minutes=30), 10**6, 1.0)], raw)
    more = [(s, t + timedelta(hours=40), n, e) for s, t, n, e in hours(10, 6)]
    add_file(spark, more, raw)
    assert_same(run(spark, raw, progress, out), plain(rows + more, T0 + timedelta(hours=46)))


def test_an_idle_service_starts_anew(spark, tmp_path):
    raw, progress, out = (str(tmp_path / n) for n in ("raw", "progress", "out"))
    rows = hours(8, 1) + [(s, t + timedelta(days=3), n, e) for s, t, n, e in hours(8, 2)] + [("a", T0 + timedelta(days=9), 1, 0.0)]
    for part in (rows[:8], rows[8:16], rows[16:]):
        add_file(spark, part, raw)
    got = run(spark, raw, progress, out, timedelta(days=2))
    assert_same(got, plain(rows, T0 + timedelta(days=8, hours=21), timedelta(days=2)))
    assert max(r[4] for r in got) == 7


def test_constant_columns_and_the_first_hour_score_zero():
    moments = (0, 0, [0.0], [0.0])
    for n in range(5):
        before, score, moments = score_and_add(moments, n, [3.0])
        assert (before, score) == (n, 0.0)
    assert score_and_add(moments, 9, [4.0])[1] == 0.0


def _events(spark, folder, rows):
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, kinds).write.parquet(f"{folder}/events.parquet")


def test_each_part_of_the_stream_is_one_batch_of_several_files(spark, tmp_path, monkeypatch):
    begin = datetime(2024, 1, 1)
    # a busy first part, a last one of few rows, none between, and every time four times
    busy = [(i, begin + timedelta(seconds=i // 4 * 900), i % 4, "view", float(i % 9), f'{{"k": {i % 100}}}') for i in range(1600)]
    late = [(9000 + i, begin + timedelta(days=29), i % 4, "view", 1.0, '{"k": 7}') for i in range(2)]
    _events(spark, tmp_path, busy + late)
    use_utc(spark)
    monkeypatch.setattr(registry, "FILE_ROWS", 300)
    path, schema, files = registry._raw_files_by_time(spark, str(tmp_path))
    assert files > 1
    names = sorted((p.stat().st_mtime_ns, p.name) for p in Path(path.removeprefix("file:")).glob("*.parquet"))
    assert len(names) == 7 * files
    raw = spark.read.schema(schema).parquet(path)
    assert sorted(map(str, raw.collect())) == sorted(map(str, raw_access_logs(spark, str(tmp_path)).collect()))
    # rows of one time share a file, and files of a part come before those of the next
    timed = raw.where("time <> 'not-a-time'").select("time", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"))
    assert timed.groupBy("time").agg(F.count_distinct("file").alias("n")).where("n > 1").isEmpty()
    place = {name: i // files for i, (_, name) in enumerate(names)}
    held = {(place[r["file"]], min((int(r["time"][8:10]) - 1) // 5, 6)) for r in timed.collect()}
    assert held == {(p, p) for _, p in held}
    several = sorted(registry.QUERIES["streaming_hourly"](spark, str(tmp_path)).collect())
    monkeypatch.setattr(registry, "FILE_ROWS", 1_000_000)
    assert several == sorted(registry.QUERIES["streaming_hourly"](spark, str(tmp_path)).collect())
