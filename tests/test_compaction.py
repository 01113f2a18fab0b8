import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logtide.streaming import compaction as co
from logtide.streaming.ingest import write_batch

SCHEMA = "event_id long, timestamp timestamp, service_name string"
T0 = datetime(2024, 1, 1)


def batch(spark, number, n=24):
    rows = [(1000 * number + k, T0 + timedelta(hours=3 * k), None if k % 5 == 0 else f"s{k % 3}") for k in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


def files(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "store"), str(tmp_path / "compacted")


def test_rows_stay_and_files_become_few(spark, paths):
    store, compacted = paths
    schema, want, live = batch(spark, 0).schema, [], []
    for number in range(8):
        write_batch(batch(spark, number), number, store)
        want += ids(batch(spark, number))
        # before and after a compaction the same rows are seen
        assert ids(co.read_compacted(spark, store, compacted, schema)) == want
        live.append(co.compact(spark, store, compacted, schema))
        assert ids(co.read_compacted(spark, store, compacted, schema)) == want
    assert live == [1, 1, 2, 1, 2, 2, 3, 1]  # as the digits of a binary counter
    assert co.compact(spark, store, compacted, schema) == live[-1]  # nothing new
    version, generations = co.read_manifest(spark, compacted)
    assert version == 8 and sum(g.row_count for g in generations) == len(want)
    gone = co.remove_obsolete(spark, compacted)
    assert gone and ids(co.read_compacted(spark, store, compacted, schema)) == want
    assert files(f"{compacted}/{generations[0].generation}") < files(store) / 4
    one_day = co.read_compacted(spark, store, compacted, schema).where((F.col("year") == 2024) & (F.col("month") == 1) & (F.col("day") == 2))
    assert {r["timestamp"].day for r in one_day.collect()} == {2} and one_day.count() == 8 * 8


def test_batches_still_being_written_are_left_out(spark, paths):
    store, compacted = paths
    for number in range(3):
        write_batch(batch(spark, number), number, store)
    schema = batch(spark, 0).schema
    co.compact(spark, store, compacted, schema, through=1)
    assert co.read_manifest(spark, compacted)[1][0].last_batch == 1
    write_batch(batch(spark, 2, 10), 2, store)  # written again with fewer rows on the same days, and others left
    write_batch(batch(spark, 2), 2, store)
    assert ids(co.read_compacted(spark, store, compacted, schema)) == sum((ids(batch(spark, n)) for n in range(3)), [])


@pytest.mark.parametrize("step", ["_write", "publish"])
def test_a_compaction_that_dies_changes_nothing(spark, paths, monkeypatch, step):
    store, compacted = paths
    schema = batch(spark, 0).schema
    write_batch(batch(spark, 0), 0, store)
    co.compact(spark, store, compacted, schema)
    write_batch(batch(spark, 1), 1, store)
    want = ids(batch(spark, 0)) + ids(batch(spark, 1))
    whole = getattr(co, step)

    def dies(*args):
        if step == "_write":
            whole(args[0].limit(5), *args[1:])  # half of it is written
        else:
            os.makedirs(f"{compacted}/manifest/version=2")  # a version without its mark
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(co, step, dies)
        with pytest.raises(RuntimeError):
            co.compact(spark, store, compacted, schema)
    assert ids(co.read_compacted(spark, store, compacted, schema)) == want
    assert co.compact(spark, store, compacted, schema) == 1
    assert ids(co.read_compacted(spark, store, compacted, schema)) == want
    with pytest.raises(Exception, match="already exists"):
        co.publish(spark, compacted, 2, [])


def test_an_empty_store_has_nothing_to_compact(spark, paths):
    store, compacted = paths
    write_batch(batch(spark, 0, 1), 0, store)
    schema = batch(spark, 0).schema
    assert co.compact(spark, store, compacted, schema, through=-1) == 0
    assert co.read_manifest(spark, compacted) == (0, []) and co.remove_obsolete(spark, compacted) == []
