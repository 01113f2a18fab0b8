import hashlib
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.functions.text import normalize_endpoint, strip_space
from logtide.operators import normalize as no


def raw(spark, **columns):
    """One-row frame with the given columns on top of a valid record."""
    row = {"ts": "2024-01-01 00:00:00", "svc": "a", "status": "200"} | columns
    return spark.createDataFrame([tuple(row.values())], list(row))


def only(df, column):
    rows = df.collect()
    return rows[0][column] if rows else "rejected"


def test_every_alias_maps_to_its_field(spark):
    for field, names in no.ALIASES.items():
        for name in names:
            df = no.map_columns(spark.createDataFrame([("x",)], [name]))
            assert df.columns == [field], name


def test_canonical_name_wins_then_listed_order(spark):
    df = spark.createDataFrame([("t", None, "s"), (None, "u", "s")], ["time", "ts", "svc"])
    assert [r.timestamp for r in no.map_columns(df).collect()] == ["t", "u"]
    df = spark.createDataFrame([("alias", "own")], ["svc", "service_name"])
    assert only(no.map_columns(df), "service_name") == "own"


def test_names_match_case_and_others_ride_along(spark):
    df = spark.createDataFrame([(1, "x", "y")], "TS int, ts string, extra string")
    mapped = no.map_columns(df)
    assert mapped.columns == ["timestamp", "TS", "extra"]
    assert only(mapped, "timestamp") == "x"
    clash = no.map_columns(spark.createDataFrame([("a", "b")], "ts string, Timestamp string"))
    assert clash.columns == ["timestamp", "Timestamp_source"]


def test_a_date_partition_is_no_time(spark):
    df = spark.createDataFrame([("2024-02-03", "a", 200)], ["dt", "service_name", "status_code"])
    with pytest.raises(ValueError, match="timestamp"):
        no.normalize_rows(df)
    both = spark.createDataFrame([("2024-02-03", "2024-02-03 04:00:00")], ["dt", "ts"])
    assert no.map_columns(both).columns == ["timestamp", "dt"]


def test_missing_required_column_is_refused(spark):
    with pytest.raises(ValueError, match="status_code"):
        no.normalize_rows(spark.createDataFrame([("2024-01-01", "a")], ["ts", "svc"]))


def test_absent_fields_get_defaults(spark):
    row = no.normalize_rows(raw(spark)).first()
    assert (row.endpoint, row.method, row.user_id, row.instance_id) == ("unknown", "UNKNOWN", "unknown", "unknown")
    assert row.latency_ms is None and row.bytes_response is None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-01", datetime(2024, 1, 1)),
        ("2024-01-01T01:00:00Z", datetime(2024, 1, 1, 1)),
        ("2024-01-01T01:00:00+02:00", datetime(2023, 12, 31, 23)),
        ("2024-01-01 01:02:03.5", datetime(2024, 1, 1, 1, 2, 3, 500000)),
        ("junk", "rejected"),
        ("12:30:00", "rejected"),
        ("T12:30", "rejected"),
        ("", "rejected"),
    ],
)
def test_time_texts(spark, text, expected):
    assert only(no.normalize_rows(raw(spark, ts=text)), "timestamp") == expected


@pytest.mark.parametrize("unit, ticks", [("s", 1), ("ms", 10**3), ("us", 10**6), ("ns", 10**9)])
def test_epoch_units(spark, unit, ticks):
    want = datetime(2024, 1, 1)
    assert only(no.normalize_rows(raw(spark, ts=1704067200 * ticks), unit), "timestamp") == want


def test_epoch_nanoseconds_keep_microseconds(spark):
    got = only(no.normalize_rows(raw(spark, ts=1704067200_123456_789)), "timestamp")
    assert got == datetime(2024, 1, 1, 0, 0, 0, 123456)


@pytest.mark.parametrize(
    "status, expected",
    [
        ("99", "rejected"),
        ("100", 100),
        ("599", 599),
        ("600", "rejected"),
        (" 200 ", 200),
        ("200.0", 200),
        ("404.5", "rejected"),
        ("200d", "rejected"),
        ("70000", "rejected"),
        ("oops", "rejected"),
        (None, "rejected"),
    ],
)
def test_status_texts(spark, status, expected):
    df = spark.createDataFrame([("2024-01-01", "a", status)], "ts string, svc string, status string")
    assert only(no.normalize_rows(df), "status_code") == expected


@pytest.mark.parametrize("status, expected", [(404.0, 404), (404.5, "rejected"), (float("nan"), "rejected")])
def test_status_numbers(spark, status, expected):
    assert only(no.normalize_rows(raw(spark, status=status)), "status_code") == expected


@pytest.mark.parametrize(
    "latency, expected",
    [
        (-0.001, "rejected"),
        (0.0, 0.0),
        (300000.0, 300000.0),
        (300000.001, "rejected"),
        (float("nan"), None),
        (None, None),
    ],
)
def test_latency_bounds(spark, latency, expected):
    df = spark.createDataFrame(
        [("2024-01-01", "a", 200, latency)], "ts string, svc string, status int, latency double"
    )
    assert only(no.normalize_rows(df), "latency_ms") == expected


@pytest.mark.parametrize("text, expected", [("12.5", 12.5), ("1e2", 100.0), ("1d", None), ("x", None), ("nan", None)])
def test_latency_texts(spark, text, expected):
    assert only(no.normalize_rows(raw(spark, latency=text)), "latency_ms") == expected


def test_strings_are_stripped_of_any_blank(spark):
    df = raw(spark, svc="\t Pay Ment \n", verb=" get\r", path="　/a ")
    row = no.normalize_rows(df).first()
    assert (row.service_name, row.method, row.endpoint) == ("pay ment", "GET", "/a")
    odd = spark.createDataFrame([("\x1c x \x1f",)], ["t"])
    assert odd.select(strip_space(F.col("t"))).first()[0] == "x"


def test_null_service_is_rejected_and_null_endpoint_kept(spark):
    df = spark.createDataFrame(
        [("2024-01-01", None, 200, "/a"), ("2024-01-01", "s", 200, None)],
        "ts string, svc string, status int, path string",
    )
    assert [(r.service_name, r.endpoint) for r in no.normalize_rows(df).collect()] == [("s", "unknown")]


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/u/7", "/u/7"),
        ("/u/12ab?x=1", "/u/{id}ab"),
        ("/u/123/o/45", "/u/{id}/o/{id}"),
        ("/f/0A1B2C3D-0000-1111-2222-333344445555/x", "/f/{uuid}/x"),
        ("/f/0a1b2c3d-0000-1111-2222-333344445555", "/f/{uuid}"),
        ("?only", ""),
        ("/v10/x", "/v10/x"),
        ("/a?b?c", "/a"),
        ("/n/١٢", "/n/{id}"),
        ("", ""),
    ],
)
def test_endpoints(spark, path, expected):
    df = spark.createDataFrame([(path,)], ["p"])
    once = df.select(normalize_endpoint(F.col("p")).alias("p"))
    assert once.first()[0] == expected
    assert once.select(normalize_endpoint(F.col("p"))).first()[0] == expected


def logs(spark, rows):
    return spark.createDataFrame(rows, "timestamp timestamp, service_name string, endpoint string, instance_id string, status_code int, n int")


def test_dedupe_keeps_first_by_order_and_treats_nulls_as_equal(spark):
    t = datetime(2024, 1, 1)
    rows = [(t, "a", "/x", None, 500, 2), (t, "a", "/x", None, 200, 1), (t, "a", "/y", None, 200, 3)]
    got = no.dedupe(logs(spark, rows), order=["n"]).orderBy("n").collect()
    assert [(r.n, r.status_code) for r in got] == [(1, 200), (3, 200)]


def test_dedupe_sees_masked_ids(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "a", 200, "/u/11", 1), ("2024-01-01", "a", 200, "/u/22", 2)],
        "ts string, svc string, status int, path string, n int",
    )
    assert [r.n for r in no.normalize_logs(df, order=["n"]).collect()] == [1]


def test_dedupe_shrinks_hot_groups_before_the_shuffle(spark):
    t = datetime(2024, 1, 1)
    df = no.dedupe(logs(spark, [(t, "a", "/x", "i", 200, 1)]), order=["n"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_dedupe_does_not_depend_on_layout(spark):
    t = datetime(2024, 1, 1)
    rows = [(t, f"s{i % 7}", "/x", "i", 200 + i % 3, i) for i in range(500)]
    df = logs(spark, rows)
    few, many = (no.dedupe(df.repartition(p), order=["n"]).orderBy("n").collect() for p in (1, 13))
    assert few == many and [r.n for r in few] == list(range(7))


def test_normalizing_twice_changes_nothing(spark):
    df = raw(spark, path="/u/123?x=1", latency="5", verb="get ")
    once = no.normalize_logs(df)
    assert no.normalize_logs(once).select(*no.CANONICAL).collect() == once.select(*no.CANONICAL).collect()


def test_reject_reasons_and_watch(spark):
    df = spark.createDataFrame(
        [("x", "a", "200", 1.0), ("2024-01-01", None, "99", -1.0), ("2024-01-01", "a", "oops", None), ("2024-01-01", "a", "200", 1.0)],
        "ts string, svc string, status string, latency double",
    )
    got = {r.reason: r.row_count for r in no.reject_reasons(df).collect()}
    assert got == {
        "input_rows": 4,
        "rejected_rows": 3,
        "bad_timestamp": 1,
        "no_service": 1,
        "bad_status": 1,
        "status_out_of_range": 1,
        "latency_out_of_range": 1,
    }
    watch = Observation("rows")
    assert no.normalize_rows(df, watch=watch).count() == 1
    assert watch.get == {"input_rows": 4, "dropped_rows": 3}


def test_downsample_is_stable_and_near_its_rate(spark):
    t = datetime(2024, 1, 1)
    df = logs(spark, [(t, f"s{i}", "/x", "i", 200, i) for i in range(4000)])
    first = {r.n for r in no.downsample(df, 0.25).collect()}
    assert first == {r.n for r in no.downsample(df.repartition(9), 0.25).collect()}
    assert 880 < len(first) < 1120
    assert first != {r.n for r in no.downsample(df, 0.25, seed=7).collect()}
    assert no.downsample(df, 1.0) is df


def test_types_of_the_canonical_record(spark):
    types = {f.name: f.dataType for f in no.normalize_rows(raw(spark, latency=1)).schema.fields}
    assert types["timestamp"] == T.TimestampType() and types["status_code"] == T.IntegerType()
    assert types["latency_ms"] == types["bytes_response"] == T.DoubleType()
    assert types["user_id"] == T.StringType()


@pytest.mark.parametrize("rate", [0.0, 0.001, 0.25, 0.5, 0.999, 1.0, 2.0])
def test_exact_sample_has_its_size_and_follows_the_hash(spark, rate):
    rows = [(k // 3, f"v{k}") for k in range(600)]  # three rows of each key
    df = spark.createDataFrame(rows, "k long, v string")
    got = [tuple(r) for r in no.downsample_exact(df.repartition(5), rate, keys=["k"]).collect()]
    assert len(got) == len(set(got)) == round(min(rate, 1.0) * 600) and set(got) <= set(rows)
    order = sorted(rows, key=lambda r: hashlib.md5(f"42|{r[0]}".encode()).hexdigest())
    cut = hashlib.md5(f"42|{order[max(len(got) - 1, 0)][0]}".encode()).hexdigest()
    assert {r for r in rows if hashlib.md5(f"42|{r[0]}".encode()).hexdigest() < cut} <= set(got) or not got


def test_exact_sample_of_one_hot_key(spark):
    df = spark.range(1000).select(F.lit(7).alias("k"), "id")
    assert no.downsample_exact(df, 0.3, keys=["k"]).count() == 300
    assert no.downsample_exact(df.limit(0), 0.3, keys=["k"]).count() == 0
