"""Raw access logs and entity tables derived from the given test tables, for queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COPY_OFFSET = 1_000_000_000


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def raw_access_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Vendor-style logs with bad times, statuses and latencies, odd spacing and some duplicates."""
    k = F.get_json_object("props", "$.k").cast("int")
    event_id, kind, user = F.col("event_id"), F.col("event_type"), F.col("user_id")

    def every(n: int):
        return event_id % n == 0

    uuid_part = F.when(every(5), "/0A1B2C3D-0000-1111-2222-333344445555").otherwise("")
    raw = (
        events(spark, folder)
        .withColumn("k", k)
        .select(
            "event_id",
            F.when(every(103), "not-a-time")
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .alias("time"),
            F.concat(F.lit("  "), F.upper(kind), F.lit("-SVC-"), (user % 4).cast("string"), F.lit(" ")).alias("svc"),
            F.concat(
                F.lit("/api/v1/"), kind, F.lit("/"), user.cast("string"), uuid_part, F.lit("?k="), F.col("k").cast("string")
            ).alias("uri"),
            F.when(F.col("k") % 4 == 0, " post").otherwise("get ").alias("verb"),
            F.when(every(97), "oops")
            .when(every(89), "42")
            .when((kind == "error") & (F.col("k") < 40), "500")
            .when(F.col("k") >= 95, "503")
            .when(F.col("k") >= 90, "404")
            .otherwise("200")
            .alias("status"),
            F.when(every(101), -5.0)
            .when(every(107), 300001.0)
            .when(every(11), None)
            .otherwise(F.col("value"))
            .alias("duration_ms"),
            F.when(every(13), None).otherwise(F.col("k") * 100).alias("bytes_sent"),
            user.cast("string").alias("client_id"),
            F.concat(kind, F.lit("-pod-"), (event_id % 3).cast("string")).alias("pod"),
        )
    )
    # every fiftieth row also appears as a copy with another status, next to its original
    copies = F.when(every(50), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return (
        raw.withColumn("copy", F.explode(copies))
        .withColumn("event_id", F.when(F.col("copy"), event_id + COPY_OFFSET).otherwise(event_id))
        .withColumn("status", F.when(F.col("copy"), "200").otherwise(F.col("status")))
        .drop("copy")
    )


def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    """Order behaviour per customer, in the shape of a service feature table."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    days = F.greatest(F.datediff(F.max("o_orderdate"), F.min("o_orderdate")), F.lit(1))
    return orders.groupBy(F.col("o_custkey").alias("service_name")).agg(
        F.count(F.lit(1)).alias("total_requests"),
        (F.count(F.lit(1)) / days).alias("requests_per_hour"),
        F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("error_rate"),
        F.max("o_totalprice").alias("latency_p95"),
        (F.max("o_totalprice") / F.min("o_totalprice")).alias("peak_to_avg_ratio"),
    )
