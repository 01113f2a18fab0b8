"""Usage-profile clusters of services: k-means, choice of k, silhouette, profiles, stored models."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from logtide.operators.dbscan import dbscan
from logtide.operators.lloyd import best_runs, fit_runs, nearest, squared
from logtide.operators.scaling import apply_moments, moments, standardize
from logtide.scratch import materialize

# The clustered columns (in this order) and the names of the clusters.
CLUSTER_COLUMNS = [
    "requests_per_hour",
    "error_rate",
    "latency_p95",
    "peak_to_avg_ratio",
    "unique_users",
    "unique_endpoints",
]
CLUSTER_LABELS = {
    0: "high_traffic_stable",
    1: "high_traffic_spiky",
    2: "medium_traffic",
    3: "low_traffic_reliable",
    4: "low_traffic_error_prone",
    5: "bursty",
    6: "idle",
    7: "internal_api",
}
OTHER = "other"
K_RANGE = range(3, 13)
DEFAULT_K = 4
#: Rows whose Euclidean silhouettes are taken, each against all rows.
SILHOUETTE_SAMPLE = 1000


def _present(features: DataFrame, columns: list[str] | None) -> list[str]:
    return [c for c in (columns or CLUSTER_COLUMNS) if c in features.columns]


def cluster_label(cluster_id: Column) -> Column:
    names = F.create_map(*[F.lit(v) for pair in CLUSTER_LABELS.items() for v in pair])
    return F.coalesce(F.try_element_at(names, cluster_id), F.lit(OTHER))


def _scores(points: DataFrame, key: str) -> DataFrame:
    """Silhouette of each row of ``points(run, key, label, x)`` within its run, from squared distances.

    The mean squared distance to a cluster follows from its size, sum and sum of squares, so every row is
    scored and no pairs of rows are built. One row for each cluster of a run travels to its rows.
    """
    size = F.size("x")
    axes = F.posexplode("x").alias("axis", "value")
    sums = (
        points.select("run", "label", axes)
        .groupBy("run", "label", "axis")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    )
    vector = F.transform(F.array_sort(F.collect_list(F.struct("axis", "s"))), lambda a: a["s"])
    each = sums.groupBy("run", "label").agg(F.max("n").alias("n"), vector.alias("s"), F.sum("q").alias("q"))
    clusters = each.groupBy("run").agg(F.collect_list(F.struct("label", "n", "s", "q")).alias("_clusters"))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, v: total + v)

    def total(cluster: Column) -> Column:
        """Squared distances to all members; rounding must not make it negative."""
        return F.greatest(cluster["n"] * F.col("_xx") - 2 * dot(F.col("x"), cluster["s"]) + cluster["q"], F.lit(0.0))

    own = F.element_at(F.filter("_clusters", lambda c: c["label"] == F.col("label")), 1)
    others = F.transform(F.filter("_clusters", lambda c: c["label"] != F.col("label")), lambda c: total(c) / c["n"])
    placed = points.join(clusters, "run").withColumn("_xx", dot(F.col("x"), F.col("x"))).withColumn("_own", own)
    inner = total(F.col("_own")) / F.nullif(F.col("_own")["n"] - 1, F.lit(0))
    scored = placed.where(size > 0).withColumns({"_inner": inner, "_outer": F.array_min(others)})
    score = (F.col("_outer") - F.col("_inner")) / F.nullif(F.greatest("_outer", "_inner"), F.lit(0.0))
    return scored.select("run", key, "label", F.coalesce(score, F.lit(0.0)).alias("silhouette"))


def _sampled_scores(points: DataFrame, key: str, sample: int = SILHOUETTE_SAMPLE) -> DataFrame:
    """As ``_scores``, by Euclidean distances, for the ``sample`` keys of least hash: each against all rows of its run.

    Every task adds up the distances of its rows to the sampled points, by run and label; only these sums are
    shuffled, ``sample`` rows for each label of a run.
    """
    spark = points.sparkSession
    digest = F.md5(F.col(key).cast("string"))
    keys = points.select(key, digest.alias("_h")).distinct().orderBy("_h", key).limit(sample)
    drawn = points.join(F.broadcast(keys), key).select("run", key, "label", "x").collect()  # `sample` rows a run
    at: dict[int, list[int]] = {}
    for i, r in enumerate(drawn):
        at.setdefault(r["run"], []).append(i)
    places = {run: np.array([drawn[i]["x"] for i in own], float) for run, own in at.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        sizes: dict[tuple[int, int], int] = {}
        for batch in batches:
            runs, labels = (batch.column(k).to_numpy() for k in (0, 1))
            x = np.array(batch.column(2).to_pylist(), float).reshape(batch.num_rows, -1)
            for pair in np.unique(np.column_stack([runs, labels]), axis=0).tolist():
                own = np.flatnonzero((runs == pair[0]) & (labels == pair[1]))
                for begin in range(0, len(own), 1024):
                    far = np.sqrt(squared(x[own[begin : begin + 1024]], places[pair[0]])).sum(axis=0)
                    sums[tuple(pair)] = sums.get(tuple(pair), 0) + far
                sizes[tuple(pair)] = sizes.get(tuple(pair), 0) + len(own)
        for (which, label), total in sums.items():
            n = len(total)
            yield pa.RecordBatch.from_pydict({
                "place": pa.array(at[which], pa.int32()), "other": pa.array([label] * n, pa.int32()),
                "n": pa.array([sizes[which, label]] * n, pa.int64()), "far": pa.array(total),
            })

    source = points.select(F.col("run").cast("int"), F.col("label").cast("int"), "x")
    totals = source.mapInArrow(run, "place int, other int, n long, far double")
    totals = totals.groupBy("place", "other").agg(F.sum("n").alias("n"), F.sum("far").alias("far"))
    kinds = ", ".join(f"{c} {points.schema[c].dataType.simpleString()}" for c in ("run", key, "label"))
    own = spark.createDataFrame([(i, r["run"], r[key], r["label"]) for i, r in enumerate(drawn)], f"place int, {kinds}")
    mine = F.col("other") == F.col("label")
    each = totals.join(F.broadcast(own), "place").groupBy("place", "run", key, "label").agg(
        F.max(F.when(mine, F.col("far") / F.nullif(F.col("n") - 1, F.lit(0)))).alias("_inner"),
        F.min(F.when(~mine, F.col("far") / F.col("n"))).alias("_outer"),
    )
    score = (F.col("_outer") - F.col("_inner")) / F.nullif(F.greatest("_outer", "_inner"), F.lit(0.0))
    return each.select("run", key, "label", F.coalesce(score, F.lit(0.0)).alias("silhouette"))


METRICS = {"squared_euclidean": _scores, "euclidean": _sampled_scores}


def silhouette_rows(
    labelled: DataFrame,
    columns: list[str],
    key: str = "service_name",
    label: str = "cluster_id",
    metric: str = "squared_euclidean",
) -> DataFrame:
    """Silhouette of every row by squared distances, or by Euclidean ones of a sample of ``SILHOUETTE_SAMPLE`` rows.

    Squared distances need no pairs of rows; scores differ between the two, and a k chosen by them may.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {sorted(METRICS)}")
    point = F.array(*[F.col(c).cast("double") for c in columns]).alias("x")
    points = labelled.select(F.lit(0).alias("run"), key, F.col(label).alias("label"), point)
    return METRICS[metric](points, key).select(key, F.col("label").alias(label), "silhouette")


def silhouette(
    labelled: DataFrame,
    columns: list[str],
    key: str = "service_name",
    label: str = "cluster_id",
    metric: str = "squared_euclidean",
) -> DataFrame:
    """One row ``silhouette``: the mean over the scored rows, NULL with one cluster or any noise (-1)."""
    rows = silhouette_rows(labelled, columns, key, label, metric)
    sound = labelled.agg((F.count_distinct(label) > 1) & (F.min(label) >= 0)).scalar()
    return rows.agg(F.avg("silhouette").alias("s")).select(F.when(sound, F.col("s")).alias("silhouette"))


def score_ks(
    scaled: DataFrame,
    columns: list[str],
    key: str = "service_name",
    restarts: int = 5,
    seed: int = 42,
    k_range: range = K_RANGE,
    metric: str = "squared_euclidean",
) -> DataFrame:
    """``(k, silhouette, chosen)`` for every k below the number of rows, all fitted together."""
    spark, n = scaled.sparkSession, scaled.count()
    ks = [k for k in k_range if k < n]
    if not ks:
        return spark.createDataFrame([], "k int, silhouette double, chosen boolean")
    axes = [f"z_{c}" for c in columns]
    fitted = best_runs(fit_runs(scaled, axes, key, ks, restarts, seed))
    labelled = scaled.withColumns({f"_label{k}": nearest(axes, fitted[k].centers) for k in ks})
    runs = F.explode(F.array(*[F.struct(F.lit(k).alias("run"), F.col(f"_label{k}").alias("label")) for k in ks]))
    point = F.array(*[F.col(f"z_{c}") for c in columns]).alias("x")
    points = materialize(labelled.select(runs.alias("r"), key, point).select("r.*", key, "x"), "runs")
    scores = METRICS[metric](points, key).groupBy("run").agg(
        F.avg("silhouette").alias("s"), F.count_distinct("label").alias("labels")
    )
    scores = scores.select(F.col("run").alias("k"), F.when(F.col("labels") > 1, F.col("s")).otherwise(-1.0).alias("silhouette"))
    # one row for each k
    best = F.max_by("k", F.struct("silhouette", -F.col("k"))).over(Window.partitionBy(F.lit(0)))
    return scores.withColumn("chosen", F.col("k") == best)


def choose_k(*args, **kwargs) -> list[tuple[int, float]]:
    """The score table of ``score_ks`` as a list by k."""
    return [(r["k"], r["silhouette"]) for r in score_ks(*args, **kwargs).orderBy("k").collect()]


def best_k(scores: list[tuple[int, float]]) -> int:
    best, best_score = DEFAULT_K, -1.0
    for k, score in scores:
        if score > best_score:
            best, best_score = k, score
    return best


def _rank_ids(assigned: DataFrame, rank_by: str) -> dict[int, int]:
    """Cluster ids by descending mean of ``rank_by``, so that labels do not hang on a seed."""
    means = (
        assigned.groupBy("_raw_id").agg(F.avg(rank_by).alias("m")).orderBy(F.desc("m"), "_raw_id").collect()
    )  # one row per cluster: k rows
    return {row["_raw_id"]: rank for rank, row in enumerate(means)}


def cluster_services(
    features: DataFrame,
    k: int = 8,
    columns: list[str] | None = None,
    key: str = "service_name",
    restarts: int = 10,
    seed: int = 42,
    auto_k: bool = False,
    rank_by: str = "requests_per_hour",
    save_to: str | None = None,
    metric: str = "squared_euclidean",
) -> DataFrame:
    """k-means over standardised columns; adds ``cluster_id`` and ``cluster_label``.

    ``features`` is read twice: pass a stored table. Results follow the seed alone, under any partitioning. There
    are no more clusters than distinct points; if all points are equal, all are cluster 0 and no model is stored.
    ``metric`` is that of the silhouettes which ``auto_k`` compares.
    """
    columns = _present(features, columns)
    scaled = materialize(standardize(features, columns), "scaled")
    wanted = {"columns": columns, "k": k, "auto_k": auto_k, "seed": seed}
    if auto_k:
        k = best_k(choose_k(scaled, columns, key, seed=seed, metric=metric))
    axes = [f"z_{c}" for c in columns]
    fitted = best_runs(fit_runs(scaled, axes, key, [k], restarts, seed))
    if not fitted or len(fitted[k].centers) < 2:  # one place
        return features.withColumns({"cluster_id": F.lit(0), "cluster_label": cluster_label(F.lit(0))})
    assigned = scaled.withColumn("_raw_id", nearest(axes, fitted[k].centers))
    ids = _rank_ids(assigned, rank_by)
    if save_to:
        save_model(fitted[k].centers, moments(features, columns), ids, wanted, save_to)
    return _finish(assigned, features.columns, ids)


def _finish(assigned: DataFrame, columns: list[str], ids: dict[int, int]) -> DataFrame:
    named = F.create_map(*[F.lit(v) for pair in ids.items() for v in pair]) if ids else F.create_map()
    ranked = assigned.withColumn("cluster_id", named[F.col("_raw_id")])
    return ranked.withColumn("cluster_label", cluster_label(F.col("cluster_id"))).select(
        *columns, "cluster_id", "cluster_label"
    )


def cluster_services_dbscan(
    features: DataFrame,
    eps: float = 0.5,
    min_samples: int = 5,
    columns: list[str] | None = None,
    key: str = "service_name",
) -> DataFrame:
    """Density clusters over standardised columns; noise is -1 and gets the label ``other``."""
    columns = _present(features, columns)
    scaled = materialize(standardize(features, columns), "scaled")
    found = dbscan(scaled, [f"z_{c}" for c in columns], key, eps, min_samples)
    return found.withColumn("cluster_label", cluster_label(F.col("cluster_id"))).select(
        *features.columns, "cluster_id", "cluster_label"
    )


def describe_clusters(clustered: DataFrame, key: str = "service_name", examples: int = 5) -> DataFrame:
    """Size, mean traffic, error rate and p95 of each cluster with its first services by name."""
    by = ["cluster_id", "cluster_label"]
    profile = clustered.groupBy(*by).agg(
        F.count(key).alias("service_count"),
        F.avg("requests_per_hour").alias("avg_rph"),
        F.avg("error_rate").alias("avg_error_rate"),
        F.avg("latency_p95").alias("avg_latency_p95"),
    )
    return (
        profile.join(first_names(clustered, by, key, examples), by, "left")
        .withColumnRenamed("names", "sample_services")
        .orderBy(F.desc("avg_rph"), "cluster_id")
    )


def first_names(
    table: DataFrame, by: list[str], key: str, n: int, order: list[Column] | None = None
) -> DataFrame:
    """The first ``n`` keys of each group as an array; only those ever reach a list.

    The rank filter also runs before the shuffle, so a group sends at most ``n`` rows per task.
    """
    order = order or [F.col(key)]
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    top = table.withColumn("_r", rank).where(F.col("_r") <= n)
    pairs = F.sort_array(F.collect_list(F.struct("_r", F.col(key).alias("name"))))
    return top.groupBy(*by).agg(F.transform(pairs, lambda p: p["name"]).alias("names"))


STORED = "version string, fitted_at timestamp, columns array<string>, k int, auto_k boolean, seed long, ids map<int,int>"


def save_model(centers: np.ndarray, stats: DataFrame, ids: dict[int, int], wanted: dict, path: str) -> None:
    """Centres, scaling statistics and cluster ids in a folder of their own, for scoring without another fit.

    The last write, one row in ``versions``, makes them the model: a run that dies before leaves the one
    before in place.
    """
    spark = stats.sparkSession
    version = uuid.uuid4().hex
    rows = [(j, [float(v) for v in c]) for j, c in enumerate(centers)]
    spark.createDataFrame(rows, "center int, x array<double>").coalesce(1).write.parquet(f"{path}/{version}/centers")
    stats.coalesce(1).write.parquet(f"{path}/{version}/moments")
    row = {"version": version, **wanted, "ids": ids}
    stamped = spark.createDataFrame([row], STORED.replace("fitted_at timestamp, ", ""))
    stamped = stamped.withColumn("fitted_at", F.current_timestamp()).select(*[c.name for c in _stored_schema().fields])
    stamped.coalesce(1).write.mode("append").parquet(f"{path}/versions")


def _stored_schema() -> T.StructType:
    return T.StructType.fromDDL(STORED)


def latest_model(spark: SparkSession, path: str) -> Row | None:
    """The newest stored model: version, settings and cluster ids."""
    try:
        rows = spark.read.schema(_stored_schema()).parquet(f"{path}/versions")
        return rows.orderBy(F.desc("fitted_at"), "version").first()
    except AnalysisException:
        return None


def is_fresh(spark: SparkSession, path: str, max_age_days: float = 7, **wanted) -> bool:
    """Whether the newest model below ``path`` is no older than ``max_age_days`` and was fitted as ``wanted``."""
    found = latest_model(spark, path)
    if found is None or any(found[name] != value for name, value in wanted.items()):
        return False
    age = spark.range(1).select((F.unix_micros(F.current_timestamp()) - F.unix_micros(F.lit(found["fitted_at"]))).alias("a"))
    return age.first()["a"] <= max_age_days * 86_400_000_000


def score_stored(spark: SparkSession, features: DataFrame, path: str) -> DataFrame:
    """Assign services to the clusters of the newest stored model; its columns and cluster ids hold."""
    found = latest_model(spark, path)
    if found is None:
        raise FileNotFoundError(f"no stored model below {path}")
    columns = list(found["columns"])
    stored = spark.read.parquet(f"{path}/{found['version']}/centers").orderBy("center").collect()  # k rows
    scaled = apply_moments(features, spark.read.parquet(f"{path}/{found['version']}/moments"), columns)
    assigned = scaled.withColumn("_raw_id", nearest([f"z_{c}" for c in columns], np.array([r["x"] for r in stored])))
    return _finish(assigned, features.columns, dict(found["ids"]))
