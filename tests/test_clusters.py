import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.operators import clusters as cl
from logtide.operators import components
from logtide.operators import dbscan as db
from logtide.operators import lloyd as ll
from logtide.operators.components import connected_components
from logtide.operators.scaling import moments, standardize


def brute_dbscan(x, eps, min_samples):
    """Textbook clustering in input order: seeds by first core point, borders to the first that reaches them."""
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_samples
    labels = np.full(len(x), -1)
    cluster = 0
    for i in range(len(x)):
        if not core[i] or labels[i] >= 0:
            continue
        labels[i], todo = cluster, [i]
        while todo:
            j = todo.pop()
            for k in np.flatnonzero(near[j]):
                if labels[k] < 0:
                    labels[k] = cluster
                    if core[k]:
                        todo.append(k)
        cluster += 1
    return labels


def run_dbscan(spark, x, eps, min_samples, partitions=3):
    columns = [f"c{i}" for i in range(x.shape[1])]
    rows = [(f"s{i:05d}", *map(float, p)) for i, p in enumerate(x)]
    df = spark.createDataFrame(rows, ["service_name", *columns]).repartition(partitions)
    found = db.dbscan(df, columns, eps=eps, min_samples=min_samples).orderBy("service_name").collect()
    return np.array([r.cluster_id for r in found])


def cases():
    rng = np.random.default_rng(5)
    blobs = np.vstack([rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (2, 1), (5, 5))] + [rng.uniform(-3, 8, (40, 2))])
    yield "blobs", rng.permutation(blobs), 0.35, 5
    # one point within reach of two clusters, which are more than eps apart
    left, right = [(-0.9 - 0.05 * i, 0.0) for i in range(5)], [(0.9 + 0.05 * i, 0.0) for i in range(5)]
    yield "border", np.array(right + [(0.0, 0.0)] + left), 0.95, 5
    yield "copies", np.vstack([np.zeros((40, 3)), np.ones((3, 3)), rng.normal(0, 2, (60, 3))]), 0.8, 4
    yield "chain", np.array([(0.3 * i, 0.0) for i in range(120)] + [(100.0, 0.0)]), 0.31, 2
    yield "line", rng.uniform(0, 30, (150, 1)), 0.2, 3
    yield "six", rng.normal(0, 1, (150, 6)), 1.2, 4
    yield "crowd", np.vstack([rng.normal(0, 0.05, (200, 2)), rng.normal(0.7, 0.05, (200, 2)), [(0.35, 0.35)]]), 0.5, 5
    yield "alone", rng.uniform(0, 100, (20, 2)), 0.5, 3


CASES = {name: rest for name, *rest in cases()}


@pytest.mark.parametrize("name", CASES)
def test_dbscan_equals_brute_force(spark, name):
    x, eps, min_samples = CASES[name]
    assert run_dbscan(spark, x, eps, min_samples).tolist() == brute_dbscan(x, eps, min_samples).tolist()


def test_dbscan_with_crowded_cells_in_slices(spark, monkeypatch):
    monkeypatch.setattr(db, "SLICE_ROWS", 7)
    x, eps, min_samples = CASES["crowd"]
    assert run_dbscan(spark, x, eps, min_samples).tolist() == brute_dbscan(x, eps, min_samples).tolist()


def test_no_join_of_written_tables_goes_through_the_driver(spark):
    dims = range(2)
    rows = [(f"s{i:05d}", i % 40 / 10, i // 40 / 10) for i in range(800)]
    points = spark.createDataFrame(rows, ["service_name", "c0", "c1"])
    merged = db.materialize(db._merge_points(points, "service_name", ["c0", "c1"], 0.5), "points")
    cells = db.materialize(db._cells(merged, dims, 0.5), "cells")
    near = db._near_cells(cells, dims, 0.5)
    sliced = db._sliced(merged, cells)
    core = db._core_points(sliced, cells, db.materialize(near, "near"), dims, 0.5, 5)
    hooked = components._hook(db.materialize(cells.select(F.col("cell").alias("u"), F.col("cell").alias("v")), "edges"))
    whole = db.dbscan(points, ["c0", "c1"], eps=0.5, min_samples=5)
    for made in (near, sliced, core, hooked, whole):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(int(a) + 100, int(b) + 100) for a, b in rng.integers(0, 80, (60, 2))]
    parent = {n: n for pair in pairs for n in pair}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame(pairs, "u long, v long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == {n: root(n) for n in linked}
    assert connected_components(df.limit(0)).count() == 0


def test_rounds_of_components_are_few_and_small(spark, monkeypatch):
    """The driver's memory follows the stages and tasks of the rounds, however small their edges are."""
    written = []
    keep = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, name: written.append(keep(df, name)) or written[-1])
    stars = spark.createDataFrame([(k, k % 3) for k in range(40)], "u long, v long")
    assert {r.node: r.component for r in connected_components(stars).collect()} == {k: k % 3 for k in range(40)}
    assert len(written) == 1  # no round changes a star
    path = spark.createDataFrame([(1, 2), (2, 3)], "u long, v long")
    assert {r.node: r.component for r in connected_components(path).collect()} == {1: 1, 2: 1, 3: 1}
    assert len(written) == 3  # one round, and none to see that it was the last

    moved = components._small_star(components._large_star(written[0]))
    plan = moved.distinct()._jdf.queryExecution().executedPlan().toString()
    # each star: edges once for the aggregation and once for the join; the first star is read by both of the second
    assert plan.count("SortMergeJoin") == 3 and plan.count("Exchange hashpartitioning") == 7
    assert moved.count() <= written[0].count()


def features(spark, n=60):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        level = (1.0, 50.0, 900.0)[i % 3]
        rows.append(
            (f"s{i:03d}", level + float(rng.normal(0, 0.2)), 0.1 * (i % 3), 100.0 + i % 3, 1.0 + i % 3, 10 * (i % 3), 5)
        )
    return spark.createDataFrame(
        rows,
        "service_name string, requests_per_hour double, error_rate double, latency_p95 double,"
        " peak_to_avg_ratio double, unique_users long, unique_endpoints long",
    )


def test_standardize_uses_population_deviation_and_zero_for_constants(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "a double, b double")
    got = standardize(df, ["a", "b"]).orderBy("a").collect()
    filled = np.array([0.0, 1.0, 3.0])
    assert [r.z_a for r in got] == pytest.approx(list((filled - filled.mean()) / filled.std()))
    assert {r.z_b for r in got} == {0.0}
    assert moments(df, ["a"]).first().row_count == 3


def test_kmeans_finds_groups_and_ranks_them_by_traffic(spark):
    got = cl.cluster_services(features(spark), k=3, restarts=3).collect()
    assert {(int(r.service_name[1:]) % 3, r.cluster_id, r.cluster_label) for r in got} == {
        (2, 0, "high_traffic_stable"),
        (1, 1, "high_traffic_spiky"),
        (0, 2, "medium_traffic"),
    }


def test_kmeans_does_not_depend_on_layout(spark):
    rng = np.random.default_rng(9)
    rows = [(f"s{i}", *map(float, rng.uniform(0, 1, 2))) for i in range(300)]
    df = spark.createDataFrame(rows, "service_name string, requests_per_hour double, error_rate double")
    few, many = (
        {r.service_name: r.cluster_id for r in cl.cluster_services(df.repartition(p), k=5, restarts=2).collect()}
        for p in (1, 7)
    )
    assert few == many


def test_auto_k_prefers_the_real_number_of_groups(spark):
    columns = cl.CLUSTER_COLUMNS
    scores = cl.choose_k(standardize(features(spark), columns), columns, restarts=2, k_range=range(3, 6))
    assert [k for k, _ in scores] == [3, 4, 5] and cl.best_k(scores) == 3
    assert cl.best_k([]) == cl.DEFAULT_K
    few = standardize(features(spark, 4), columns)
    assert [k for k, _ in cl.choose_k(few, columns, restarts=1)] == [3]


def brute_silhouette(x, labels, root=False):
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    d = np.sqrt(d) if root else d
    out = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i][same].sum() / (same.sum() - 1)
        b = min(d[i][labels == other].mean() for other in set(labels) - {own})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return out


def test_silhouette(spark):
    rng = np.random.default_rng(4)
    x, labels = rng.normal(0, 1, (40, 3)), rng.integers(0, 3, 40)
    labels[0] = 9  # alone
    rows = [(f"s{i:02d}", int(l), *map(float, p)) for i, (p, l) in enumerate(zip(x, labels))]
    df = spark.createDataFrame(rows, "service_name string, cluster_id int, a double, b double, c double")
    got = cl.silhouette_rows(df, ["a", "b", "c"]).orderBy("service_name").collect()
    want = brute_silhouette(x, labels)
    assert [r.silhouette for r in got] == pytest.approx(want)
    assert cl.silhouette(df, ["a", "b", "c"]).first()[0] == pytest.approx(np.mean(want))
    got = cl.silhouette_rows(df, ["a", "b", "c"], metric="euclidean").orderBy("service_name").collect()
    assert [r.silhouette for r in got] == pytest.approx(brute_silhouette(x, labels, root=True))
    with pytest.raises(ValueError):
        cl.silhouette_rows(df, ["a"], metric="manhattan")
    for metric in cl.METRICS:
        assert cl.silhouette(df.withColumn("cluster_id", F.lit(1)), ["a"], metric=metric).first()[0] is None
        assert cl.silhouette(df.limit(0), ["a"], metric=metric).first()[0] is None
    assert cl.silhouette(df.withColumn("cluster_id", F.lit(1)), ["a"]).first()[0] is None
    assert cl.silhouette(df.withColumn("cluster_id", F.col("cluster_id") - 1), ["a"]).first()[0] is None


def test_sampled_silhouettes_are_against_all_rows(spark):
    rng = np.random.default_rng(8)
    x, labels = rng.normal(0, 1, (60, 2)), rng.integers(0, 4, 60)
    rows = [(0, f"s{i}", int(l), list(map(float, p))) for i, (p, l) in enumerate(zip(x, labels))]
    df = spark.createDataFrame(rows, "run int, k string, label int, x array<double>").repartition(3)
    got = {r.k: r.silhouette for r in cl._sampled_scores(df, "k", 11).collect()}
    want = dict(zip((r[1] for r in rows), brute_silhouette(x, labels, root=True)))
    assert len(got) == 11 and got == pytest.approx({k: want[k] for k in got})


def brute_rounds(x, centers, rounds):
    """Costs before each move, and the final centres."""
    costs = []
    for _ in range(rounds):
        d = ((x[:, None] - centers[None]) ** 2).sum(-1)
        near = d.argmin(1)
        costs.append(d.min(1).sum())
        centers = np.array([x[near == j].mean(0) if (near == j).any() else centers[j] for j in range(len(centers))])
    return costs, centers


def points_table(spark, x, partitions):
    columns = [f"c{i}" for i in range(x.shape[1])]
    rows = [(f"s{i}", *map(float, p)) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, ["k", *columns]).repartition(partitions), columns


def test_rounds_equal_brute_force_and_costs_never_rise(spark):
    x = np.rint(np.random.default_rng(3).normal(0, 1, (200, 3)) * ll.GRID) / ll.GRID
    df, columns = points_table(spark, x, 5)
    blocks = ll.point_blocks(df, columns, "k")
    starts = [x[:4].copy(), x[10:13].copy(), x[50:57].copy()]
    runs = ll.run_rounds(blocks, [ll.Run(len(s), 0, s) for s in starts], 3, most=6, tolerance=0.0)
    for run, start in zip(runs, starts):
        costs, _ = brute_rounds(x, start, len(run.costs))
        assert run.costs == pytest.approx(costs, rel=1e-5)
        assert all(a >= b - 1e-3 for a, b in zip(run.costs, run.costs[1:]))


def test_runs_are_the_same_under_any_partitioning(spark, monkeypatch):
    x = np.random.default_rng(4).uniform(0, 1, (300, 2))
    found = []
    for partitions, task_rows, block in ((1, 1000, 1000), (7, 20, 16)):
        monkeypatch.setattr(ll, "TASK_ROWS", task_rows)
        monkeypatch.setattr(ll, "BLOCK_ROWS", block)
        df, columns = points_table(spark, x, partitions)
        found.append([(r.k, r.attempt, r.cost, r.centers.tolist()) for r in ll.fit_runs(df, columns, "k", [3, 5], 2, seed=1)])
    assert found[0] == found[1] and len(found[0]) == 4


def test_fewer_places_than_centres(spark):
    df, columns = points_table(spark, np.array([[0.0, 0.0]] * 5 + [[1.0, 2.0]] * 3), 2)
    best = ll.best_runs(ll.fit_runs(df, columns, "k", [2, 4], 2, seed=0))
    assert {k: (r.cost, sorted(r.centers.tolist())) for k, r in best.items()} == {k: (0.0, [[0.0, 0.0], [1.0, 2.0]]) for k in (2, 4)}
    assert ll.best_runs(ll.fit_runs(df.limit(0), columns, "k", [2], 2, seed=0)) == {}


def test_profiles_and_first_names(spark):
    df = cl.cluster_services_dbscan(features(spark), eps=1.0, min_samples=3)
    got = cl.describe_clusters(df).collect()
    assert [r.service_count for r in got] == [20, 20, 20]
    assert got[0].avg_rph > got[1].avg_rph > got[2].avg_rph
    assert got[0].sample_services == ["s002", "s005", "s008", "s011", "s014"]


def test_label_of_noise_and_high_ids(spark):
    df = spark.createDataFrame([(-1,), (0,), (7,), (8,)], ["i"])
    got = [r[0] for r in df.select(cl.cluster_label(F.col("i"))).collect()]
    assert got == ["other", "high_traffic_stable", "internal_api", "other"]


def test_stored_model_scores_like_the_fit(spark, tmp_path):
    path = str(tmp_path / "model")
    df = features(spark)
    assert not cl.is_fresh(spark, path)
    fitted = cl.cluster_services(df, k=3, restarts=2, save_to=path)
    assert cl.is_fresh(spark, path) and not cl.is_fresh(spark, path, -1)
    again = cl.score_stored(spark, df, path)
    key = ["service_name", "cluster_id", "cluster_label"]
    assert sorted(again.select(*key).collect()) == sorted(fitted.select(*key).collect())


def test_a_stored_model_keeps_its_labels_on_other_data(spark, tmp_path):
    path = str(tmp_path / "model")
    df = features(spark)
    fitted = {r.service_name: r.cluster_label for r in cl.cluster_services(df, k=3, restarts=2, save_to=path).collect()}
    quiet = df.where("requests_per_hour < 100")  # without the busiest group
    got = {r.service_name: r.cluster_label for r in cl.score_stored(spark, quiet, path).collect()}
    assert got == {name: fitted[name] for name in got} and len(got) == 40


def test_equal_rows_are_one_cluster(spark):
    same = features(spark).withColumns({c: F.lit(1.0) for c in cl.CLUSTER_COLUMNS})
    assert {r.cluster_id for r in cl.cluster_services(same, k=4).collect()} == {0}


def test_settings_of_a_stored_model_are_checked(spark, tmp_path):
    path = str(tmp_path / "model")
    cl.cluster_services(features(spark), k=2, restarts=1, save_to=path)
    assert cl.is_fresh(spark, path, k=2, auto_k=False, columns=cl.CLUSTER_COLUMNS)
    assert not cl.is_fresh(spark, path, k=5) and not cl.is_fresh(spark, path, columns=["error_rate"])
    cl.cluster_services(features(spark), k=5, restarts=1, save_to=path)
    assert cl.latest_model(spark, path).k == 5 and cl.is_fresh(spark, path, k=5)
    with pytest.raises(FileNotFoundError):
        cl.score_stored(spark, features(spark), str(tmp_path / "none"))
