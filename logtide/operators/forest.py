"""Isolation forest over a feature table (Liu, Ting and Zhou, "Isolation Forest", ICDM 2008).

Every tree sees at most 256 rows and has at most 511 nodes, so trees grow in parallel as small groups
and the whole forest has a fixed size bound (trees x 511 nodes), which is what is sent to the tasks.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logtide.operators.anomalies import SERVICE_MIN_ROWS, SERVICE_SCORED
from logtide.operators.percentiles import exact_percentiles
from logtide.operators.scaling import scale_scores
from logtide.scratch import materialize

TREES = 100
SAMPLE = 256
NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, path double, tree_rows int"
MOST_NODES = TREES * 20 * 511


def average_path(n):
    """Mean depth of an unsuccessful search among ``n`` rows: the paper's c(n)."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    long = 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def _tree_rows(table: DataFrame, key: str, columns: list[str], trees: int, sample: int, seed: int) -> DataFrame:
    """Rows of each tree: the ``sample`` smallest of a hash per row and tree, as published (psi).

    A row first decides by itself, with odds that give each tree ten standard errors more rows than it
    needs (all rows, if there are no more); the exact cut happens in groups of that size. How many rows a
    tree did get stands in its nodes.
    """
    n = max(table.count(), 1)
    odds = min(1.0, (sample + 10 * math.sqrt(sample)) / n)

    def draw(tree: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.col(key), tree), F.lit(2**31)) / float(2**31)

    # a row's trees are drawn inside its array, so the generator makes the drawn rows only
    all_trees = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), draw(t).alias("draw")))
    own = F.filter(all_trees, lambda t: t["draw"] < odds)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    drawn = table.select(key, x.alias("x"), F.inline(own))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("draw", key))
    return drawn.withColumn("r", rank).where(F.col("r") <= sample).drop("r")


def _grow(rows: pd.DataFrame, seed: int) -> pd.DataFrame:
    """One tree as a node table, split at random between the ends of a random varying column."""
    tree = int(rows["tree"].iloc[0])
    rows = rows.sort_values("draw", kind="stable")
    x = np.stack(rows["x"].to_numpy())
    rng = np.random.default_rng([seed, tree])
    limit = math.ceil(math.log2(max(len(x), 2)))
    nodes, todo = [], [(0, np.arange(len(x)), 0)]
    made = 1
    while todo:
        node, members, depth = todo.pop()
        part = x[members]
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(varying) == 0:
            nodes.append((tree, node, -1, 0.0, -1, -1, depth + float(average_path(len(members))), len(x)))
            continue
        feature = int(rng.choice(varying))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] <= cut
        if goes_left.all():  # the draw hit the upper end
            cut = float(low[feature])
            goes_left = part[:, feature] <= cut
        nodes.append((tree, node, feature, cut, made, made + 1, 0.0, len(x)))
        todo += [(made, members[goes_left], depth + 1), (made + 1, members[~goes_left], depth + 1)]
        made += 2
    return pd.DataFrame(nodes, columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])


def spark_cores(table: DataFrame) -> int:
    return table.sparkSession.sparkContext.defaultParallelism


def fit_forest(
    table: DataFrame,
    columns: list[str],
    key: str = "service_name",
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = 42,
) -> DataFrame:
    """The forest as a node table, written once; fits a stored Parquet table as is."""
    rows = _tree_rows(table, key, columns, trees, sample, seed)
    tasks = min(trees, spark_cores(table))
    grown = rows.repartition(tasks, "tree").groupBy("tree").applyInPandas(lambda pdf: _grow(pdf, seed), NODE_SCHEMA)
    return materialize(grown, "forest")


def store_forest(forest: DataFrame, columns: list[str], path: str) -> DataFrame:
    """Write the nodes below ``path`` with the columns they split on and the time; returns them read back."""
    version = uuid.uuid4().hex
    stamped = forest.withColumns(
        {"version": F.lit(version), "fitted_at": F.current_timestamp(), "columns": F.array(*[F.lit(c) for c in columns])}
    )
    stamped.coalesce(1).write.mode("append").parquet(path)  # one file: a forest is stored whole or not at all
    stored = forest.sparkSession.read.parquet(path)
    return stored.where(F.col("version") == version).select(*forest.columns)


def stored_forest(spark: SparkSession, path: str, columns: list[str], max_age_days: float) -> DataFrame | None:
    """Nodes of the newest stored forest over these columns that is young enough, or None."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException:
        return None
    oldest = F.current_timestamp() - F.expr(f"INTERVAL {int(max_age_days * 86400)} SECONDS")
    usable = table.where((F.col("columns") == F.array(*[F.lit(c) for c in columns])) & (F.col("fitted_at") >= oldest))
    newest = usable.agg(F.max_by("version", F.struct("fitted_at", "version"))).first()[0]
    if newest is None:
        return None
    return table.where(F.col("version") == newest).select(*[c.split()[0] for c in NODE_SCHEMA.split(", ")])


def score_forest(table: DataFrame, forest: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``raw_score`` = 2 ** (-mean of path / c(rows of the tree)); higher is more unusual."""
    nodes = forest.orderBy("tree", "node").limit(MOST_NODES + 1).toPandas()
    if len(nodes) > MOST_NODES:
        raise ValueError(f"a forest of more than {MOST_NODES} nodes is too large to send to every task")
    trees = [g.reset_index(drop=True) for _, g in nodes.groupby("tree")]
    packed = [{c: t[c].to_numpy() for c in ("feature", "cut", "left", "right", "path")} for t in trees]
    scales = [float(average_path(t["tree_rows"].iloc[0])) or 1.0 for t in trees]

    @F.pandas_udf("double")
    def isolation(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            x = np.stack(series.to_numpy()) if len(series) else np.zeros((0, len(columns)))
            total = np.zeros(len(x))
            every = np.arange(len(x))
            for t, scale in zip(packed, scales):
                at = np.zeros(len(x), dtype=int)
                while (t["feature"][at] >= 0).any():
                    feature = t["feature"][at]
                    inner = feature >= 0
                    left = x[every, np.maximum(feature, 0)] <= t["cut"][at]
                    at = np.where(inner, np.where(left, t["left"][at], t["right"][at]), at)
                total += t["path"][at] / scale
            yield pd.Series(2.0 ** -(total / len(packed)))

    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    return table.withColumn("raw_score", isolation(x))


def service_anomalies_iforest(
    features: DataFrame,
    contamination: float = 0.05,
    columns: list[str] | None = None,
    key: str = "service_name",
    trees: int = TREES,
    seed: int = 42,
    forest: DataFrame | None = None,
    min_rows: int = SERVICE_MIN_ROWS,
) -> DataFrame:
    """Add ``anomaly_score`` (scaled to [0, 1]) and ``is_anomaly`` (above the ``1 - contamination`` cut).

    ``features`` is read several times: pass a stored table. Fewer than ``min_rows`` rows are not scored.
    A stored ``forest`` scores without fitting.
    """
    columns = [c for c in (columns or SERVICE_SCORED) if c in features.columns]
    if len(features.limit(min_rows).take(min_rows)) < min_rows:
        return features.withColumns({"anomaly_score": F.lit(0.0), "is_anomaly": F.lit(False)})
    if forest is None:
        forest = fit_forest(features, columns, key, trees, SAMPLE, seed)
    scored = materialize(score_forest(features, forest, columns), "scored")
    cut = exact_percentiles(scored, [], "raw_score", {"cut": 1 - contamination}).scalar()
    return (
        scale_scores(scored, "raw_score")
        .withColumn("is_anomaly", F.col("raw_score") > cut)
        .drop("raw_score")
    )
