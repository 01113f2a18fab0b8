"""Exact density clustering (DBSCAN) on a grid, without comparing all pairs of a neighbourhood.

Points are first merged by position, then gathered in cells so small that a cell and all cells that
touch it lie within ``eps`` of each other. Most of the work then happens between cells:

* a cell with ``min_samples`` points is all core, its points are never counted one by one;
* two cells whose boxes lie wholly within ``eps`` are linked without looking at points;
* points are compared only between cells that are near but not wholly near, and only where the
  answer is still open: for the few points of thin cells, and between cells that are not connected
  yet. Each such comparison is an equi-join on a cell and a slice of it, so a crowded cell is split.

How many cells lie near a cell depends on the number of columns only, never on how crowded they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logtide.operators.components import connected_components
from logtide.scratch import materialize, shuffled

NOISE = -1
SLICE_ROWS = 10_000
COPIES = 100  # of a cell that looks into the blocks around it, about


def _block_width(dims: range, eps: float) -> float:
    """Width of the blocks of the cell join: narrow blocks hold few cells that are not near, but a cell looks
    into more of them, ``COPIES`` in all; in many dimensions that leaves two for each."""
    return eps * min(2.0, 2.2 / (COPIES ** (1 / len(dims)) - 1))


def _sum_squares(gaps: list[Column]) -> Column:
    total = F.lit(0.0)
    for gap in gaps:
        total = total + gap * gap
    return total


def _distance2(left: str, right: str, dims: range) -> Column:
    return _sum_squares([F.col(f"{left}.x{i}") - F.col(f"{right}.x{i}") for i in dims])


def _box_gaps(dims: range) -> tuple[Column, Column]:
    """Squared least and largest distance between two cells' bounding boxes ``a`` and ``b``."""
    least, most = [], []
    for i in dims:
        lo_a, hi_a, lo_b, hi_b = (F.col(f"{s}.{e}{i}") for s in "ab" for e in ("lo", "hi"))
        least.append(F.greatest(lo_a - hi_b, lo_b - hi_a, F.lit(0.0)))
        most.append(F.greatest(hi_a - lo_b, hi_b - lo_a))
    return _sum_squares(least), _sum_squares(most)


def _merge_points(points: DataFrame, key: str, columns: list[str], eps: float) -> DataFrame:
    """Distinct positions with weight, least key, cell and point id."""
    dims = range(len(columns))
    side = eps / (2 * math.sqrt(len(columns)))
    merged = (
        points.select(
            F.col(key).alias("_key"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
        )
        .groupBy(*[f"x{i}" for i in dims])
        .agg(F.count(F.lit(1)).alias("w"), F.min("_key").alias("least_key"))
    )
    cell = F.concat_ws(",", *[F.floor(F.col(f"x{i}") / side).cast("string") for i in dims])
    return merged.withColumn("cell", cell).withColumn("pid", _position([F.col(f"x{i}") for i in dims]))


def _position(values: list[Column]) -> Column:
    """A position's name: its numbers as text, which is exact, so different positions never share one."""
    return F.concat_ws(",", *[F.coalesce((v + F.lit(0.0)).cast("string"), F.lit("")) for v in values])


def _cells(points: DataFrame, dims: range, eps: float) -> DataFrame:
    """One row per cell: weight, number of positions, slices, bounding box, block."""
    cells = points.groupBy("cell").agg(
        F.sum("w").alias("w"),
        F.count(F.lit(1)).alias("positions"),
        *[F.min(f"x{i}").alias(f"lo{i}") for i in dims],
        *[F.max(f"x{i}").alias(f"hi{i}") for i in dims],
    )
    return cells.withColumns(
        {
            "slices": F.ceil(F.col("positions") / SLICE_ROWS).cast("int"),
            **{f"k{i}": F.floor(F.col(f"lo{i}") / _block_width(dims, eps)) for i in dims},
        }
    )


def _near_cells(cells: DataFrame, dims: range, eps: float) -> DataFrame:
    """Ordered pairs of different cells whose boxes come within ``eps``, marked ``full`` if wholly so.

    A cell belongs to the block of its box's lower corner and looks into every block where the lower
    corner of a near box can lie.
    """
    block, side = _block_width(dims, eps), eps / (2 * math.sqrt(len(dims)))
    look = cells
    for i in dims:
        first = F.floor((F.col(f"lo{i}") - (eps + 1.01 * side)) / block)
        last = F.floor((F.col(f"hi{i}") + 1.01 * eps) / block)
        look = look.withColumn(f"k{i}", F.explode(F.sequence(first, last)))
    least, most = _box_gaps(dims)
    blocks = [F.col(f"a.k{i}") == F.col(f"b.k{i}") for i in dims]
    return (
        look.alias("a")
        .join(shuffled(cells).alias("b"), blocks)
        .where((F.col("a.cell") != F.col("b.cell")) & (least <= eps * eps))
        .select(
            F.col("a.cell").alias("cell"),
            F.col("b.cell").alias("other"),
            F.col("b.w").alias("other_w"),
            F.col("b.slices").alias("other_slices"),
            (most <= eps * eps).alias("full"),
        )
    )


def _sliced(points: DataFrame, cells: DataFrame) -> DataFrame:
    """Points with the slice of their cell they belong to."""
    return points.join(shuffled(cells.select("cell", "slices")), "cell").withColumn(
        "slice", F.pmod(F.xxhash64("pid"), F.col("slices")).cast("int")
    )


def _to_slices(asking: DataFrame) -> DataFrame:
    """One copy of each asking row per slice of the cell it looks into."""
    return asking.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("other_slices") - 1)))


def _meet(asking: DataFrame, points: DataFrame, dims: range, eps: float) -> DataFrame:
    """Asking points joined to the points within ``eps`` of them in the cell they look into."""
    return _to_slices(asking).alias("a").join(
        shuffled(points).alias("b"),
        (F.col("a.other") == F.col("b.cell"))
        & (F.col("a.slice") == F.col("b.slice"))
        & (_distance2("a", "b", dims) <= eps * eps),
    )


def _core_points(points, cells, near, dims, eps, min_samples):
    """Positions with at least ``min_samples`` points within ``eps``, themselves included."""
    full = near.where("full").groupBy("cell").agg(F.sum("other_w").alias("full_w"))
    sure = cells.join(shuffled(full), "cell", "left").select(
        "cell", (F.col("w") + F.coalesce("full_w", F.lit(0))).alias("sure_w")
    )
    weighed = points.join(shuffled(sure), "cell")
    settled = weighed.where(F.col("sure_w") >= min_samples)
    open_points = weighed.where(F.col("sure_w") < min_samples)
    asking = open_points.join(shuffled(near.where(~F.col("full"))), "cell")
    found = (
        _meet(asking.drop("slice", "slices"), points, dims, eps)
        .groupBy(F.col("a.pid").alias("pid"))
        .agg(F.sum("b.w").alias("found_w"))
    )
    proven = (
        open_points.join(shuffled(found), "pid", "left")
        .where(F.col("sure_w") + F.coalesce("found_w", F.lit(0)) >= min_samples)
        .select(settled.columns)
    )
    return settled.unionByName(proven).drop("sure_w")


def _linked_cells(core, near, dims, eps) -> DataFrame:
    """``(cell, component)`` of the cells that hold core points."""
    boxes = core.groupBy("cell").agg(
        F.count(F.lit(1)).alias("positions"),
        *[F.min(f"x{i}").alias(f"lo{i}") for i in dims],
        *[F.max(f"x{i}").alias(f"hi{i}") for i in dims],
    )
    boxes = materialize(boxes, "core-cells")
    least, most = _box_gaps(dims)
    pairs = (
        near.where(F.col("cell") < F.col("other"))
        .alias("n")
        .join(shuffled(boxes).alias("a"), F.col("n.cell") == F.col("a.cell"))
        .join(shuffled(boxes).alias("b"), F.col("n.other") == F.col("b.cell"))
        .where(least <= eps * eps)
        .select(
            F.col("n.cell").alias("u"),
            F.col("n.other").alias("v"),
            (F.col("n.full") | (most <= eps * eps)).alias("full"),
        )
    )
    pairs = materialize(pairs, "core-pairs")
    groups = _label(boxes.select("cell"), pairs.where("full").select("u", "v"))
    # point tests only between cells that are still apart
    apart = (
        pairs.where(~F.col("full"))
        .join(shuffled(groups.select(F.col("cell").alias("u"), F.col("component").alias("cu"))), "u")
        .join(shuffled(groups.select(F.col("cell").alias("v"), F.col("component").alias("cv"))), "v")
        .where(F.col("cu") != F.col("cv"))
        .select("u", "v", "cu", "cv")
    )
    apart = materialize(apart, "apart")
    if apart.isEmpty():
        return groups
    # the second graph has one node per group found so far
    met = apart.join(shuffled(_touching(core, boxes, apart, dims, eps)), ["u", "v"])
    joined = _label(
        groups.select(F.col("component").alias("cell")).distinct(),
        met.select(F.col("cu").alias("u"), F.col("cv").alias("v")),
    )
    return materialize(
        groups.withColumnRenamed("component", "group")
        .join(shuffled(joined.select(F.col("cell").alias("group"), "component")), "group")
        .select("cell", "component"),
        "components",
    )


def _label(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Component of every node; a node without links is its own."""
    found = connected_components(links).withColumnRenamed("node", "cell")
    return materialize(
        nodes.join(shuffled(found), "cell", "left").select("cell", F.coalesce("component", "cell").alias("component")),
        "components",
    )


def _touching(core, boxes, apart, dims, eps) -> DataFrame:
    """Pairs of ``apart`` with a core point of each within ``eps`` of the other."""
    box = boxes.select(
        F.col("cell").alias("other"),
        F.ceil(F.col("positions") / SLICE_ROWS).cast("int").alias("other_slices"),
        *[f"lo{i}" for i in dims],
        *[f"hi{i}" for i in dims],
    )
    # of the first cell only the points that come near the second one's box
    to_box = _sum_squares(
        [
            F.greatest(F.col(f"lo{i}") - F.col(f"x{i}"), F.col(f"x{i}") - F.col(f"hi{i}"), F.lit(0.0))
            for i in dims
        ]
    )
    asking = (
        core.drop("slice", "slices")
        .join(shuffled(apart.select(F.col("u").alias("cell"), F.col("v").alias("other"))), "cell")
        .join(shuffled(box), "other")
        .where(to_box <= eps * eps)
    )
    own = shuffled(box.select(F.col("other").alias("cell"), "other_slices"))
    slices = core.join(own, "cell").withColumn(
        "slice", F.pmod(F.xxhash64("pid"), F.col("other_slices")).cast("int")
    )
    return (
        _meet(asking, slices, dims, eps)
        .select(F.col("a.cell").alias("u"), F.col("b.cell").alias("v"))
        .distinct()
    )


def _border_points(points, core, labels, near, dims, eps) -> DataFrame:
    """Non-core positions near a core point, with the smallest cluster among those."""
    loose = points.join(shuffled(core.select("pid")), "pid", "left_anti")
    # inside one cell everything is within eps
    own = loose.join(shuffled(labels), "cell").select("pid", "cluster_id")
    asking = loose.drop("slice", "slices").join(shuffled(near), "cell")
    others = labels.select(F.col("cell").alias("other"), F.col("cluster_id").alias("other_id"))
    seen = asking.join(shuffled(others), "other")
    by_box = seen.where("full").select("pid", F.col("other_id").alias("cluster_id"))
    by_point = _meet(seen.where(~F.col("full")), core, dims, eps).select(
        F.col("a.pid").alias("pid"), F.col("a.other_id").alias("cluster_id")
    )
    return (
        own.unionByName(by_box).unionByName(by_point).groupBy("pid").agg(F.min("cluster_id").alias("cluster_id"))
    )


def dbscan(
    points: DataFrame,
    columns: list[str],
    key: str = "service_name",
    eps: float = 0.5,
    min_samples: int = 5,
) -> DataFrame:
    """Add ``cluster_id``: 0, 1, … in the order of each cluster's least core key, -1 for noise.

    A border point that several clusters reach joins the smallest of them. ``points`` is read twice.
    """
    dims = range(len(columns))
    merged = materialize(_merge_points(points, key, columns, eps), "points")
    cells = materialize(_cells(merged, dims, eps), "cells")
    near = materialize(_near_cells(cells, dims, eps), "near-cells")
    sliced = _sliced(merged, cells)
    core = materialize(_core_points(sliced, cells, near, dims, eps, min_samples), "core")
    linked = _linked_cells(core, near, dims, eps)
    first = core.join(shuffled(linked), "cell").groupBy("component").agg(F.min("least_key").alias("first_key"))
    ranks = shuffled(_rank_in_order(first, "first_key"))
    labels = linked.join(ranks, "component").select("cell", "cluster_id")
    labels = materialize(labels, "labels")
    found = core.select("pid", "cell").join(shuffled(labels), "cell").select("pid", "cluster_id").unionByName(
        _border_points(sliced, core, labels, near, dims, eps)
    )
    return (
        points.withColumn("pid", _position([F.col(c).cast("double") for c in columns]))
        .join(shuffled(found), "pid", "left")
        .withColumn("cluster_id", F.coalesce("cluster_id", F.lit(NOISE)))
        .drop("pid")
    )


def _rank_in_order(table: DataFrame, by: str) -> DataFrame:
    """0-based rank over the whole table without a single-task sort: counts per sorted partition."""
    ordered = materialize(
        table.repartitionByRange(F.col(by)).sortWithinPartitions(by).withColumn("_part", F.spark_partition_id()),
        "ordered",
    )
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # one row per partition of the range split
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_size")
    within = F.row_number().over(Window.partitionBy("_part").orderBy(by))
    return (
        ordered.join(offsets, "_part")
        .withColumn("cluster_id", (F.col("_before") + within - 1).cast("int"))
        .drop("_part", "_before")
    )
