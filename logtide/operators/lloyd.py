"""k-means for many restarts and many k in one pass a round.

Points lie on a grid of 2**-20 and are packed into blocks of numbers, so that a round reads a few rows. Every round of all
runs (one for each k and restart) is one aggregation: a task adds up, for each centre of each run, the points that are nearest
to it, and the sums of the tasks meet under (run, centre). Coordinates and squared distances are added up as whole numbers;
so results are the same under any partitioning, to the last bit, and a seed needs no layout of its own.

Starting centres come from oversampling (k-means||): in each of a few passes a run draws points with a chance that follows
their distance to what it has, as the least of hash-made exponential draws, which tasks can merge; what is drawn, weighted by
the points nearest to it, is clustered on the driver: at most ``1 + PASSES * 2 * k`` points a run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logtide.scratch import materialize

GRID = 1 << 20
BLOCK_ROWS = 16_384
#: Rows for one task; tables of fewer rows are one task's work.
TASK_ROWS = 250_000
PASSES = 2
U = np.uint64


@dataclass
class Run:
    """One restart for one k: its centres, and after each round their cost before it moved them."""

    k: int
    attempt: int
    centers: np.ndarray
    costs: list[float] = field(default_factory=list)
    moving: bool = True

    @property
    def cost(self) -> float:
        """Sum of squared distances to the nearest of the final centres."""
        return self.costs[-1]


def on_grid(column: Column) -> Column:
    return F.bround(column * float(GRID)).cast("bigint")


def point_blocks(scaled: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Written blocks ``(h, x)`` of the hashes and coordinates of up to ``BLOCK_ROWS`` points."""
    width = len(columns)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                h, *x = (part.column(k).to_numpy() for k in range(width + 1))
                packed = [h.tobytes(), np.column_stack(x).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in packed], ["h", "x"])

    points = scaled.select(F.xxhash64(key).alias("h"), *[on_grid(F.col(c)).alias(f"x{k}") for k, c in enumerate(columns)])
    tasks = -(-scaled.count() // TASK_ROWS)
    return materialize(points.repartition(max(tasks, 1)).mapInArrow(pack, "h binary, x binary"), "points")


def squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of points to centres, column by column, so that a pair's value hangs on nothing else."""
    out = np.zeros((len(x), len(centers)))
    for j in range(x.shape[1]):
        apart = x[:, j, None] - centers[None, :, j]
        out += apart * apart
    return out


def _uniform(h: np.ndarray, *salt: int) -> np.ndarray:
    """A number in (0, 1) for each hash and salt."""
    with np.errstate(over="ignore"):
        v = h.view(U).copy()
        for s in salt:
            v = (v + U(s + 1)) * U(0x9E3779B97F4A7C15)
            v = (v ^ (v >> U(32))) * U(0xD6E8FEB86659FD93)
            v ^= v >> U(29)
    return ((v >> U(11)).astype(float) + 0.5) / float(1 << 53)


def _each(blocks: DataFrame, work: Callable[[np.ndarray, np.ndarray], None], done: Callable[[], dict], schema: str) -> DataFrame:
    """``work`` on the points of every block of a task, then the columns that ``done`` returns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = np.frombuffer(h, np.int64)
                work(hashes, np.frombuffer(x, np.int64).reshape(len(hashes), -1))
        columns = done()
        if len(next(iter(columns.values()))):
            yield pa.RecordBatch.from_pydict(columns)

    return blocks.mapInArrow(run, schema)


def _draw(blocks: DataFrame, runs: list[Run], salt: int, seed: int, width: int) -> list[np.ndarray]:
    """For each run ``2 * k`` points (the first time one), drawn by their squared distance to what it has."""
    wanted = [2 * r.k if len(r.centers) else 1 for r in runs]
    centers = [r.centers for r in runs]
    attempts = [r.attempt for r in runs]
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros((0, width), np.int64)) for _ in runs]

    def work(h: np.ndarray, x: np.ndarray) -> None:
        at = x / GRID
        for i, own in enumerate(centers):
            weight = squared(at, own).min(axis=1) if len(own) else np.ones(len(x))
            live = np.flatnonzero(weight > 0)
            draw = -np.log(_uniform(h[live], seed, attempts[i], salt)) / weight[live]
            take = np.argsort(draw, kind="stable")[: wanted[i]]
            keys, points = np.concatenate([best[i][0], draw[take]]), np.concatenate([best[i][1], x[live[take]]])
            order = np.lexsort((*points.T[::-1], keys))[: wanted[i]]
            best[i] = keys[order], points[order]

    def done() -> dict:
        return {
            "run": pa.array([i for i, (keys, _) in enumerate(best) for _ in keys], pa.int32()),
            "draw": pa.array([float(v) for keys, _ in best for v in keys], pa.float64()),
            "x": pa.array([[int(v) for v in p] for _, points in best for p in points], pa.list_(pa.int64())),
        }

    rows = _each(blocks, work, done, "run int, draw double, x array<bigint>")
    place = F.row_number().over(Window.partitionBy("run").orderBy("draw", "x"))
    sizes = F.array(*[F.lit(w) for w in wanted])
    kept = rows.withColumn("place", place).where(F.col("place") <= F.get(sizes, F.col("run"))).collect()  # 2k rows a run
    out: list[list] = [[] for _ in runs]
    for r in sorted(kept, key=lambda r: (r["run"], r["place"])):
        out[r["run"]].append(r["x"])
    return [np.array(o, np.int64).reshape(-1, width) / GRID for o in out]


def _sums(blocks: DataFrame, centers: list[np.ndarray], width: int) -> dict[tuple[int, int], tuple]:
    """``(run, centre) -> (points, cost, sums)`` of the points nearest to each centre; the first of equally near ones."""
    held = [np.zeros((len(c), width + 2), np.int64) for c in centers]

    def work(h: np.ndarray, x: np.ndarray) -> None:
        at = x / GRID
        for own, total in zip(centers, held):
            far = squared(at, own)
            near = far.argmin(axis=1)
            total[:, 0] += np.bincount(near, minlength=len(own))
            np.add.at(total[:, 1], near, np.rint(far[np.arange(len(x)), near] * GRID).astype(np.int64))
            order = np.argsort(near, kind="stable")
            begin = np.searchsorted(near[order], np.arange(len(own)))
            some = np.flatnonzero(np.bincount(near, minlength=len(own)))
            total[some, 2:] += np.add.reduceat(x[order], begin[some], axis=0)

    names = ["n", "cost", *[f"s{j}" for j in range(width)]]

    def done() -> dict:
        place = [(i, j) for i, t in enumerate(held) for j in range(len(t)) if t[j, 0]]
        columns = {n: pa.array([int(held[i][j, c]) for i, j in place], pa.int64()) for c, n in enumerate(names)}
        return {"run": pa.array([i for i, _ in place], pa.int32()), "center": pa.array([j for _, j in place], pa.int32()), **columns}

    rows = _each(blocks, work, done, "run int, center int, " + ", ".join(f"{n} long" for n in names))
    totals = rows.groupBy("run", "center").agg(*[F.sum(n).alias(n) for n in names]).collect()  # one row for each centre
    return {(r["run"], r["center"]): (r["n"], r["cost"], [r[f"s{j}"] for j in range(width)]) for r in totals}


def weighted_start(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most k centres of a few weighted points: k-means++ and a few rounds."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))]
    while len(chosen) < min(k, len(points)):
        far = squared(points, points[chosen]).min(axis=1) * weights
        if far.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(points), p=far / far.sum())))
    centers = points[chosen].copy()
    for _ in range(20):
        near = squared(points, centers).argmin(axis=1)
        for j in range(len(centers)):
            if (near == j).any():
                centers[j] = np.average(points[near == j], axis=0, weights=weights[near == j])
    return centers


def start_runs(blocks: DataFrame, ks: list[int], restarts: int, seed: int, width: int) -> list[Run]:
    """A run with starting centres for each k and restart; fewer than k where there are fewer places."""
    runs = [Run(k, a, np.zeros((0, width))) for k in ks for a in range(restarts)]
    for salt in range(1 + PASSES):
        for r, drawn in zip(runs, _draw(blocks, runs, salt, seed, width)):
            r.centers = np.unique(np.concatenate([r.centers, drawn]), axis=0)
    weights = _sums(blocks, [r.centers for r in runs], width)
    for i, r in enumerate(runs):
        w = np.array([weights.get((i, j), (0,))[0] for j in range(len(r.centers))], float)
        if w.sum() > 0:
            r.centers = weighted_start(r.centers, w, r.k, seed + r.attempt)
    return runs


def run_rounds(blocks: DataFrame, runs: list[Run], width: int, most: int = 100, tolerance: float = 1e-4) -> list[Run]:
    """Move the centres of all runs to the means of their points until a run's squared moves add up to no more than ``tolerance``.

    A centre without points stays. A last pass takes the cost of the final centres.
    """
    for step in range(most + 1):
        live = [r for r in runs if (r.moving or step == most or len(r.costs) == 0) and len(r.centers)]
        if not live:
            break
        totals = _sums(blocks, [r.centers for r in live], width)
        for i, r in enumerate(live):
            r.costs.append(sum(totals[i, j][1] for j in range(len(r.centers)) if (i, j) in totals) / GRID)
            if step == most:
                continue
            moved = r.centers.copy()
            for j in range(len(moved)):
                n, _, sums = totals.get((i, j), (0, 0, None))
                if n:
                    moved[j] = [s / n / GRID for s in sums]
            r.moving = bool(((moved - r.centers) ** 2).sum() > tolerance)
            if r.moving:  # else the last cost is that of the centres that stay
                r.centers = moved
    return runs


def fit_runs(
    scaled: DataFrame, columns: list[str], key: str, ks: list[int], restarts: int, seed: int, most: int = 100, tolerance: float = 1e-4
) -> list[Run]:
    """All runs, fitted together."""
    blocks = point_blocks(scaled, columns, key)
    return run_rounds(blocks, start_runs(blocks, ks, restarts, seed, len(columns)), len(columns), most, tolerance)


def best_runs(runs: list[Run]) -> dict[int, Run]:
    """For each k the run of least cost, the first of equal ones."""
    out: dict[int, Run] = {}
    for r in runs:
        if len(r.centers) and (r.k not in out or r.cost < out[r.k].cost):
            out[r.k] = r
    return out


def nearest(columns: list[str], centers: np.ndarray) -> Column:
    """The nearest centre's number, the first of equally near ones: a column expression over k x d constants."""
    points = [on_grid(F.col(c)) / float(GRID) for c in columns]
    far = [sum(((p - float(v)) * (p - float(v)) for p, v in zip(points, c)), F.lit(0.0)) for c in centers]
    return F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(j).alias("j")) for j, d in enumerate(far)]))["j"]
