"""k-means with several starts for several k in the same passes over the points.

Spark ML's KMeans has no number of starts, so a sweep would scan the points once per k,
start and iteration. Here every pass serves all runs: tasks add up their partition's
points per run and cluster, Spark sums these small rows, and only centres (at most
runs × k rows) reach the driver. Runs start near their end: a few rounds draw far more
candidates than centres, one pass weighs them by the points they stand for, and every run
is settled on the weighted candidates before it sees the points.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

# Tasks carry the helpers below with them; executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# Rounds in which candidate centres are drawn, and points of a task in the passes.
ROUNDS = 3
TASK_POINTS = 50_000


@dataclass
class Run:
    """One start for one k: its centres, cluster sizes and cost, and how it came to rest."""

    k: int
    start: int
    centers: np.ndarray
    sizes: np.ndarray | None = None
    cost: float = float("inf")
    passes: int = 0
    converged: bool = False


def _squares(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    squares = np.zeros((len(points), len(centers)))
    for axis in range(points.shape[1]):
        squares += (points[:, axis, None] - centers[None, :, axis]) ** 2
    return squares


def _nearest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of each point, the first on ties, and its squared distance.

    Centre by centre over long columns; rows as short as the few centres of a run cost more to
    step through than to work out.
    """
    columns = np.ascontiguousarray(points.T)
    nearest, least = np.zeros(len(points), np.int64), np.full(len(points), np.inf)
    for number, center in enumerate(centers):
        squares = np.zeros(len(points))
        for column, x in zip(columns, center):
            gap = column - x
            gap *= gap
            squares += gap
        np.putmask(nearest, squares < least, number)
        np.minimum(least, squares, out=least)
    return nearest, least


def _uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on key and salt only, not on the partitioning."""
    mixed = keys.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    mixed = mixed ^ (mixed >> np.uint64(31))
    return ((mixed >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The points of a batch, one a row, as its values lie."""
    values = batch.column("point").flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def _drawn(points: DataFrame, centers: np.ndarray, n: int, salt: int) -> np.ndarray:
    """``n`` points drawn with the odds of their squared distance to the nearest centre.

    Each point gets an exponential time with that rate and the earliest win, so a draw is a
    choice of minima, and the same points give the same draw wherever they lie. A task
    returns its ``n`` earliest points. Points on a centre are not drawn.
    """
    def earliest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, rows = np.zeros(0), None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = _matrix(batch)
            weight = _nearest(own, centers)[1] if len(centers) else np.ones(len(own))
            with np.errstate(divide="ignore"):
                found = -np.log(_uniform(batch.column("code").to_numpy(), salt)) / weight
            times = np.concatenate([times, found])
            rows = own if rows is None else np.concatenate([rows, own])
            kept = np.argsort(times, kind="stable")[:n]
            times, rows = times[kept], rows[kept]
        last = np.isfinite(times).sum()
        if last:
            yield pa.RecordBatch.from_arrays([pa.array(times[:last]), pa.array(rows[:last].tolist(), pa.list_(pa.float64()))], ["time", "point"])

    found = points.select("code", "point").mapInArrow(earliest, "time double, point array<double>").orderBy("time", "point").limit(n)
    return np.array([row["point"] for row in found.collect()]).reshape(-1, centers.shape[1])


def candidates(points: DataFrame, width: int, n: int, seed: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Candidate centres and how many points lie nearest to each.

    After a first point, each round draws ``8 * n`` points (32 at least) by their distance to
    all candidates so far. Rounds go on until ``n`` candidates differ.
    """
    found = _drawn(points, np.empty((0, width)), 1, seed * 1009)
    turn = 0
    while turn < rounds or len(np.unique(found, axis=0)) < n:
        turn += 1
        more = _drawn(points, found, max(32, 8 * n), seed * 1009 + turn)
        if not len(more):
            break
        found = np.unique(np.concatenate([found, more]), axis=0)
    run = Run(len(found), 0, found)
    sums = _sums(points, [run])
    return found, _spread(sums, run, 0)[0]


def _settled_start(found: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres of ``k`` clusters of the weighted candidates, drawn by distance and moved until they rest."""
    draw = np.random.default_rng(seed)
    centers = found[[draw.choice(len(found), p=weights / weights.sum())]]
    while len(centers) < k:
        odds = weights * _squares(found, centers).min(axis=1)
        odds = odds if odds.sum() > 0 else _squares(found, centers).min(axis=1) + 1e-300
        centers = np.vstack([centers, found[draw.choice(len(found), p=odds / odds.sum())]])
    for _ in range(100):
        nearest = _squares(found, centers).argmin(axis=1)
        size = np.bincount(nearest, weights, k)
        moved = centers.copy()
        for axis in range(found.shape[1]):
            total = np.bincount(nearest, weights * found[:, axis], k)
            moved[size > 0, axis] = total[size > 0] / size[size > 0]
        if (moved == centers).all():
            break
        centers = moved
    return centers


def _sums(points: DataFrame, runs: list[Run]) -> pd.DataFrame:
    """Size, cost and coordinate sums of each cluster of each run, added up task by task."""
    width = runs[0].centers.shape[1]
    stacks = [run.centers for run in runs]
    rows = [(index, cluster) for index, centers in enumerate(stacks) for cluster in range(len(centers))]
    axes = [f"x{axis}" for axis in range(width)]

    def partials(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(rows), 2 + width))
        for batch in batches:
            if not batch.num_rows:
                continue
            own, at = _matrix(batch), 0
            for centers in stacks:
                nearest, squares = _nearest(own, centers)
                part = total[at: at + len(centers)]
                part[:, 0] += np.bincount(nearest, minlength=len(centers))
                part[:, 1] += np.bincount(nearest, squares, len(centers))
                for axis in range(width):
                    part[:, 2 + axis] += np.bincount(nearest, own[:, axis], len(centers))
                at += len(centers)
        if total[:, 0].any():
            run, cluster = np.array(rows, dtype=np.int32).T
            yield pa.RecordBatch.from_arrays([pa.array(run), pa.array(cluster), *map(pa.array, total.T.copy())], ["run", "cluster", "n", "cost", *axes])

    schema = "run int, cluster int, n double, cost double, " + ", ".join(f"{a} double" for a in axes)
    added = points.select("point").mapInArrow(partials, schema).groupBy("run", "cluster").agg(
        *[F.sum(name).alias(name) for name in ("n", "cost", *axes)]
    )
    return added.toPandas()  # one row per run and cluster


def _spread(sums: pd.DataFrame, run: Run, index: int) -> tuple[np.ndarray, np.ndarray, float]:
    rows = sums[sums["run"] == index].sort_values("cluster")
    n = rows["n"].to_numpy()
    centers = run.centers.copy()
    filled = n > 0
    centers[filled] = rows.filter(regex="^x").to_numpy()[filled] / n[filled, None]
    return n, centers, float(rows["cost"].sum())


def _settle(points: DataFrame, runs: list[Run], max_passes: int, tolerance: float) -> None:
    """Move the centres of all runs until each moves by at most ``tolerance`` (sum of squares)."""
    moving = list(runs)
    for _ in range(max_passes):
        sums = _sums(points, moving)
        still = []
        for index, run in enumerate(moving):
            _, centers, _ = _spread(sums, run, index)
            run.passes += 1
            run.converged = bool(((centers - run.centers) ** 2).sum() <= tolerance)
            run.centers = centers
            if not run.converged:
                still.append(run)
        moving = still
        if not moving:
            break
    sums = _sums(points, runs)
    for index, run in enumerate(runs):
        run.sizes, _, run.cost = _spread(sums, run, index)


def refined(points: DataFrame, centers: np.ndarray, max_passes: int = 300, tolerance: float = 1e-4) -> Run:
    """k-means from stated centres; ``converged`` tells whether it settled within ``max_passes``."""
    run = Run(len(centers), 0, np.asarray(centers, dtype=float))
    _settle(points, [run], max_passes, tolerance)
    return run


def best_runs(points: DataFrame, width: int, ks: list[int], starts: int, seed: int,
              max_passes: int = 300, tolerance: float = 1e-4) -> dict[int, Run]:
    """The run of least cost for each k.

    ``points`` has a bigint ``code`` (a hash of the entity) and an array ``point``. Runs
    stop when their centres move by at most ``tolerance`` (sum of squares) or after
    ``max_passes``, which ``passes`` and ``converged`` of a run tell; an emptied cluster
    keeps its centre.
    """
    found, weights = candidates(points, width, max(ks), seed)
    # fewer, fuller tasks; a pass over the points of one task needs no exchange
    points = points.coalesce(max(1, math.ceil(weights.sum() / TASK_POINTS)))
    runs = [Run(k, start, _settled_start(found, weights, k, seed + start)) for k in ks for start in range(starts)]
    _settle(points, runs, max_passes, tolerance)
    best: dict[int, Run] = {}
    for run in runs:
        if run.k not in best or run.cost < best[run.k].cost:
            best[run.k] = run
    return best


def with_assignments(points: DataFrame, runs: dict[str, np.ndarray]) -> DataFrame:
    """Add a column per run with the number of the nearest centre."""
    schema = T.StructType([*points.schema.fields, *[T.StructField(name, T.IntegerType()) for name in runs]])

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch)
                numbers = [pa.array(_nearest(own, centers)[0].astype(np.int32)) for centers in runs.values()]
                yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], [*batch.schema.names, *runs])

    return points.mapInArrow(assign, schema)
