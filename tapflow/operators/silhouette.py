"""Silhouettes and WCSS of given assignments: over all pairs, by cluster moments, by centres."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Rows of a tile: this many where that leaves up to TASKS tiles, more beyond, FULL times as many at most.
TILE_ROWS = 1024
TASKS = 48
FULL = 16
# Rows of a tile and points they meet at a time, so that their distances stay in the cache.
OWN_ROWS, MET_ROWS = 32, 4096
# Values that the vectors of a block hold, and rows whose sums by run are held at a time.
BLOCK_VALUES, RUN_ROWS = 1 << 17, 2048
# Share of the squared length below which a squared distance is taken again, from differences.
CLOSE = 2.1e-5
# Sums that a task holds; with more clusters, tiles are smaller.
HELD_SUMS = 8_000_000

# Tasks carry the helpers below with them; executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def wcss(points: DataFrame, vector: str, label: str) -> DataFrame:
    """Within-cluster sum of squares and size by cluster, in one pass over the points."""
    cells = points.select(F.col(label).alias("cluster"), F.posexplode(vector).alias("axis", "x"))
    spread = cells.groupBy("cluster", "axis").agg(
        F.count("*").alias("n"), F.var_pop(F.col("x").cast("double")).alias("variance")
    )
    return spread.groupBy("cluster").agg(
        F.max("n").alias("n_points"), F.sum(F.col("n") * F.col("variance")).alias("wcss")
    )


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", vectors, vectors)


def _as_left(vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.hstack([-2 * vectors, lengths[:, None], np.ones((len(vectors), 1))])


def _as_right(vectors: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.vstack([vectors.T, np.ones(len(vectors)), lengths])


def _fill(gaps: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray, theirs: np.ndarray, close: np.ndarray) -> None:
    """Distances of all pairs by one product of matrices, as |x - y|² = -2xy + |x|² + |y|²; close
    pairs, whose squares lose digits by it, from their differences."""
    np.matmul(left, right, out=gaps)
    rows = np.flatnonzero(gaps.min(axis=1) < close)
    if len(rows):
        a, b = np.nonzero(gaps[rows] < close[rows, None])
        a = rows[a]
        gaps[a, b] = ((own[a] - theirs[b]) ** 2).sum(axis=1)
    np.sqrt(gaps, out=gaps)


def _distances(left: np.ndarray, right: np.ndarray, of_left: np.ndarray, of_right: np.ndarray) -> np.ndarray:
    """Distances of all pairs, whose squared lengths are given."""
    gaps = np.empty((len(left), len(right)))
    _fill(gaps, _as_left(left, of_left), _as_right(right, of_right), left, right, CLOSE * of_left)
    return gaps


class _Sums:
    """Distances of a tile's points to the points met so far, added up by assignment and cluster."""

    def __init__(self, keys: pa.Array, vectors: np.ndarray, codes: np.ndarray, labels: list[str]):
        self.keys, self.codes, self.labels = keys, codes, labels
        self.middle = vectors.mean(axis=0)  # distances don't change when all points move
        self.vectors = vectors - self.middle
        lengths = _lengths(self.vectors)
        self.left, self.close = _as_left(self.vectors, lengths), CLOSE * lengths
        self.totals: list[dict[str, np.ndarray]] = [{} for _ in labels]
        self.sizes: list[dict[str, int]] = [{} for _ in labels]

    def meet(self, vectors: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> None:
        """Add the distances to a block of points, which lie in runs of equal clusters."""
        theirs = vectors - self.middle
        right = _as_right(theirs, _lengths(theirs))
        starts = np.cumsum(sizes) - sizes
        gaps = np.empty((OWN_ROWS, len(theirs)))
        grouped = []
        for known, code in zip(self.sizes, codes.T):
            names, number = np.unique(code, return_inverse=True)
            order = np.argsort(number, kind="stable")
            grouped.append((names, order, np.searchsorted(number[order], np.arange(len(names)))))
            for name, n in zip(names, np.bincount(number, sizes).astype(int)):
                known[name] = known.get(name, 0) + int(n)
        for first in range(0, len(self.vectors), RUN_ROWS):
            end = min(first + RUN_ROWS, len(self.vectors))
            runs = np.empty((end - first, len(starts)))
            for at in range(first, end, OWN_ROWS):
                own = slice(at, min(at + OWN_ROWS, end))
                part = gaps[: own.stop - at]
                _fill(part, self.left[own], right, self.vectors[own], theirs, self.close[own])
                np.add.reduceat(part, starts, axis=1, out=runs[at - first: own.stop - first])
            for total, (names, order, begun) in zip(self.totals, grouped):
                sums = np.add.reduceat(runs[:, order], begun, axis=1)
                for i, name in enumerate(names):
                    if name not in total:
                        total[name] = np.zeros(len(self.vectors))
                    total[name][first: end] += sums[:, i]

    def rows(self) -> Iterator[pa.RecordBatch]:
        """key, assignment, cluster, inside, outside, size: once every point has been met."""
        coded = self.keys.dictionary_encode()
        number, distinct = coded.indices.to_numpy(), len(coded.dictionary)
        for at, label in enumerate(self.labels):
            code = self.codes[:, at]
            inside, outside = np.full(len(code), np.nan), np.full(len(code), np.inf)
            for name, total in self.totals[at].items():
                if distinct < len(number):  # rows that share a key count as one point
                    total = np.bincount(number, total, distinct)[number]
                mine, n = code == name, self.sizes[at][name]
                np.minimum(outside, total / n, out=outside, where=~mine)
                if n > 1:
                    inside[mine] = total[mine] / (n - 1)
            own = np.arange(len(code))
            if distinct < len(number):
                own = np.unique(np.stack([number, np.unique(code, return_inverse=True)[1]]), axis=1, return_index=True)[1]
            size = np.array([self.sizes[at][name] for name in code[own]], np.int64)
            yield pa.RecordBatch.from_arrays([
                self.keys.take(pa.array(own)), pa.repeat(pa.scalar(label), len(own)), pa.array(code[own].tolist(), pa.string()),
                pa.array(inside[own], mask=size == 1), pa.array(outside[own], mask=np.isinf(outside[own])), pa.array(size),
            ], ["key", "assignment", "cluster", "inside", "outside", "size"])


def _blocks(rows: DataFrame, parts: int, labels: list[str]) -> DataFrame:
    """The points in blocks, where those of equal clusters lie together: the vectors end to end, the
    length of each run and its clusters."""
    alike = F.xxhash64("codes")
    ordered = rows.repartitionByRange(parts, alike, F.xxhash64("key")).sortWithinPartitions(alike)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, codes = _vectors(batch), _clusters(batch, len(labels))
            most = max(1, min(MET_ROWS, BLOCK_VALUES // max(1, vectors.shape[1])))
            for at in range(0, batch.num_rows, most):
                code = codes[at: at + most]
                starts = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]).any(axis=1)]))
                sizes = np.diff(np.append(starts, len(code))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([vectors[at: at + most].ravel()]), pa.array([sizes]), pa.array([code[starts].ravel().tolist()], pa.list_(pa.string())),
                ], ["vector", "sizes", "codes"])

    return ordered.select("vector", "codes").mapInArrow(pack, "vector array<double>, sizes array<int>, codes array<string>")


def silhouette_points(points: DataFrame, key: str, vector: str, labels: list[str]) -> DataFrame:
    """Silhouette of each point under each of several assignments, long form.

    Points are hashed by key into tiles. All points, packed into blocks, are sent to every tile; a
    task holds one tile, reads the blocks one by one and adds up distances per cluster. No pair
    of points and no sum leaves the task. All assignments share the distances. Rows that share a
    key count as one point, at the sum of their distances; rows without a key count for the
    others only. The work is n² by definition; values moved are n times the tiles, which are 48
    up to 786,432 points and n/16384 beyond, more where a tile would hold over ``HELD_SUMS``
    sums of its points by cluster. No group grows with a cluster's size.
    """
    rows = points.select(
        F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"),
        F.array(*[F.col(label).cast("string") for label in labels]).alias("codes"),
    )
    n = points.count()
    clusters = rows.select(F.posexplode("codes")).distinct().count()
    tiles = max(math.ceil(n / (FULL * TILE_ROWS)), min(TASKS, math.ceil(n / TILE_ROWS)), math.ceil(n * clusters / HELD_SUMS))
    tiles = max(1, min(tiles, n))
    kind = rows.schema["key"].dataType
    own = rows.where("key IS NOT NULL").select(
        F.pmod(F.xxhash64("key", F.lit(1)), F.lit(tiles)).cast("int").alias("tile"), F.lit(False).alias("met"),
        "key", "vector", F.array().cast("array<int>").alias("sizes"), "codes",
    )
    blocks = _blocks(rows, max(1, math.ceil(n / (4 * MET_ROWS))), labels).select(
        F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), F.lit(True).alias("met"),
        F.lit(None).cast(kind).alias("key"), "vector", "sizes", "codes",
    )
    dealt = own.union(blocks).repartitionById(tiles, F.col("tile")).sortWithinPartitions("tile", "met")
    schema = T.StructType([
        T.StructField("key", kind), T.StructField("assignment", T.StringType()), T.StructField("cluster", T.StringType()),
        T.StructField("inside", T.DoubleType()), T.StructField("outside", T.DoubleType()), T.StructField("size", T.LongType()),
    ])

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, own, sums = None, [], None
        for batch in batches:
            kinds = np.stack([batch.column("tile").to_numpy(), batch.column("met").to_numpy(zero_copy_only=False)])
            bounds = [0, *(np.flatnonzero((kinds[:, 1:] != kinds[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for first, end in zip(bounds, bounds[1:]):
                if first == end:
                    continue
                if kinds[0, first] != task:  # a tile's points come first, then the blocks
                    if sums is not None:
                        yield from sums.rows()
                    task, own, sums = kinds[0, first], [], None
                part = batch.slice(first, end - first)
                if not kinds[1, first]:
                    own.append((part.column("key"), _vectors(part), _clusters(part, len(labels))))
                    continue
                if own and sums is None:
                    keys, vectors, codes = zip(*own)
                    sums = _Sums(pa.concat_arrays(keys), np.concatenate(vectors), np.concatenate(codes), labels)
                for at in range(part.num_rows if own else 0):
                    block = part.slice(at, 1)
                    sizes = block.column("sizes").flatten().to_numpy()
                    sums.meet(block.column("vector").flatten().to_numpy().reshape(int(sizes.sum()), -1), sizes, _clusters(block, len(labels)))
        if sums is not None:
            yield from sums.rows()

    scored = dealt.mapInArrow(meet, schema)
    return scored.select("key", "assignment", "cluster", _score(F.col("inside"), F.col("outside"), F.col("size")).alias("silhouette"))


def _score(inside: Column, outside: Column, size: Column) -> Column:
    """(b - a) / max(a, b); 0 in a cluster of one or where both are 0, NULL without another cluster."""
    gap = F.coalesce(F.try_divide(outside - inside, F.greatest(inside, outside)), F.lit(0.0))
    return F.when(outside.isNotNull(), F.when(size == 1, 0.0).otherwise(gap))


def centroid_silhouette(points: DataFrame, vector: str, centers: dict[str, dict]) -> DataFrame:
    """Mean silhouette by distances to centres: assignment, silhouette, n_points.

    ``centers`` has, for each assignment column, the centre of each of its clusters. One
    pass over the points, linear in them; a and b of a point are its distances to its own
    and to the nearest other centre.
    """
    def distance(center: list[float]) -> Column:
        apart = F.zip_with(F.col(vector), F.array(*map(F.lit, center)), lambda x, y: (x - y) * (x - y))
        return F.sqrt(F.aggregate(apart, F.lit(0.0), lambda total, x: total + x))

    scores = []
    for label, places in centers.items():
        own = F.lit(None).cast("double")
        for code, center in places.items():
            own = F.when(F.col(label) == F.lit(code), distance(center)).otherwise(own)
        others = F.array(*[F.when(F.col(label) != F.lit(code), distance(center)) for code, center in places.items()])
        scores.append(F.struct(F.lit(label).alias("assignment"), _score(own, F.array_min(others), F.lit(2)).alias("score")))
    rows = points.select(F.inline(F.array(*scores)))
    return rows.groupBy("assignment").agg(F.avg("score").alias("silhouette"), F.count("*").alias("n_points"))


def mean_silhouette(points: DataFrame, key: str, vector: str, labels: list[str]) -> DataFrame:
    """Mean silhouette of each assignment; NULL with fewer than two clusters."""
    scored = silhouette_points(points, key, vector, labels)
    return scored.groupBy("assignment").agg(
        F.avg("silhouette").alias("silhouette"), F.count("*").alias("n_points")
    )


# Values of cluster means that the tasks of the moments silhouette are sent at most.
MOMENT_VALUES = 4_000_000


def cluster_moments(points: DataFrame, vector: str, labels: list[str]) -> DataFrame:
    """Count, coordinate sums and sum of squared lengths of each cluster of several assignments.

    assignment, cluster, n, sums (array), squares; one pass, added up task by task. Rows
    without a vector or without the label are left out. All vectors have one width.
    """
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list] = {}
        for batch in batches:
            vectors, valid = _rows(batch)
            for at, label in enumerate(labels, 1):
                codes, number, mine = _codes(batch.column(at), valid)
                own = vectors[mine[valid]]
                sums = np.zeros((len(codes), vectors.shape[1]))
                np.add.at(sums, number, own)
                sizes = np.bincount(number, minlength=len(codes))
                squares = np.bincount(number, (own ** 2).sum(axis=1), len(codes))
                for i, code in enumerate(codes):
                    n, total, square = held.get((label, code), (0, 0.0, 0.0))
                    held[label, code] = [n + int(sizes[i]), total + sums[i], square + float(squares[i])]
        if held:
            keys, values = list(held), list(held.values())
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in keys]), pa.array([x[1] for x in keys]), pa.array([x[0] for x in values], pa.int64()),
                pa.array([x[1].tolist() for x in values], pa.list_(pa.float64())), pa.array([x[2] for x in values]),
            ], ["assignment", "cluster", "n", "sums", "squares"])

    parts = _labelled(points, vector, labels).mapInArrow(add, "assignment string, cluster string, n long, sums array<double>, squares double")
    keys = ["assignment", "cluster"]
    axes = parts.select(*keys, "n", "squares", F.posexplode("sums").alias("axis", "x")).groupBy(*keys, "axis").agg(
        F.sum("n").alias("n"), F.sum("squares").alias("squares"), F.sum("x").alias("x")
    )
    return axes.groupBy(*keys).agg(
        F.max("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("axis", "x"))), lambda c: c["x"]).alias("sums"),
        F.max_by("squares", "axis").alias("squares"),
    )


def moments_silhouette(points: DataFrame, vector: str, labels: list[str]) -> DataFrame:
    """Silhouette by squared Euclidean distances, exact and linear in the points.

    The squared distances of a point x to all n points of a cluster add up to
    n |x|² - 2 x Σy + Σ|y|², so the cluster's moments stand for its points. Result:
    assignment, cluster, n_points, silhouette (the mean over the cluster), NULL with fewer
    than two clusters. A cluster of one scores 0. The moments of all clusters go to every
    task; beyond ``MOMENT_VALUES`` values this stops rather than send more.
    """
    center = points.select(F.posexplode(F.col(vector).cast("array<double>")).alias("axis", "x")).groupBy("axis").agg(F.avg("x").alias("x"))
    middle = np.array([row["x"] for row in center.orderBy("axis").collect()])  # one row per coordinate
    # distances don't change when all points move; about their middle, squares lose no digits
    moved = points.withColumn("_moved", F.zip_with(F.col(vector).cast("array<double>"), F.lit(middle.tolist()), lambda x, m: x - m))
    found = cluster_moments(moved, "_moved", labels).limit(MOMENT_VALUES // max(1, len(middle)) + 1).collect()
    if len(found) * len(middle) > MOMENT_VALUES:
        raise ValueError("too many clusters to hold their moments in every task")
    held = {label: sorted((row["cluster"], row["n"], row["sums"], row["squares"]) for row in found if row["assignment"] == label) for label in labels}

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {label: (
            np.array([x[0] for x in rows], dtype=object), np.array([x[1] for x in rows], float),
            np.array([x[2] for x in rows]).reshape(len(rows), -1), np.array([x[3] for x in rows]),
        ) for label, rows in held.items()}
        total = {label: np.zeros((2, len(rows))) for label, rows in held.items()}
        for batch in batches:
            vectors, valid = _rows(batch)
            for at, label in enumerate(labels, 1):
                clusters, n, sums, squares = known[label]
                if not len(clusters):
                    continue
                codes, number, mine = _codes(batch.column(at), valid)
                place = np.searchsorted(clusters, codes)[number]
                own = vectors[mine[valid]]
                apart = np.maximum(n * (own ** 2).sum(axis=1)[:, None] - 2 * own @ sums.T + squares, 0)
                every = np.arange(len(own))
                inside = apart[every, place] / np.maximum(n[place] - 1, 1)
                means = apart / n
                means[every, place] = np.inf
                outside = means.min(axis=1)
                larger = np.maximum(inside, outside)
                value = np.divide(outside - inside, larger, out=np.zeros(len(own)), where=(larger > 0) & np.isfinite(outside))
                value[n[place] == 1] = 0
                total[label][0] += np.bincount(place, minlength=len(clusters))
                total[label][1] += np.bincount(place, value, len(clusters))
        for label, (count, added) in total.items():
            clusters = known[label][0]
            if count.any():
                yield pa.RecordBatch.from_arrays([
                    pa.array([label] * len(clusters)), pa.array(clusters.tolist()), pa.array(count.astype(np.int64)), pa.array(added),
                ], ["assignment", "cluster", "n", "total"])

    sums = _labelled(moved, "_moved", labels).mapInArrow(score, "assignment string, cluster string, n long, total double")
    several = [label for label, rows in held.items() if len(rows) > 1]
    mean = F.when(F.col("assignment").isin(several), F.sum("total") / F.sum("n"))
    return sums.groupBy("assignment", "cluster").agg(F.sum("n").alias("n_points"), mean.alias("silhouette"))


def mean_moments_silhouette(points: DataFrame, vector: str, labels: list[str]) -> DataFrame:
    """Mean squared-Euclidean silhouette of each assignment: assignment, silhouette, n_points."""
    by_cluster = moments_silhouette(points, vector, labels)
    return by_cluster.groupBy("assignment").agg(
        (F.sum(F.col("silhouette") * F.col("n_points")) / F.sum("n_points")).alias("silhouette"), F.sum("n_points").alias("n_points")
    )


def _labelled(points: DataFrame, vector: str, labels: list[str]) -> DataFrame:
    return points.select(F.col(vector).cast("array<double>").alias("vector"), *[F.col(label).cast("string").alias(f"label_{i}") for i, label in enumerate(labels)])


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, one a row, as doubles."""
    column = batch.column("vector")
    if column.null_count:
        raise ValueError("points without a vector have no silhouette")
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _clusters(batch: pa.RecordBatch, labels: int) -> np.ndarray:
    """The clusters of a batch, a column for each assignment."""
    codes = batch.column("codes").flatten()
    if codes.null_count:
        raise ValueError("points without a label have no silhouette")
    return codes.to_numpy(zero_copy_only=False).astype(object).reshape(-1, labels)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of a batch that are there, one a row, and which rows have one."""
    valid = np.asarray(batch.column(0).is_valid())
    values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(int(valid.sum()), -1), valid


def _codes(column: pa.Array, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct labels, the number of each row's, and the rows that have a label and a vector."""
    mine = np.asarray(column.is_valid()) & valid
    codes, number = np.unique(column.filter(pa.array(mine)).to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
    return codes, number, mine
