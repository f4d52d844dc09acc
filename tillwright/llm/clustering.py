"""Centroid clustering of integer vectors, with bounds that moved centroids loosen as little as geometry allows (operator 12).

Each vector keeps its cluster and a lower bound on its distance to every other centroid. When the
centroids move, the bound is loosened, and a vector whose own centroid is still nearer than the bound
keeps its cluster without a look at the others. Full drift would loosen it by the longest way that any
centroid went. Here a cluster is a sphere (its centroid, and the distance of its farthest vector), and
what matters is how much nearer a centroid that moved from p to q can have come to a point x of the
sphere:

    |x - p| - |x - q| = (|x - p|^2 - |x - q|^2) / (|x - p| + |x - q|) <= |q - p| * cos(angle),

with the angle at the middle m of p and q between the direction of the move and x, since the numerator is
2 * |q - p| times the part of x - m along the move, and the denominator is 2 * |x - m| at least. In the
plane through p, q and the sphere's centre c, the sphere fills the angles within asin(radius / |c - m|)
of c's own, so the smallest angle is known; beyond a right angle the centroid came nearer to no point of the sphere.

Vectors whose bounds do not decide are compared with all centroids in exact integers. So the result
is that of comparing all with all. State lives in tables in the shared folder, one a round, and each
is deleted when the next is there; only k centroids and their sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import discard, stored

CLUSTERS, ROUNDS, DIMENSIONS = 40, 5, 64
SCALE = 256
SEED = "2"
# Components beyond are taken as this; no distance between such vectors fits a long.
LARGEST = 1 << 62
_LONG = (1 << 63) - 1
# Below this, squared distances are exact in doubles.
_EXACT = 1 << 21
_SLACK = 1e-9


# --- vectors as integers -----------------------------------------------------


def _packed(ints: np.ndarray) -> pa.Array:
    most = int(np.abs(ints).max(initial=0))
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    flat, width = np.ascontiguousarray(ints.astype(kind)).tobytes(), ints.shape[1] * int(kind[2])
    return pa.array([flat[i : i + width] for i in range(0, len(flat), width)], pa.binary())


def _unpacked(column: pa.Array, dimensions: int) -> np.ndarray:
    widths = pc.binary_length(column).to_numpy() // dimensions
    out = np.empty((len(column), dimensions), np.int64)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        flat = b"".join(column.take(pa.array(rows)).to_pylist())
        out[rows] = np.frombuffer(flat, f"<i{width}").reshape(-1, dimensions)
    return out


def integer_vectors(
    rows: DataFrame, vector: str = "embedding", key: str = "vec_id", dimensions: int = DIMENSIONS, scale: int = SCALE
) -> DataFrame:
    """key, vector (packed integers floor(scale * x)) of the rows with ``dimensions`` finite components.

    Vectors that are null, of another length, or with a null, NaN or infinite component are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dimensions), False)
            batch = batch.filter(right)
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
            finite = np.isfinite(values).all(1)
            with np.errstate(over="ignore"):
                ints = np.clip(np.floor(values[finite] * scale), -LARGEST, LARGEST).astype(np.int64)
            ids = batch.column(0).filter(pa.array(finite))
            yield pa.RecordBatch.from_arrays([ids, _packed(ints)], ["key", "vector"])

    source = rows.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    return source.mapInArrow(run, "key long, vector binary")


# --- distances and bounds ----------------------------------------------------


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all to all: as doubles that hold integers, or as Python integers."""
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) < _EXACT:
        x, c = points.astype(np.float64), centroids.astype(np.float64)
        return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
    x, c = points.astype(object), centroids.astype(object)
    return np.stack([((x - one) ** 2).sum(1) for one in c], axis=1)


def _own_distances(points: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) < _EXACT:
        return ((points - centroids[cluster]) ** 2).sum(1)
    return ((points.astype(object) - centroids.astype(object)[cluster]) ** 2).sum(1)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, by how much any other centroid can have come nearer to a point of its sphere.

    ``old`` and ``new`` are centroids, ``radius`` how far the farthest vector of each cluster is from ``old``.
    """
    p, q = old.astype(np.float64), new.astype(np.float64)
    move, middle = q - p, (p + q) / 2
    length = np.sqrt((move**2).sum(1))
    out = np.zeros(len(p))
    margin = _SLACK * (1 + np.abs(p).max(initial=0) + np.abs(q).max(initial=0))
    for i, (centre, r) in enumerate(zip(p, radius, strict=True)):
        to = centre - middle
        away = np.sqrt((to**2).sum(1))
        inside = r * (1 + _SLACK) + margin >= away
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.arccos(np.clip((to * move).sum(1) / (away * length), -1, 1))
            spread = np.arcsin(np.clip((r + margin) / away, 0, 1))
            nearer = length * np.cos(np.clip(own - spread - _SLACK, 0, np.pi / 2))
        nearer = np.where(inside, length, nearer) * (1 + _SLACK) + margin
        nearer[length == 0] = 0
        nearer[i] = 0
        out[i] = nearer.max()
    return out


def _assigned(points: np.ndarray, cluster: np.ndarray | None, lower: np.ndarray | None, centroids: np.ndarray, loosen: np.ndarray | None):
    """cluster, squared distance, lower bound and whether all centroids were compared, for each point."""
    n = len(points)
    if cluster is None:
        cluster, distance, bound, open_ = np.zeros(n, np.int32), np.zeros(n, object), np.zeros(n), np.ones(n, bool)
    else:
        cluster = cluster.copy()
        distance = _own_distances(points, centroids, cluster)
        bound = lower - loosen[cluster]
        open_ = ~(np.sqrt(distance.astype(np.float64)) * (1 + _SLACK) < bound * (1 - _SLACK) - _SLACK)
        distance = distance.astype(object)
    at = np.flatnonzero(open_)
    for part in np.array_split(at, -(-len(at) * len(centroids) // 4_000_000) or 1):
        if not len(part):
            continue
        every = _distances(points[part], centroids)
        best = every.argmin(1)  # the smaller number of equals
        rows = np.arange(len(part))
        cluster[part] = best
        distance[part] = [int(d) for d in every[rows, best]]
        if every.dtype == object:
            bound[part] = 0.0  # not kept for vectors beyond doubles: compared each time
        elif len(centroids) > 1:
            every[rows, best] = np.inf
            bound[part] = np.sqrt(every.min(1)) * (1 - _SLACK)
        else:
            bound[part] = np.inf
    return cluster, distance, bound, open_


# --- rounds ------------------------------------------------------------------

_STATE = "key long, vector binary, cluster int, distance long, lower double, compared boolean"


def _assign(rows: DataFrame, centroids: np.ndarray, loosen: np.ndarray | None) -> DataFrame:
    dimensions = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _unpacked(batch.column(1), dimensions)
            known = (None, None) if loosen is None else (batch.column(2).to_numpy(), batch.column(4).to_numpy())
            cluster, distance, bound, compared = _assigned(points, *known, centroids, loosen)
            short = [min(int(d), _LONG) for d in distance]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), pa.array(short, pa.int64()), pa.array(bound, pa.float64()), pa.array(compared)],
                ["key", "vector", "cluster", "distance", "lower", "compared"],
            )

    return rows.mapInArrow(run, _STATE)


@dataclass(frozen=True)
class Sums:
    """Of each cluster: how many vectors, their sums, the largest squared distance, and the distances' sum."""

    counts: list[int]
    totals: list[list[int]]
    farthest: list[int]
    inertia: list[int]
    compared: int


def _sums(state: DataFrame, k: int, dimensions: int) -> Sums:
    """Summed up in each task first, so k * (dimensions + 2) rows a task are shuffled, and as many collected."""
    names = ["cluster", "place", "total", "most"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((k, dimensions + 3), object)
        most = [0] * k
        for batch in batches:
            points, cluster = _unpacked(batch.column(1), dimensions), batch.column(0).to_numpy()
            distance, compared = batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            # Small numbers add up in longs; a batch has far fewer than 2**20 rows of them.
            small = np.abs(points).max(initial=0) < 1 << 40
            for c in np.unique(cluster):
                own = cluster == c
                added = points[own].sum(0) if small else points[own].astype(object).sum(0)
                totals[c, :dimensions] += [int(v) for v in added]
                totals[c, dimensions] += int(own.sum())
                totals[c, dimensions + 1] += sum(map(int, distance[own]))
                totals[c, dimensions + 2] += int(compared[own].sum())
                most[c] = max(most[c], int(distance[own].max()))
        at = [(c, i) for c in range(k) if totals[c, dimensions] for i in range(dimensions + 3)]
        columns = (
            pa.array([c for c, _ in at], pa.int32()),
            pa.array([i for _, i in at], pa.int32()),
            pa.array([Decimal(int(totals[c, i])) for c, i in at], pa.decimal128(38, 0)),
            pa.array([most[c] for c, _ in at], pa.int64()),
        )
        yield pa.RecordBatch.from_arrays(list(columns), names)

    read = state.select("cluster", "vector", "distance", "compared")
    parts = read.mapInArrow(run, "cluster int, place int, total decimal(38,0), most long")
    rows = parts.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.max("most").alias("most")).collect()
    table, most = [[0] * (dimensions + 3) for _ in range(k)], [0] * k
    for r in rows:
        table[r["cluster"]][r["place"]] = int(r["total"])
        most[r["cluster"]] = max(most[r["cluster"]], r["most"])
    return Sums(
        [t[dimensions] for t in table], [t[:dimensions] for t in table], most, [t[dimensions + 1] for t in table], sum(t[dimensions + 2] for t in table)
    )


def first_centroids(vectors: DataFrame, k: int, seed: str = SEED, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:key``, in that order; those without a key come last, ties by vector."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")).cast("binary"), 256)
    rows = vectors.select("vector", mark.alias("mark")).orderBy(F.asc_nulls_last("mark"), "vector").limit(k).collect()
    return _unpacked(pa.array([bytes(r["vector"]) for r in rows], pa.binary()), dimensions)


@dataclass(frozen=True)
class Clusters:
    """Rows (key, vector, cluster, distance), centroids, sums, and how many vectors each round compared with all centroids."""

    rows: DataFrame
    centroids: np.ndarray
    sums: Sums
    compared: list[int]


def cluster(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    seed: str = SEED,
    loosen_by: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] = loosening,
) -> Clusters:
    """Cluster the output of ``integer_vectors``: ``rounds`` times assign and move, then assign once more.

    Ties of distance go to the smaller number; a centroid without vectors stays; a moved one is the exact floor of its
    vectors' mean. Fewer than k vectors make fewer clusters. Repeated rows count each time. Distances that pass a long
    are compared exactly, but stored as the largest long.
    """
    packed = stored(vectors, "vectors")
    centroids = first_centroids(packed, k, seed, dimensions)
    if not len(centroids):
        empty = packed.sparkSession.createDataFrame([], _STATE)
        return Clusters(empty, centroids, Sums([], [], [], [], 0), [])
    state, loosen, compared = packed, None, []
    for turn in range(rounds + 1):
        state, old = stored(_assign(state, centroids, loosen), "assigned"), state
        discard(old)
        sums = _sums(state, len(centroids), dimensions)
        compared.append(sums.compared)
        if turn == rounds:
            break
        moved = np.array(
            [[t // n for t in total] if n else list(c) for c, n, total in zip(centroids.tolist(), sums.counts, sums.totals, strict=True)], np.int64
        )
        radius = np.sqrt(np.array(sums.farthest, np.float64)) * (1 + _SLACK)
        loosen, centroids = loosen_by(centroids, moved, radius), moved
    return Clusters(state, centroids, sums, compared)


def digest(found: Clusters) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector; rows without an id too."""
    spark = found.rows.sparkSession
    total = min(sum(found.sums.inertia), _LONG)
    of_cluster = [
        (c, min(inertia, _LONG), sha256(",".join(map(str, centroid)).encode()).hexdigest())
        for c, (inertia, centroid) in enumerate(zip(found.sums.inertia, found.centroids.tolist(), strict=True))
    ]
    # One row a cluster.
    known = spark.createDataFrame(of_cluster, "cluster int, cluster_inertia long, centroid_sha256 string")
    rows = found.rows.select(F.col("key").alias("vec_id"), "cluster", "distance").join(F.broadcast(known), "cluster")
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")
