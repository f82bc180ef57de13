"""Clustering around centroids in whole numbers, by progressive search in the Walsh-Hadamard domain.

Components become whole numbers, and vectors and centroids are transformed by the 64-point Walsh-Hadamard
matrix, which holds only 1 and -1: no rounding, and squared distances are exactly 64 times those
of the vectors. Coefficients are taken from coarse (few changes of sign) to fine. The distance to the centroid
that leads after the coarse part is finished first; squared differences then only add up, so a
centroid whose part of a distance is strictly larger is out, and the rest finish all 64.

Vectors are packed into blocks once and never shuffled: a round sends the centroids to the tasks, which
give back one sum per centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.llm import vectors
from railpulse.session import Scratch

DIMS = 64
SCALE = 256
CENTROIDS, ROUNDS, SEED = 40, 5, 2
BLOCK = 4_096
# Coefficients that are added before each look at who is out.
STEPS = (4, 4, 8, 16, 32)
# Whole components up to this size keep all sums of a transformed distance within 64 bits.
SAFE = 1 << 24


def walsh() -> np.ndarray:
    """The 64 Walsh functions in order of their changes of sign."""
    matrix = np.ones((1, 1), np.int64)
    while len(matrix) < DIMS:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix[np.argsort((np.diff(matrix, axis=1) != 0).sum(1))]


def whole(data: np.ndarray) -> np.ndarray:
    """``floor(256 * x)``; as Python's numbers where 64 bits might not hold all that follows from them."""
    with np.errstate(over="ignore"):
        scaled = np.floor(data * SCALE)
    if not np.isfinite(scaled).all():
        return np.array([[int(x) * SCALE if abs(x) > SAFE else int(y) for x, y in zip(*rows)] for rows in zip(data.tolist(), scaled.tolist())], object)
    if len(scaled) and np.abs(scaled).max() > SAFE:
        return np.array([[int(x) for x in row] for row in scaled.tolist()], object)
    return scaled.astype(np.int64)


def search(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each point's nearest centroid (of equal ones the first), its squared distance, and how many differences were taken."""
    matrix = walsh()
    if points.dtype == object or centroids.dtype == object or np.abs(centroids).max() > SAFE:
        points, centroids, matrix = points.astype(object), centroids.astype(object), matrix.astype(object)
    p, c = points @ matrix.T, centroids @ matrix.T
    n, everyone = len(p), np.arange(len(p))
    part, taken = np.zeros((n, len(c)), p.dtype), 0
    alive = np.ones((n, len(c)), bool)
    lead, at = None, 0
    for step in STEPS:
        row, col = np.nonzero(alive)
        part[row, col] += ((p[row, at:at + step] - c[col, at:at + step]) ** 2).sum(1)
        taken += len(row) * step
        at += step
        if lead is None:
            leader = part.argmin(1) if part.dtype != object else np.array([min(range(len(c)), key=own.__getitem__) for own in part.tolist()])
            lead = part[everyone, leader] + ((p[:, at:] - c[leader, at:]) ** 2).sum(1)
            taken += n * (DIMS - at)
        alive &= part <= lead[:, None]
    best = np.where(alive, part, lead[:, None] + 1)
    nearest = best.argmin(1) if best.dtype != object else np.array([min(range(len(c)), key=own.__getitem__) for own in best.tolist()], int)
    return nearest, best[everyone, nearest] // DIMS, taken


def kept(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, vector`` of vectors of 64 components, none null or non-finite."""
    vector = F.col(vector_col).cast("array<double>")
    return rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).where((F.size("vector") == DIMS) & vectors.usable(F.col("vector")))


def seeds(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id, ``k`` at most; those without id come last, equal ids by their components."""
    first = points.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last(), "vector").limit(k)
    found = [row.vector for row in first.select("vector").collect()]
    return whole(np.array(found, np.float64).reshape(-1, DIMS))


def _points(block) -> np.ndarray:
    return whole(np.frombuffer(block.data, np.float64).reshape(block.n, DIMS))


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of their vectors, each where it was if it has none."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((len(centroids), DIMS), object)
        count = np.zeros(len(centroids), np.int64)
        for batch in batches:
            for block in vectors.rows_of(batch):
                points = _points(block)
                near = search(points, centroids)[0]
                for own in np.unique(near):
                    totals[own] += points[near == own].sum(0).astype(object)
                    count[own] += (near == own).sum()
        for own in np.flatnonzero(count):
            yield pd.DataFrame({"cluster": own, "dim": np.arange(DIMS), "n": count[own], "total": [str(x) for x in totals[own]]})

    sums = blocks.mapInPandas(add, "cluster int, dim int, n long, total string")
    sums = sums.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    new = centroids.astype(object)
    for row in sums.collect():
        new[row.cluster, row.dim] = int(row.total) // row.n
    return new if np.abs(new).max() > SAFE else new.astype(np.int64)


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def clusters(rows: DataFrame, scratch: Scratch, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of the vectors kept of ``rows(vec_id, embedding)``.

    Vectors that are null, of another length, or with null or non-finite components take no part. Rows that
    repeat are vectors of their own; a null id is kept, but begins a cluster only if there are too few others.
    With fewer than ``k`` vectors each begins a cluster; without any the result is empty. Of equally near
    centroids the first counts. A distance that 64 bits cannot hold is an error. Other columns are ignored.

    Only centroids and their sums, ``k`` times 64 numbers, pass through the driver.
    """
    points = kept(rows)
    centroids = seeds(points, k, seed)
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        empty = rows.sparkSession.createDataFrame([], schema + ", cluster_inertia long, inertia long, centroid_sha256 string")
        return empty
    # A null id cannot be packed, so it travels beside.
    numbered = points.select(F.coalesce("id", F.lit(0)).alias("id"), "vector", F.col("id").isNull().cast("long").alias("missing"))
    blocks = scratch.save(vectors.pack(numbered, BLOCK, "float64", ("missing",)), "points")
    for _ in range(rounds):
        centroids = moved(blocks, centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in vectors.rows_of(batch):
                near, distance, _ = search(_points(block), centroids)
                if max(distance) >= 1 << 63:
                    raise OverflowError("a squared distance does not fit into 64 bits")
                ids = pd.array(np.frombuffer(block.ids, np.int64), "Int64")
                ids[np.frombuffer(block.missing, np.int64) == 1] = pd.NA
                yield pd.DataFrame({"vec_id": ids, "cluster": near.astype(np.int32), "distance": distance.astype(np.int64)})

    assigned = scratch.save(blocks.mapInPandas(assign, schema), "assigned")
    inertia = {row.cluster: int(row.total) for row in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    told = [(own, total, sum(inertia.values()), digest(centroids[own])) for own, total in sorted(inertia.items())]
    # One row per centroid, so at most k.
    about = rows.sparkSession.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
