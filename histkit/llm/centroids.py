"""Centroid clustering of integer vectors: Lloyd rounds whose nearest centroid is the winner of a bisector tournament.

For two centroids a < b the vectors nearer to b lie on one side of a plane: with the normal
2 (b - a) and the threshold |b|^2 - |a|^2, both integers, the sign of normal . v - threshold
says which of the two loses. k - 1 such tests leave one centroid; zero means a tie, which the
smaller number wins. Vectors stay in their tasks, which hand on sums per centroid and component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histkit.llm.common import bounded_batches, fresh, store

#: Components up to this size keep every sum of the tests and of a distance over 64 of them
#: inside 64 bits; vectors beyond it, and more components, are calculated with Python's integers.
SAFE = 1 << 27
SAFE_DIMS = 64
LARGEST = (1 << 63) - 1


def finite(vector: Column, dims: int) -> Column:
    """Vectors of ``dims`` components, none of them null or non-finite."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dims) & ok, F.lit(False))


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): 64-bit integers where they are safe, else Python's integers."""
    if not values.size or np.abs(values).max() * scale < SAFE:
        return np.floor(values * scale).astype(np.int64)
    exact = [math.floor(scale * x) if abs(x) < 2**52 else scale * int(x) for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


class Bisectors:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: list[list[int]]):
        safe = all(abs(x) <= SAFE for c in centroids for x in c) and all(len(c) <= SAFE_DIMS for c in centroids)
        self.centres = np.array(centroids, dtype=np.int64 if safe else object).reshape(len(centroids), -1)
        squares = (self.centres * self.centres).sum(axis=1)
        self.normals = 2 * (self.centres[None, :, :] - self.centres[:, None, :])  # [a, b] points from a to b
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The winner of each vector's tournament and its exact squared distance."""
        winner = np.zeros(len(vectors), np.int64)
        for rival in range(1, len(self.centres)):
            side = (self.normals[winner, rival] * vectors).sum(axis=1) - self.thresholds[winner, rival]
            winner[(side > 0).astype(bool)] = rival  # the rival has the larger number and must be strictly nearer
        gap = vectors - self.centres[winner]
        return winner, (gap * gap).sum(axis=1)


def _vectors(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    return whole_numbers(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims), scale)


def first_centroids(kept: DataFrame, clusters: int, scale: int, seed: str) -> list[list[int]]:
    """The vectors with the smallest hashes of seed and id; at most ``clusters`` rows reach the driver."""
    rows = (
        kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("hash"), "vector")
        .orderBy(F.col("hash").asc_nulls_last(), "vector")
        .limit(clusters)
        .collect()
    )
    return [whole_numbers(np.array(r.vector, np.float64), scale).tolist() for r in rows]


def moved(kept: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> list[list[int]]:
    """Centroids after one round: exact floors of the means; one without vectors stays."""
    spark = kept.sparkSession
    shared = spark.sparkContext.broadcast(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Bisectors(shared.value)
        k = len(planes.centres)
        totals, counts = np.zeros((k, dims), object), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch.column(0), dims, scale)
            winner, _ = planes.nearest(vectors)
            for c in np.unique(winner):
                totals[c] += vectors[winner == c].sum(axis=0).astype(object)
            counts += np.bincount(winner, minlength=k)
        used = np.nonzero(counts)[0]
        at, dim = np.repeat(used, dims), np.tile(np.arange(dims), len(used))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(dim, pa.int32()), pa.array([Decimal(int(x)) for x in totals[used].ravel()], pa.decimal128(38, 0)), pa.array(counts[at], pa.int64())],
            names=["cluster", "dim", "total", "n"],
        )

    parts = kept.select("vector").mapInArrow(sums, "cluster int, dim int, total decimal(38,0), n long")
    out = [list(c) for c in centroids]
    for r in parts.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # clusters x dims rows
        out[r.cluster][r.dim] = int(r.total) // r.n
    shared.destroy()
    return out


def cluster(vectors: DataFrame, clusters: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1") -> DataFrame:
    """One row per vector of ``dims`` finite components: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    ``vectors`` has vec_id and embedding; other columns are ignored. Null vectors, vectors of
    another length and those with null or non-finite components give no row. Repeated rows
    count and are returned as often as they are there; of equal ids, the smaller vector is taken
    as a centroid first, and a null id comes last. With fewer vectors than ``clusters`` each is
    a centroid; an empty table gives no rows. A distance or inertia beyond 64 bits is given as
    the largest long. Only centroids (clusters x dims integers) reach the driver.
    """
    bounded_batches(vectors)
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).where(finite(F.col("vector"), dims))
    centroids = first_centroids(kept, clusters, scale, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(kept, centroids, dims, scale)
    shared = kept.sparkSession.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Bisectors(shared.value) if shared.value else None  # without centroids there are no rows
        for batch in batches:
            if batch.num_rows:
                winner, distance = planes.nearest(_vectors(batch.column(1), dims, scale))
                exact = distance if distance.dtype == np.int64 else [min(int(d), LARGEST) for d in distance]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(winner, pa.int32()), pa.array(exact, pa.int64())], names=["vec_id", "cluster", "distance"])

    found = store(kept.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters")
    sums = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digests = [(c, min(sums.get(c, 0), LARGEST), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids)]
    (number,) = fresh(found, "number")
    names = kept.sparkSession.createDataFrame(digests, f"{number} int, cluster_inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(names), F.col("cluster") == F.col(number))  # one row per cluster
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(min(sum(sums.values()), LARGEST)).cast("long").alias("inertia"), "centroid_sha256")
