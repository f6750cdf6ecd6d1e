"""Centroid clustering with Orchard's search for the nearest centroid.

Vectors become integers, so that distances, sums and means are exact and the
result is the same whatever the partitions. Each round sends the centroids
(k times the dimension, a bound that doesn't grow with the table) to all tasks;
a task assigns its vectors, a block at a time, and sums them by centroid.

A vector starts at some centroid and walks down that centroid's list of the
others, nearest first. When it meets a closer one it goes on with the list of
that one; centroids met before are passed over by a mark. Nothing further down
a list can be closer, or as close, once the distance between the centroids is
strictly more than twice the vector's own: there it stops. All vectors of a
block take their steps together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written

#: Components of at most so much keep squared distances exact in 64 bits.
MOST = 1 << 26


class Orchard:
    """The centroids, their distances from each other, and for each one the
    list of all, nearest first (itself at the head; ties: smaller number)."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids.astype(np.int64)
        diff = self.c[:, None, :] - self.c[None, :, :]
        self.apart = (diff * diff).sum(2)
        self.lists = np.argsort(self.apart, axis=1, kind="stable")

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each row of ``x`` the nearest centroid (ties: smaller number)
        and the squared distance; and how many distances were computed."""
        n, k = len(x), len(self.c)
        now = np.zeros(n, np.int64)
        d = ((x - self.c[0]) ** 2).sum(1)
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        place = np.zeros(n, np.int64)
        going, computed = np.arange(n), n
        while len(going):
            at = now[going]
            other = self.lists[at, place[going]]
            # squared: the centroids are more than twice the distance apart
            on = self.apart[at, other] <= 4 * d[going]
            going, other = going[on], other[on]
            place[going] += 1
            new = ~seen[going, other]
            rows, other = going[new], other[new]
            seen[rows, other] = True
            far = ((x[rows] - self.c[other]) ** 2).sum(1)
            computed += len(rows)
            closer = (far < d[rows]) | ((far == d[rows]) & (other < now[rows]))
            rows, other = rows[closer], other[closer]
            now[rows], d[rows], place[rows] = other, far[closer], 0
            going = going[place[going] < k]
        return now, d, computed


def integer_vectors(table: DataFrame, *, dim: int, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): vectors of exactly ``dim`` finite components, each as
    floor(scale * component)."""
    e = F.col(embedding).cast("array<double>")
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform("e", lambda x: F.floor(F.lit(float(scale)) * x))
    good = table.select(F.col(vec_id).cast("long").alias("vec_id"), e.alias("e")).where(
        (F.size("e") == dim) & finite)
    fits = F.forall("e", lambda x: F.abs(F.lit(float(scale)) * x) < F.lit(float(MOST)))
    return good.select("vec_id", F.when(fits, scaled).otherwise(
        F.raise_error(F.lit(f"a component is beyond {MOST // scale}: squared distances would not fit 64 bits"))
        .cast("array<bigint>")).alias("v"))


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            rows = batch.slice(at, 4096)
            yield rows, rows.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(vectors: DataFrame, centroids: np.ndarray, dim: int) -> list:
    """(cluster, n, sums) of all vectors, a row for each non-empty cluster."""
    orchard, k = Orchard(centroids), len(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _blocks(batches, dim):
            own, _, _ = orchard.nearest(x)
            some, many = np.unique(own, return_counts=True)
            total = [x[own == c].sum(0) for c in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(many, pa.int64()), pa.array(total, pa.list_(pa.int64()))],
                ["cluster", "n", "s"])

    parts = vectors.mapInArrow(assign, "cluster int, n long, s array<long>")
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[
        F.sum(F.col("s")[i].cast("decimal(38,0)")) for i in range(dim)]).alias("s")).collect()


def cluster(table: DataFrame, *, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1,
            vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector of ``dim`` finite components: vec_id, cluster (from
    0), distance (squared, of integers), cluster_inertia, inertia and
    centroid_sha256 of its final centroid.

    The first centroids are the ``k`` vectors with the smallest SHA-256 of
    "seed:vec_id" (all, if there are fewer). Rows whose vector is NULL, has
    another length or holds NULL or non-finite components are left out. A NULL
    vec_id is hashed as the empty string. Repeated rows count as often as they
    occur, also as first centroids (equal ids go by their components), where
    ties leave the later ones empty. An empty table gives an empty one. Other
    columns are not read. A component that is too large for exact distances
    raises an error."""
    spark = ship(table.sparkSession)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    vectors = written(integer_vectors(table, dim=dim, scale=scale, vec_id=vec_id, embedding=embedding), "cluster-vectors")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.orderBy(key, "v").limit(k).collect()  # k rows
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([r["v"] for r in first], np.int64)
    for _ in range(rounds):
        for c, n, s in _sums(vectors, centroids, dim):
            centroids[c] = [int(x) // n for x in s]  # rounds down, also below zero
    orchard = Orchard(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, x in _blocks(batches, dim):
            own, far, _ = orchard.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(own, pa.int32()), pa.array(far)], ["vec_id", "cluster", "distance"])

    placed = written(vectors.mapInArrow(assign, "vec_id long, cluster int, distance long"), "cluster-rows")
    inertia = dict(placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    whole = int(sum(inertia.values()))
    clusters = spark.createDataFrame([(c, int(inertia.get(c, 0)), whole, name) for c, name in enumerate(names)],
                                     "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(clusters), "cluster").select(*[x.split()[0] for x in schema.split(", ")])
