"""Centroid clustering: exact k-means over integer vectors, each vector's centroid found by Orchard's search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabgrid.llm.common import written

#: Largest component kept: squared distances of 64 components up to 256 times it stay below 2**63.
LARGEST = float(1 << 19)
#: Marks of visited centroids that a task holds at a time.
MARKS = 1 << 22


class Orchard:
    """Nearest centroids by squared distance (ties: the smaller number) over per-centroid sorted neighbour lists.

    A vector walks the list of its best centroid so far, nearest neighbour
    first. A closer centroid found there takes over with its own list, from
    its start. The walk ends at a neighbour strictly beyond twice the current
    distance: by the triangle inequality all that follow are farther from the
    vector than its best. Centroids already visited are passed over. All
    vectors of a batch take their steps together.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        between = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
        self.order = np.argsort(between, axis=1, kind="stable")
        # gap > 4 * distance as quarter >= distance, without an overflow; beyond the list's end always
        quarter = (np.take_along_axis(between, self.order, axis=1) - 1) // 4
        self.quarter = np.hstack([quarter, np.full((k, 1), np.iinfo(np.int64).max)])
        self.order = np.hstack([self.order, np.zeros((k, 1), np.int64)])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centroid number and squared distance of each row of ``x``."""
        best, place = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        distance = ((x - self.centroids[0]) ** 2).sum(axis=1)
        visited = np.zeros((len(x), len(self.centroids)), bool)
        visited[:, 0] = True
        rows = np.arange(len(x))
        while len(rows):
            rows = rows[self.quarter[best[rows], place[rows]] < distance[rows]]
            other = self.order[best[rows], place[rows]]
            place[rows] += 1
            new = ~visited[rows, other]
            at, other = rows[new], other[new]
            visited[at, other] = True
            step = x[at] - self.centroids[other]
            d = np.einsum("ij,ij->i", step, step)
            closer = (d < distance[at]) | ((d == distance[at]) & (other < best[at]))
            at = at[closer]
            best[at], distance[at], place[at] = other[closer], d[closer], 0
        return best, distance


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _assigned(batches: Iterator[pa.RecordBatch], search: Orchard) -> Iterator[tuple]:
    """Each slice of the batches with its vectors, their centroids and distances."""
    k, size = search.centroids.shape
    for batch in batches:
        for s in range(0, batch.num_rows, max(1, MARKS // k)):
            part = batch.slice(s, max(1, MARKS // k))
            x = _matrix(part.column("vector"), size)
            yield part, x, *search.nearest(x)


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: exact floors of the means of their vectors; empty ones stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        sums, n = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for _, x, best, _ in _assigned(batches, search):
            order = np.argsort(best, kind="stable")
            some, first = np.unique(best[order], return_index=True)
            sums[some] += np.add.reduceat(x[order], first, axis=0)
            n += np.bincount(best, minlength=len(n))
        some = np.flatnonzero(n)
        if len(some):
            flat = pa.array(sums[some].ravel())
            lists = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * sums.shape[1], flat)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), lists], ["cluster", "n", "sums"])

    parts = vectors.select("vector").mapInArrow(run, "cluster bigint, n bigint, sums array<bigint>")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    totals = parts.select("cluster", "n", F.posexplode("sums")).groupBy("cluster", "pos").agg(exact("n"), exact("col"))
    out = centroids.copy()
    for cluster, pos, n, total in totals.collect():  # one row per centroid and component
        out[cluster, pos] = int(total) // int(n)
    return out


def cluster_vectors(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    size: int = 64,
    scale: int = 256,
    seed: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per kept vector: ``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Kept are vectors of exactly ``size`` components, none null or not finite;
    components become floor(``scale`` * x). The first centroids are the ``k``
    kept vectors with the smallest SHA-256 of ``<seed>:<vec_id>`` (a null id:
    nothing after the colon; equal ids by their vectors). ``rounds`` times all
    vectors go to their nearest centroid (ties: the smaller number) and each
    centroid moves to the floor of their mean; then they are assigned once
    more. ``distance`` is squared; the inertias sum it over the cluster and
    over all vectors (null beyond a long).

    Fewer than ``k`` kept vectors make as many centroids, none an empty
    result. Repeated rows and ids are vectors of their own. So that distances
    fit a long, vectors with a component beyond ``LARGEST`` either way are
    left out like those that are not finite. The integer vectors are written
    once. The driver and each task hold the ``k`` centroids, their lists and
    sums only; a round shuffles one row per task, centroid and component.
    """
    if not 1 <= size <= 64 or not 0 < scale <= 256:
        raise ValueError("distances fit a long for up to 64 components and a scale up to 256")
    values = F.col(vector_col).cast("array<double>")
    good = (F.size(values) == size) & F.forall(values, lambda x: F.coalesce(F.abs(x) <= LARGEST, F.lit(False)))
    floors = F.transform(values, lambda x: F.floor(x * float(scale)).cast("int"))
    kept = written(vectors.where(good).select(F.col(id_col).alias("id"), floors.alias("vector")), "clustered")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = kept.orderBy(name, "vector").select("vector").limit(k).collect()
    schema = f"id {kept.schema['id'].dataType.simpleString()}, cluster int, distance bigint"
    if not first:
        centroids = np.zeros((0, size), np.int64)
        assigned = vectors.sparkSession.createDataFrame([], schema)
    else:
        centroids = np.array([r[0] for r in first], np.int64)
        for _ in range(rounds):
            centroids = _moved(kept, centroids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, _, best, distance in _assigned(batches, Orchard(centroids)):
                columns = [part.column("id"), pa.array(best.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

        assigned = written(kept.mapInArrow(run, schema), "assigned")
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    named = vectors.sparkSession.createDataFrame(list(enumerate(digests)), "cluster int, centroid_sha256 string")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = assigned.groupBy("cluster").agg(total.alias("s"))
    everywhere = Window.partitionBy(F.lit(0))  # a row per centroid
    per_cluster = (
        named.join(sums, "cluster")
        .withColumn("inertia", F.sum("s").over(everywhere).try_cast("long"))
        .withColumn("cluster_inertia", F.col("s").try_cast("long"))
    )
    return (
        assigned.join(F.broadcast(per_cluster), "cluster")
        .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    )
