"""Centroid clustering (k-means in whole numbers) with block-norm screening.

Components become whole numbers, floor(scale * x). The norms of each vector's segments are computed once and lie beside it in
columnar blocks (see vectors); a centroid has the like. By Cauchy-Schwarz the sum over the segments of (norm of the vector's less
norm of the centroid's) squared is a lower bound of their squared distance. A vector tries its centroids by ascending bound and
stops at the first whose bound is above the best exact distance so far; only those tried get exact integer distances. Bounds are
lowered by more than rounding can raise them, so that none is lost, ties included.

Centroids start as the vectors with the smallest SHA-256 of '1:<id>'. Each round is one pass over the blocks: a task gives the sums
and counts of each centroid, Spark adds these, and the driver gets k times the number of components. An empty centroid stays where
it is.

Defined cases: vectors that are null, of another length, or hold null or non-finite components are dropped; rows without an id
come last as starting centroids; of equal ids the smaller vector comes first; repeated rows count each for itself; with fewer than
k vectors there are that many centroids; an empty table gives no rows. A component so large that squared distances don't fit into
64 bits is an error. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import cut
from siftworks.llm.vectors import blocks, finite, ints_of, joined, whole

SEGMENT = 4


def segment_norms(ints: np.ndarray) -> np.ndarray:
    """ints: dims x n. The norms of each SEGMENT components: segments x n (the last segment may be shorter)."""
    squares = ints.astype(np.float64) ** 2
    return np.sqrt(np.add.reduceat(squares, np.arange(0, len(ints), SEGMENT), axis=0))


def lower_bounds(norms: np.ndarray, of_centroids: np.ndarray) -> np.ndarray:
    """segments x n and segments x k. A number for each vector and centroid that isn't above their squared distance: n x k."""
    bounds = np.zeros((norms.shape[1], of_centroids.shape[1]))
    for a, b in zip(norms, of_centroids, strict=True):
        bounds += (a[:, None] - b[None, :]) ** 2
    rounding = 1e-12 * ((norms**2).sum(axis=0)[:, None] + (of_centroids**2).sum(axis=0)[None, :])
    return bounds - rounding


def assign(ints: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """ints: dims x n; centroids: k x dims. Each vector's nearest centroid (of equal ones the first), its squared distance, and how
    many exact distances that took."""
    rows, n = ints.T, ints.shape[1]
    bounds = lower_bounds(norms, segment_norms(centroids.T))
    order = bounds.argsort(axis=1, kind="stable")
    best, which, exact = np.full(n, np.iinfo(np.int64).max), np.full(n, len(centroids)), 0
    left = np.arange(n)
    for place in range(len(centroids)):
        tried = order[left, place]
        open_still = bounds[left, tried] <= best[left]
        left, tried = left[open_still], tried[open_still]
        if not len(left):
            break
        exact += len(left)
        far = ((rows[left] - centroids[tried]) ** 2).sum(axis=1)
        better = (far < best[left]) | ((far == best[left]) & (tried < which[left]))
        best[left[better]], which[left[better]] = far[better], tried[better]
    return which, best, exact


def start(rows: DataFrame, k: int, scale: int, dims: int) -> np.ndarray:
    by = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = [r[0] for r in rows.orderBy(F.asc_nulls_last(by), "vector").select("vector").limit(k).collect()]
    return whole(np.array(first, np.float64).reshape(len(first), dims), scale, dims).astype(np.int64)


def sums_of(held: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One pass: k x (dims + 1), the sums of each centroid's vectors and, last, their number."""
    k, dims = centroids.shape
    now = held.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            for ints, norms in zip(batch.column(0), batch.column(1), strict=True):
                ints = ints_of(ints.as_py(), dims)
                which, _, _ = assign(ints, norms_of(norms.as_py(), ints.shape[1]), now.value)
                np.add.at(total[:, :dims], which, ints.T)
                total[:, dims] += np.bincount(which, minlength=k)
        used = np.flatnonzero(total[:, dims])
        offsets = pa.array(np.arange(0, len(used) * (dims + 1) + 1, dims + 1), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(total[used].ravel()))], names=["k", "sums"])

    each = held.select("ints", "norms").mapInArrow(run, "k int, sums array<bigint>").select("k", F.posexplode("sums").alias("at", "x"))
    total = np.zeros((k, dims + 1), np.int64)
    for r in each.groupBy("k", "at").agg(F.sum("x")).collect():  # k times dims + 1 at most
        total[r[0], r[1]] = r[2]
    now.unpersist()
    return total


def norms_of(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.float64).reshape(-1, n)


def cluster(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 16, rounds: int = 3, scale: int = 64) -> tuple[DataFrame, np.ndarray]:
    """Per vector: vec_id, cluster, distance (squared), cluster_inertia, inertia (distance summed over its cluster and over all) and
    centroid_sha256; and the centroids, k x dims."""
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")).where(finite(F.col("vector")) & (F.size(vector) == dims))
    centroids = start(rows, k, scale, dims)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, cluster int, distance bigint"
    if not len(centroids):
        zero = F.lit(0).cast("bigint")
        nothing = rows.select("vec_id", F.lit(0).alias("cluster"), *[zero.alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
        return nothing.limit(0), centroids
    held = blocks(rows, "vector", dims, scale, ["vec_id"], ("norms", segment_norms))
    for _ in range(rounds):
        total = sums_of(held, centroids)
        centroids = np.where(total[:, dims:] > 0, total[:, :dims] // np.maximum(total[:, dims:], 1), centroids)
    last = df.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ints = ints_of(batch.column(1)[at].as_py(), dims)
                which, far, _ = assign(ints, norms_of(batch.column(2)[at].as_py(), ints.shape[1]), last.value)
                yield pa.RecordBatch.from_arrays([batch.column(0)[at].values, pa.array(which, pa.int32()), pa.array(far)], names=["vec_id", "cluster", "distance"])

    found = cut(held.select("vec_id", "ints", "norms").mapInArrow(run, schema))
    sums = [(r[0], r[1]) for r in found.groupBy("cluster").agg(F.sum("distance")).orderBy("cluster").collect()]  # k at most
    of = lambda values, kind: F.element_at(F.create_map(*[x for j, v in values for x in (F.lit(j), F.lit(v).cast(kind))]), F.col("cluster"))
    digests = [(j, hashlib.sha256(joined(centroids[j]).encode()).hexdigest()) for j, _ in sums]
    return found.select("*", of(sums, "bigint").alias("cluster_inertia"), F.lit(sum(x for _, x in sums)).cast("bigint").alias("inertia"), of(digests, "string").alias("centroid_sha256")), centroids
