"""Centroid clustering on integer vectors, with centroids filtered by their PCA rotation.

Vectors are rotated to the principal axes of the whole table.  A vector keeps its leading rotated
coordinates and the norm of the rest.  For two vectors the squared distance of the leading
coordinates plus the squared difference of the residual norms is a lower bound of their squared
distance, so only centroids whose bound is below the best distance so far are compared in full,
in integers.  The filter's rounding is covered by a margin; results are exact whatever the axes.

Every step is a scan of one stored table.  Tasks send back partial sums per centroid, which Spark
adds up; the driver holds the centroids alone (``k`` rows of ``dim`` integers).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import stored

DIM, SCALE, K, ROUNDS, SEED = 64, 256, 40, 5, 2
LEADING = 12
# Components beyond this could overflow a long in a squared distance.
LIMIT = 1 << 27
MARGIN = 1e-9


@dataclass(frozen=True)
class Rotation:
    """Mean and principal axes (columns, by falling variance) of a table of vectors."""

    mean: np.ndarray
    axes: np.ndarray
    leading: int

    def turn(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leading coordinates, residual norm and norm of the centred vectors."""
        turned = (vectors - self.mean) @ self.axes
        head, tail = turned[:, : self.leading], turned[:, self.leading :]
        rest = np.einsum("ij,ij->i", tail, tail)
        return head, np.sqrt(rest), np.sqrt(rest + np.einsum("ij,ij->i", head, head))


def integers(vectors: DataFrame, dim: int = DIM, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v`` (components as ``floor(scale * x)``) of the vectors of ``dim`` finite components.

    Others, null ones and those with a null or non-finite component included, are left out.
    """
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    whole = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v")).filter(F.size("v") == dim)
    finite = whole.filter(F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf"))))
    # A product beyond a long is caught by the limit, not wrapped.
    bounded = lambda c: F.greatest(F.least(F.floor(c * F.lit(float(scale))), F.lit(2 * LIMIT)), F.lit(-2 * LIMIT))
    return finite.select("vec_id", F.transform("v", bounded).cast("array<int>").alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def principal_axes(rows: DataFrame, dim: int, leading: int = LEADING) -> Rotation:
    """Axes of all vectors ``v``, from partial sums that tasks make and Spark adds up."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            v = np.hstack([_matrix(batch.column(0), dim).astype(float), np.ones((batch.num_rows, 1))])
            total += v.T @ v
        if total[dim, dim]:
            place = np.arange(total.size, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel())], ["place", "x"])

    sums = rows.select("v").mapInArrow(moments, "place int, x double").groupBy("place").agg(F.sum("x").alias("x")).toArrow()
    both = np.zeros((dim + 1) ** 2)
    both[sums["place"].to_numpy()] = sums["x"].to_numpy()
    both = both.reshape(dim + 1, dim + 1)
    n = max(1.0, both[dim, dim])
    mean = both[dim, :dim] / n
    values, axes = np.linalg.eigh(both[:dim, :dim] / n - np.outer(mean, mean))
    return Rotation(mean, np.ascontiguousarray(axes[:, np.argsort(-values)]), min(leading, dim))


def nearest(v: np.ndarray, head: np.ndarray, rest: np.ndarray, norm: np.ndarray, centres: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number) and exact squared distance of every vector, and how many pairs were compared in full."""
    c_head, c_rest, c_norm = rotation.turn(centres.astype(float))
    low = (head**2).sum(1)[:, None] + (c_head**2).sum(1)[None] - 2 * head @ c_head.T + (rest[:, None] - c_rest[None]) ** 2
    low -= MARGIN * ((norm[:, None] + c_norm[None]) ** 2 + 1)
    best = low.argmin(1)
    distance = ((v - centres[best]) ** 2).sum(1)
    # The bound of a centroid that is as near and has a smaller number may equal the distance.
    low[np.arange(len(v)), best] = np.inf
    left = low <= distance[:, None]
    compared = len(v)
    for c in np.flatnonzero(left.any(0)):
        i = np.flatnonzero(left[:, c] & (low[:, c] <= distance))
        compared += len(i)
        d = ((v[i] - centres[c]) ** 2).sum(1)
        wins = (d < distance[i]) | ((d == distance[i]) & (c < best[i]))
        best[i[wins]], distance[i[wins]] = c, d[wins]
    return best, distance, compared


def starts(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:vec_id`` (null ids last, then by components), in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(k)
    return np.array([r.v for r in first.collect()], np.int64)


def _turned(rows: DataFrame, rotation: Rotation, dim: int) -> DataFrame:
    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head, rest, norm = rotation.turn(_matrix(batch.column(1), dim).astype(float))
            heads = pa.FixedSizeListArray.from_arrays(pa.array(head.ravel()), rotation.leading).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), heads, pa.array(rest), pa.array(norm)], ["vec_id", "v", "head", "rest", "norm"])

    return rows.mapInArrow(turn, "vec_id long, v array<int>, head array<double>, rest double, norm double")


def _assigned(batch: pa.RecordBatch, centres: np.ndarray, rotation: Rotation) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    v = _matrix(batch.column(1), centres.shape[1])
    head = batch.column(2).flatten().to_numpy().reshape(-1, rotation.leading)
    best, distance, _ = nearest(v, head, batch.column(3).to_numpy(), batch.column(4).to_numpy(), centres, rotation)
    return v, best, distance


def _moved(table: DataFrame, centres: np.ndarray, rotation: Rotation) -> np.ndarray:
    """Centroids after a round: the floor of the mean of their vectors; empty ones stay."""
    k, dim = centres.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            v, best, _ = _assigned(batch, centres, rotation)
            order = np.argsort(best, kind="stable")
            at = np.flatnonzero(np.diff(best[order], prepend=-1))
            if len(at):
                total[best[order][at]] += np.add.reduceat(v[order], at)
            n += np.bincount(best, minlength=k)
        place = np.flatnonzero(np.repeat(n, dim))
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel()[place]), pa.array(np.repeat(n, dim)[place])], ["place", "x", "n"])

    # Decimals: the sum over all vectors may be beyond a long.
    found = table.mapInArrow(sums, "place long, x long, n long").groupBy("place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n")).collect()
    out = centres.copy().ravel()
    for r in found:
        out[r.place] = int(r.x) // r.n
    return out.reshape(k, dim)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED, leading: int = LEADING, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Assignment of every vector after ``rounds`` rounds, as ``vec_id, cluster, distance``, and the centroids.

    Vectors that are null, have another number of components, or a null or non-finite component
    are left out.  Rows with null or repeated ids are vectors of their own.  With fewer than
    ``k`` vectors every vector is a centroid at the start; a table without vectors gives no rows.
    Other columns aren't read.  A component whose integer lies beyond ``LIMIT`` is an error.
    """
    rows = integers(vectors, dim, scale, id_col, vector_col)
    size = F.array_max(F.transform("v", lambda c: F.abs(c)))
    rows = rows.select("vec_id", F.when(size <= LIMIT, F.col("v")).otherwise(F.raise_error(F.lit(f"a component is beyond {LIMIT}"))).alias("v"))
    centres = starts(rows, k, seed)
    if not len(centres):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.empty((0, dim), np.int64)
    rotation = principal_axes(rows, dim, leading)
    table = stored(_turned(rows, rotation, dim), "vectors")
    for _ in range(rounds):
        centres = _moved(table, centres, rotation)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, best, distance = _assigned(batch, centres, rotation)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return stored(table.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters"), centres


def digest(centre: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centre.tolist())).encode()).hexdigest()


def with_inertia(assigned: DataFrame, centres: np.ndarray) -> DataFrame:
    """Add ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; sums come per cluster, at most one row a centroid."""
    sums = {r.cluster: int(r.d) for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    of: list[tuple[int, int, str]] = [(c, sums.get(c, 0), digest(centres[c])) for c in range(len(centres))]
    each = assigned.sparkSession.createDataFrame(of, "cluster int, cluster_inertia long, centroid_sha256 string")
    total: Column = F.lit(sum(sums.values())).cast("long")
    return assigned.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", total.alias("inertia"), "centroid_sha256")
