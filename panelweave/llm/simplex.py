"""Centroid clustering with candidates filtered by n-simplex projection.

A few pivots, far from each other, are drawn from a bounded sample. Each vector's distances to them are worked out once and kept with
it as the coordinates of an apex over the simplex of the pivots. The Euclidean distance of two apexes is a lower bound of the
distance of the vectors, and with the sign of the last coordinate turned, an upper bound. A centroid whose lower bound
exceeds the least upper bound cannot be the nearest; those left are compared exactly, in integers, so pivots
and rounding decide only how many comparisons are made. Each apex carries a bound of its own rounding error, by which the bounds of
the distances are widened.

Components are integers ``floor(scale * x)``. Sums by centroid are made in each task and added by Spark; the driver sees as many rows
as there are centroids. A vector that occurs a million times is a million rows of any task.

Vectors of another length, or with a null, NaN or infinite component, are left out, and so is a null vector. A component beyond
2**27 after scaling is an error, as squared distances would not fit a long. A null id counts as the empty text where the first
centroids are drawn; equal ids are told apart by their components, and equal rows are vectors of their own. With fewer vectors than
centroids each vector is one; without any the result is empty. Columns other than the two are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.workspace import materialise

#: Vectors, in the order that draws the first centroids, among which pivots are chosen.
PIVOT_SAMPLE = 256
PIVOTS = 8
#: A pivot must stand off the span of those before it by this share of the first two's distance.
_STANDS_OFF = 0.02
#: Relative rounding errors assumed: of a few float operations, and of the pivots' own coordinates (far above the real ones).
_ROUNDING, _BASE_ROUNDING = 2.0**-49, 1e-11
_LARGEST = 1 << 27


def quantised(vectors: DataFrame, key: str, vector: str, size: int, scale: int) -> DataFrame:
    """``id`` and integer ``components`` of the vectors that have ``size`` finite ones."""
    raw = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("raw"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = raw.where((F.size("raw") == size) & finite)

    def whole(x):
        scaled = F.floor(x * scale)
        large = F.raise_error(F.concat(F.lit("component out of range: "), x.cast("string")))
        return F.when(F.abs(x * scale) < _LARGEST, scaled).otherwise(large.cast("bigint"))

    return kept.select("id", F.transform("raw", whole).alias("components"))


def _order(vectors: DataFrame, salt: str) -> DataFrame:
    return vectors.withColumn("draw", F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256))


@dataclass
class Simplex:
    """Pivots and the coordinates of all but the first, which stands at the origin."""

    pivots: np.ndarray
    base: np.ndarray

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """From the distances to the pivots: a coordinate for each pivot but one, the height above their span, and a bound of the error."""
        squared = _squared(vectors, self.pivots).astype(np.float64)
        n, m = squared.shape
        lengths = (self.base**2).sum(axis=1)
        reach = np.sqrt(lengths.max()) if m > 1 else 0.0
        flat, error = np.zeros((n, m - 1)), np.zeros((n, m - 1))
        for i in range(m - 1):
            row, pivot = self.base[i, :i], self.base[i, i]
            flat[:, i] = ((squared[:, 0] + lengths[i] - squared[:, i + 1]) / 2 - flat[:, :i] @ row) / pivot
            error[:, i] = _ROUNDING * (squared[:, 0] + lengths[i] + squared[:, i + 1]) + error[:, :i] @ np.abs(row)
            error[:, i] = (error[:, i] + _BASE_ROUNDING * reach * np.abs(flat[:, : i + 1]).sum(axis=1)) / pivot
        height = np.sqrt(np.maximum(squared[:, 0] - (flat**2).sum(axis=1), 0))
        off = _ROUNDING * squared[:, 0] + ((2 * np.abs(flat) + error) * error).sum(axis=1)
        off_height = off / np.maximum(np.maximum(height, np.sqrt(off)), 1e-300)
        return np.column_stack([flat, height, np.sqrt((error**2).sum(axis=1) + off_height**2)])


def _squared(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances, by vector and other."""
    out = np.empty((len(vectors), len(others)), np.int64)
    for j, other in enumerate(others):
        off = vectors - other
        out[:, j] = np.einsum("ij,ij->i", off, off)
    return out


def choose_pivots(sample: np.ndarray, pivots: int = PIVOTS) -> Simplex:
    """Greedily the vector farthest from the span of those chosen, while it stands off clearly; at least one."""
    first = sample[0]
    points = (sample - first).astype(np.float64)
    chosen, axes = [0], []
    off = points.copy()
    least = 0.0
    while len(chosen) < pivots:
        distance = np.sqrt((off**2).sum(axis=1))
        far = int(distance.argmax())
        if len(chosen) == 1:
            least = _STANDS_OFF * distance[far]
        if distance[far] <= max(least, 1e-9):
            break
        axis = off[far] / distance[far]
        axes.append(axis)
        chosen.append(far)
        off = off - np.outer(off @ axis, axis)
    base = points[chosen[1:]] @ np.array(axes).T if axes else np.zeros((0, 0))
    return Simplex(sample[chosen], base)


def bounds(apexes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances, by apex and other."""
    flat, height = apexes[:, :-2], apexes[:, -2:-1]
    parts = ((flat[:, None, :] - others[None, :, :-2]) ** 2).sum(axis=2)
    slack = apexes[:, -1:] + others[None, :, -1]
    lower = np.sqrt(parts + (height - others[None, :, -2]) ** 2) * (1 - _ROUNDING) - slack
    upper = np.sqrt(parts + (height + others[None, :, -2]) ** 2) * (1 + _ROUNDING) + slack
    return np.maximum(lower, 0), upper


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centroid (the smaller number of equally near ones), its squared distance, and how many were compared exactly."""
    lower, upper = bounds(apexes, simplex.apexes(centroids))
    left = lower <= upper.min(axis=1, keepdims=True)
    row, number = np.nonzero(left)
    off = vectors[row] - centroids[number]
    exact = np.einsum("ij,ij->i", off, off)
    # By row, distance, number: the first of each row wins.
    order = np.lexsort((number, exact, row))
    first = order[np.append(True, np.diff(row[order]) > 0)] if len(order) else order
    return number[first], exact[first], left.sum(axis=1)


def _matrix(column: pa.Array, dtype: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), -1)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    places = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(places), pa.array(matrix.reshape(-1), kind))


def _project(simplex: Simplex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apexes = simplex.apexes(_matrix(batch.column(1), np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], _lists(apexes, pa.float64())], ["id", "components", "apex"])

    return run


def _sums(centroids: np.ndarray, simplex: Simplex):
    """One row for each centroid with vectors: its number, their count and their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centroids), np.int64), np.zeros_like(centroids)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(0), np.int64)
                cluster, _, _ = nearest(vectors, _matrix(batch.column(1), np.float64), centroids, simplex)
                count += np.bincount(cluster, minlength=len(centroids))
                for i in np.unique(cluster):
                    total[i] += vectors[cluster == i].sum(axis=0)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]), _lists(total[some], pa.int64())], ["cluster", "n", "sums"])

    return run


def _assign(centroids: np.ndarray, simplex: Simplex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = nearest(_matrix(batch.column(1), np.int64), _matrix(batch.column(2), np.float64), centroids, simplex)
                columns = [pa.array(c.astype(t)) for c, t in zip(found, (np.int32, np.int64, np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "cluster", "distance", "n_compared"])

    return run


def centroids_after(projected: DataFrame, centroids: np.ndarray, simplex: Simplex, rounds: int) -> np.ndarray:
    """The centroids after ``rounds`` rounds; each is one pass over the written vectors."""
    size = centroids.shape[1]
    for _ in range(rounds):
        parts = projected.select("components", "apex").mapInArrow(_sums(centroids, simplex), "cluster int, n long, sums array<bigint>")
        sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)])
        centroids = centroids.copy()
        # One row for each centroid.
        for r in sums.collect():
            centroids[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(size)]
    return centroids


def cluster(
    vectors: DataFrame, n_centroids: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, salt: str = "1:",
    pivots: int = PIVOTS, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``key``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256`` and ``n_compared``."""
    spark = vectors.sparkSession
    kept = quantised(vectors, key, vector, size, scale)
    # As many rows as there are centroids, or as the sample has.
    drawn = _order(kept, salt).orderBy("draw", "components").limit(max(n_centroids, PIVOT_SAMPLE)).collect()
    kind = vectors.schema[key].dataType
    if not drawn:
        schema = T.StructType([T.StructField(key, kind), *T.StructType.fromDDL(
            "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_compared int"
        )])
        return spark.createDataFrame([], schema)
    sample = np.array([r["components"] for r in drawn], np.int64)
    simplex = choose_pivots(sample[:PIVOT_SAMPLE], pivots)
    fields = T.StructType([T.StructField("id", kind), *T.StructType.fromDDL("components array<bigint>, apex array<double>")])
    projected = materialise(kept.mapInArrow(_project(simplex), fields), "apexes")
    centroids = centroids_after(projected, sample[:n_centroids], simplex, rounds)

    schema = T.StructType([T.StructField("id", kind), *T.StructType.fromDDL("cluster int, distance long, n_compared int")])
    assigned = materialise(projected.mapInArrow(_assign(centroids, simplex), schema), "assigned")
    # One row for each centroid, sent with its digest.
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    told = [(i, inertia.get(i, 0), sum(inertia.values()), d) for i, d in enumerate(digests)]
    known = spark.createDataFrame(told, "number int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = assigned.join(F.broadcast(known), F.col("cluster") == F.col("number"))
    return joined.select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_compared")
