"""Centroid clustering (operator 12): rounds of nearest centroids, found by the threshold algorithm.

Components are whole numbers, so distances, sums and centroids are exact and the result does not depend on any order.

The centroids stand once per dimension in a list sorted by their value there. A vector walks each list outward from its own
value: a step takes from every list the next nearest centroid, and a centroid met for the first time gets its exact distance.
What no list has shown yet is in each dimension at least as far away as the next entry of that list (its frontier), so the
walk ends once the squared frontier distances sum up to more than the best exact distance. Strictly more: at a tie a centroid
with a smaller number may still be waiting.

Spark deals out the vectors. A task adds its vectors up to one row per centroid and dimension before the shuffle, however
many of them share a centroid, and only the centroids (``k`` times ``dims`` numbers, both parameters) pass through the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.stages import map_arrow, small_batches, table, write_stage

CENTROIDS, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
LIMB = 40  # bits; sums travel in limbs, so they are exact for numbers of any size
FAST = 1 << 27  # up to here squared distances of 64 components fit 64 bits; beyond, Python's whole numbers take over
LARGEST = (1 << 63) - 1
_FAR = np.int64(1) << np.int64(61)


def whole(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, a row per vector: 64-bit numbers, or Python's where these could overflow."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    if not values.size or np.abs(values).max() * scale <= FAST:
        return np.floor(values * scale).astype(np.int64)
    exact = [math.floor(Fraction(x) * scale) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(-1, dims)


class SortedLists:
    """The centroids (rows of ``centers``), listed per dimension by their value there."""

    def __init__(self, centers: np.ndarray):
        if centers.dtype != object and np.abs(centers).max(initial=0) > FAST:
            centers = centers.astype(object)
        self.centers = centers
        self.k, self.dims = centers.shape
        self.ids = np.argsort(centers, axis=0, kind="stable")
        self.values = np.take_along_axis(centers, self.ids, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (the smallest at a tie) of each vector, and its squared distance."""
        centers = self.centers
        if object in (vectors.dtype, centers.dtype):
            vectors, centers = vectors.astype(object), centers.astype(object)
        far = _FAR if vectors.dtype != object else 1 << 4_000
        n, dims = vectors.shape
        right = np.empty((n, dims), np.int64)
        for d in range(dims):
            right[:, d] = np.searchsorted(self.values[:, d], vectors[:, d])
        left = right - 1
        found = np.full((n, self.k), far, vectors.dtype)
        seen = np.zeros((n, self.k), bool)
        walking = np.arange(n)
        dim = np.arange(dims)
        for step in range(self.k):
            if not len(walking):
                break
            x, lo, hi = vectors[walking], left[walking], right[walking]
            below, above = self._gaps(x, lo, hi, far)
            down = below <= above
            met = self.ids[np.where(down, lo, hi), dim]
            lo, hi = lo - down, hi + ~down
            left[walking], right[walking] = lo, hi
            shown = np.zeros((len(walking), self.k), bool)
            shown[np.arange(len(walking))[:, None], met] = True
            row, center = np.nonzero(shown & ~seen[walking])
            seen[walking] |= shown
            gap = x[row] - centers[center]
            found[walking[row], center] = (gap * gap).sum(axis=1)
            if step + 1 < self.k:  # then every list still has an entry
                frontier = np.minimum(*self._gaps(x, lo, hi, far))
                walking = walking[(frontier * frontier).sum(axis=1) <= found[walking].min(axis=1)]
        best = found.argmin(axis=1) if n else np.empty(0, np.int64)
        return best, found[np.arange(n), best]

    def _gaps(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray, far) -> tuple[np.ndarray, np.ndarray]:
        dim = np.arange(self.dims)
        below = np.where(lo >= 0, x - self.values[np.maximum(lo, 0), dim], far)
        above = np.where(hi < self.k, self.values[np.minimum(hi, self.k - 1), dim] - x, far)
        return below, above


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, part) with value = sum of part << (LIMB * place); parts below 2**LIMB but for the sign."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield place, sign * (value & ((1 << LIMB) - 1))
        value >>= LIMB
        place += 1


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


def kept(df: DataFrame, id_column: str, column: str, dims: int) -> DataFrame:
    """(vec_id, v): vectors of exactly ``dims`` components, none of them null, infinite or not a number."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return df.select(_column(id_column).cast("long").alias("vec_id"), _column(column).cast("array<double>").alias("v")).filter(
        F.col("v").isNotNull() & (F.size("v") == dims) & F.forall("v", sound))


def seeds(vectors: DataFrame, k: int, dims: int, scale: int) -> np.ndarray:
    """The ``k`` vectors whose ``1:<id>`` has the smallest SHA-256 (a null id is an empty text); ties by components."""
    order = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return whole(pa.array([list(r.v) for r in first], pa.list_(pa.float64())), dims, scale) if first else np.empty((0, dims), np.int64)


def moved(vectors: DataFrame, centers: np.ndarray, scale: int) -> np.ndarray:
    """The floored means of the vectors nearest to each centroid; a centroid without any stays."""
    lists, (k, dims) = SortedLists(centers), centers.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), object), np.zeros(k, np.int64)
        for batch in batches:
            x = whole(batch.column("v"), dims, scale)
            nearest, _ = lists.nearest(x)
            counts += np.bincount(nearest, minlength=k)
            for c in np.unique(nearest).tolist():
                sums[c] += x[nearest == c].sum(axis=0).astype(object)
        rows = [(c, -1, 0, int(counts[c])) for c in range(k) if counts[c]]
        rows += [(c, d, place, part) for c in range(k) for d in range(dims) for place, part in limbs(int(sums[c, d]))]
        if rows:
            yield table(**dict(zip(("cluster", "dim", "place", "part"), (np.array(x, np.int64) for x in zip(*rows)))))

    parts = map_arrow(vectors.select("v"), work, "cluster long, dim long, place long, part long")
    totals: dict[tuple[int, int], int] = {}
    for row in parts.groupBy("cluster", "dim", "place").agg(F.sum("part").alias("part")).collect():  # some rows per centroid and dimension
        key = (row.cluster, row.dim)
        totals[key] = totals.get(key, 0) + (row.part << (LIMB * row.place))
    out = centers.astype(object)
    for c in range(k):
        if n := totals.get((c, -1)):
            out[c] = [totals.get((c, d), 0) // n for d in range(dims)]
    small = max((abs(x) for x in out.ravel().tolist()), default=0) <= FAST
    return out.astype(np.int64) if small else out


def clusters(df: DataFrame, id_column: str = "vec_id", column: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
             dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """One row per vector: the id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Vectors of another length than ``dims``, or with a null, infinite or undefined component, are left out; fewer than ``k``
    vectors make as many centroids. Repeated rows and null ids are vectors like any others; other columns play no part.
    Equal distances go to the smaller centroid number. A distance or sum beyond 64 bits is given as 2**63 - 1.
    An empty table gives no rows.
    """
    small_batches(df.sparkSession)
    vectors = kept(df, id_column, column, dims)
    centers = seeds(vectors, k, dims, scale)
    schema = "vec_id long, cluster int, distance long"
    if not len(centers):
        none = vectors.limit(0).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return none.select(F.col("vec_id").alias(id_column), "cluster", "distance", F.col("distance").alias("cluster_inertia"),
                           F.col("distance").alias("inertia"), F.lit("").alias("centroid_sha256"))
    for _ in range(rounds):
        centers = moved(vectors, centers, scale)
    lists = SortedLists(centers)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest, distance = lists.nearest(whole(batch.column("v"), dims, scale))
            if distance.dtype == object:
                distance = np.array([min(d, LARGEST) for d in distance.tolist()], np.int64)
            yield table(vec_id=batch.column("vec_id"), cluster=nearest.astype(np.int32), distance=distance)

    found = write_stage(map_arrow(vectors, work, schema), "clusters")
    capped = lambda c: F.least(F.sum(c.cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)"))
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(capped(F.col("distance")).alias("s")).collect()}  # at most k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers.tolist()]
    by_cluster = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return found.select(
        F.col("vec_id").alias(id_column), "cluster", "distance", by_cluster([sums.get(c, 0) for c in range(len(centers))]).cast("long").alias("cluster_inertia"),
        F.lit(min(sum(sums.values()), LARGEST)).cast("long").alias("inertia"), by_cluster(digests).alias("centroid_sha256"))
