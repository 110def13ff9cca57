"""Centroid clustering by a bisector tournament, in exact integers.

A vector lies nearer to centroid i than to centroid j if it lies on i's side of the plane between them: with integer normals
``2 (c_j - c_i)`` and thresholds ``|c_j|^2 - |c_i|^2`` of all pairs worked out beforehand, one linear test tells the loser.
k - 1 tests eliminate all centroids but one; a test of zero favours the smaller number. Only the distance to the winner is ever computed.

Every round is one pass over the stored vectors: each task adds up its vectors by centroid, and what leaves it are sums, split into
limbs of ``LIMB`` bits so that their totals are exact however many rows there are. The driver sees the totals of k centroids.

Vectors that are NULL, have another number of components, or components that are NULL, not finite or leave the doubles when scaled take no
part. Repeated rows count each; rows of one id and different vectors are ordered by their components where centroids start; a NULL id comes
after all others there. Fewer vectors than ``k`` start as many centroids as there are; none give an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidewatch.llm.common import cut_lineage

#: Components up to this size (and so all tests and distances of ``dims`` up to 4,096) fit 64-bit integers; beyond it Python's integers are used.
NARROW = 1 << 22
#: Bits of a limb of a sum that leaves a task.
LIMB = 32
LONG = 1 << 63


@dataclass(frozen=True)
class Clustering:
    """Final centroids, and what the last assignment gave: inertia of each centroid's vectors."""

    centroids: tuple[tuple[int, ...], ...]
    inertias: tuple[int, ...]

    @property
    def inertia(self) -> int:
        return sum(self.inertias)

    def digests(self) -> list[str]:
        """SHA-256 of each centroid's components as decimal integers joined by commas."""
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids]


def scaled(vectors: DataFrame, vector: str, dims: int, scale: float) -> DataFrame:
    """Rows whose ``vector`` has ``dims`` finite components, with the integers ``floor(scale * x)`` (as doubles, which hold them exactly) in its place."""
    parts = F.transform(F.col(vector).cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    whole = F.transform(parts, lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x))
    sound = F.forall(parts, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vectors.where(F.size(vector) == dims).withColumn("__parts", whole).where(sound).drop(vector).withColumnRenamed("__parts", vector)


class Tournament:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: Sequence[Sequence[int]]):
        self.k = len(centroids)
        self.narrow = max((abs(c) for row in centroids for c in row), default=0) <= NARROW
        self.planes = {kind: self._planes(np.array(centroids, dtype=kind)) for kind in ([np.int64, object] if self.narrow else [object])} if centroids else {}

    @staticmethod
    def _planes(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        square = (c * c).sum(axis=1)
        return c, 2 * (c[None, :, :] - c[:, None, :]), square[None, :] - square[:, None]

    def winners(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row of ``x`` and its squared distance, exact."""
        x = x if self.narrow else x.astype(object)
        c, normals, thresholds = self.planes[object if x.dtype == object else np.int64]
        best = np.zeros(len(x), np.int64)
        for j in range(1, self.k):
            beaten = (x * normals[best, j]).sum(axis=1) > thresholds[best, j]
            best[beaten.astype(bool)] = j
        apart = x - c[best]
        return best, (apart * apart).sum(axis=1)


def _matrix(column: pa.Array, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, rows): integers of the vectors in 64 bits, then of those with larger components as Python's integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    wide = np.abs(flat).max(axis=1, initial=0) > NARROW
    if not wide.all():
        yield np.flatnonzero(~wide), flat[~wide].astype(np.int64)
    if wide.any():
        yield np.flatnonzero(wide), np.array([[int(v) for v in row] for row in flat[wide]], dtype=object)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, limb) of an integer; the last limb carries the sign."""
    at = 0
    while not -(1 << LIMB) < value < 1 << LIMB:
        yield at, value & ((1 << LIMB) - 1)
        value >>= LIMB
        at += 1
    yield at, value


_SUMS = "cluster int, part int, limb int, value long"


def _summing(centroids: Sequence[Sequence[int]], vector: str, dims: int):
    """Sums of a task by centroid: part -1 is the number of vectors, 0 and on are the components, ``dims`` is the inertia."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arena = Tournament(centroids)
        totals = np.zeros((arena.k, dims + 2), dtype=object)
        for batch in batches:
            for _, x in _matrix(batch.column(vector), dims):
                best, distance = arena.winners(x)
                for c in np.unique(best).tolist():
                    mine = best == c
                    totals[c, -1] += int(mine.sum())
                    totals[c, :dims] += x[mine].sum(axis=0).astype(object)
                    totals[c, dims] += sum(distance[mine].tolist())
        rows = [(c, -1 if p == dims + 1 else p, at, limb) for c, row in enumerate(totals) for p, value in enumerate(row) if value for at, limb in _limbs(int(value))]
        cluster, part, at, value = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(part, pa.int32()), pa.array(at, pa.int32()), pa.array(value, pa.int64())], ["cluster", "part", "limb", "value"])

    return run


def _totals(kept: DataFrame, centroids: Sequence[Sequence[int]], vector: str, dims: int) -> list[list[int]]:
    """By centroid: sums of the components, inertia, number of vectors."""
    sums = kept.select(vector).mapInArrow(_summing(centroids, vector, dims), _SUMS)
    found = [[0] * (dims + 2) for _ in centroids]
    for r in sums.groupBy("cluster", "part", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        found[r["cluster"]][r["part"]] += int(r["value"]) << (LIMB * r["limb"])
    return found


def fit(kept: DataFrame, vector: str, dims: int, k: int, rounds: int, order: Sequence[Column]) -> Clustering:
    """Centroids of the ``scaled`` rows in ``kept``: the first ``k`` rows by ``order`` (ties: by components), moved ``rounds`` times."""
    first = kept.orderBy(*order, F.col(vector)).limit(k).select(vector).collect()
    centroids = [tuple(int(v) for v in r[vector]) for r in first]
    if not centroids:
        return Clustering((), ())
    for _ in range(rounds):
        found = _totals(kept, centroids, vector, dims)
        centroids = [tuple(s // t[-1] for s in t[:dims]) if t[-1] else c for c, t in zip(centroids, found, strict=True)]
    return Clustering(tuple(centroids), tuple(t[dims] for t in _totals(kept, centroids, vector, dims)))


def _assigning(centroids: Sequence[Sequence[int]], vector: str, dims: int, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arena = Tournament(centroids)
        for batch in batches:
            cluster, distance = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, object)
            for at, x in _matrix(batch.column(vector), dims):
                best, apart = arena.winners(x)
                cluster[at], distance[at] = best, apart.astype(object)
            longs = pa.array([d if d < LONG else None for d in distance.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(cluster), longs], [*kept, "cluster", "distance"])

    return run


def assign(kept: DataFrame, found: Clustering, vector: str, dims: int) -> DataFrame:
    """``kept`` without ``vector`` plus ``cluster`` (int) and ``distance`` (long, squared; NULL if it does not fit). Columns of those names are replaced."""
    others = [f for f in kept.schema.fields if f.name not in (vector, "cluster", "distance")]
    schema = StructType([*others, StructField("cluster", IntegerType()), StructField("distance", LongType())])
    return kept.mapInArrow(_assigning(found.centroids, vector, dims, [f.name for f in others]), schema)


def _long(value: int) -> Column:
    return F.lit(value if value < LONG else None).cast("long")


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 8, rounds: int = 10, scale: float = 1024.0, salt: str = "3:") -> DataFrame:
    """``vectors`` that take part, without ``vector``, plus cluster, distance, inertias (NULL beyond 64 bits) and the digest of the centroid."""
    names = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    kept = cut_lineage(scaled(vectors.drop(*[n for n in names if n not in (key, vector)]), vector, dims, scale), "vectors")
    digest = F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256)
    found = fit(kept, vector, dims, k, rounds, [digest.asc_nulls_last()])
    rows = assign(kept, found, vector, dims)
    if not found.centroids:
        return rows.select("*", *[F.lit(None).cast(t).alias(n) for n, t in zip(names[2:], ("long", "long", "string"), strict=True)])
    own = F.element_at(F.array(*map(_long, found.inertias)), F.col("cluster") + 1)
    sha = F.element_at(F.array(*map(F.lit, found.digests())), F.col("cluster") + 1)
    return rows.select("*", own.alias("cluster_inertia"), _long(found.inertia).alias("inertia"), sha.alias("centroid_sha256"))
