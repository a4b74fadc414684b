"""Centroid clustering of vectors: exact nearest centroids by a progressive Walsh-Hadamard search.

Components become integers, and so all distances, sums and means are exact. The transform of vectors
and centroids keeps distances up to the factor 64, and its first 2, 4, 8 ... coefficients are those of
ever finer block sums. Squared differences are added up from coarse to fine; a centroid whose sum so far
is above the full distance of another one is strictly worse and leaves; those that stay finish all 64.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

WIDTH = 64

#: Coefficients that are looked at together, coarse to fine.
LEVELS = ((0, 4), (4, 8), (8, 16), (16, 32), (32, 64))

#: Components below this keep every sum of squares in 64 bits; others are counted in Python's integers.
SMALL = 1 << 20

#: Sums travel in digits of so many bits, so that adding digits of many tasks stays in 64 bits.
DIGIT_BITS = 40

LARGEST = (1 << 63) - 1

NEW_COLUMNS = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

_FINE = np.array([int(f"{k:06b}"[::-1], 2) for k in range(WIDTH)])


@dataclass(frozen=True)
class ClusterRule:
    """``clusters`` start vectors of smallest sha256 of ``prefix`` and the id; ``rounds`` of moving them."""

    clusters: int = 16
    rounds: int = 3
    prefix: str = "1:"
    id_column: str = "vec_id"
    vector_column: str = "embedding"


def transform(vectors: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of every row, coarse coefficients first."""
    out = vectors.reshape(-1, WIDTH)
    half = WIDTH // 2
    while half:
        blocks = out.reshape(len(out), -1, 2, half)
        low, high = blocks[:, :, 0], blocks[:, :, 1]
        out = np.stack((low + high, low - high), axis=2).reshape(len(out), WIDTH)
        half //= 2
    return out[:, _FINE]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid per row, both given as transforms.

    Of equally near centroids the one with the smaller number counts.
    """
    start, stop = LEVELS[0]
    sums = ((vectors[:, None, start:stop] - centroids[None, :, start:stop]) ** 2).sum(axis=2)
    guess = sums.argmin(axis=1)
    limit = ((vectors - centroids[guess]) ** 2).sum(axis=1)
    row, number = np.nonzero(sums <= limit[:, None])
    sums = sums[row, number]
    for start, stop in LEVELS[1:]:
        sums = sums + ((vectors[row, start:stop] - centroids[number, start:stop]) ** 2).sum(axis=1)
        stays = (sums <= limit[row]).astype(bool)
        row, number, sums = row[stays], number[stays], sums[stays]
    # The guess always stays, so every row is still there, its centroids in ascending order.
    begins = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    least = np.minimum.reduceat(sums, begins)
    best = np.flatnonzero(sums == least[row])
    first = best[np.unique(row[best], return_index=True)[1]]
    return number[first], least // WIDTH


def _floored(x: float) -> int:
    """floor(64 x), exactly: beyond 2**53 a float is a whole number itself."""
    return math.floor(x * WIDTH) if abs(x) < 1 << 53 else int(x) * WIDTH


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, integer vectors) of the rows with 64 finite components."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    right_size = pc.fill_null(pc.equal(pc.list_value_length(column), WIDTH), False)
    rows = np.flatnonzero(right_size.to_numpy(zero_copy_only=False))
    x = column.filter(right_size).flatten().to_numpy(zero_copy_only=False)
    x = x.astype(np.float64).reshape(-1, WIDTH)
    finite = np.isfinite(x).all(axis=1)
    rows, x = rows[finite], x[finite]
    if not len(x) or np.abs(x).max() * WIDTH < SMALL:
        return rows, np.floor(x * WIDTH).astype(np.int64)
    return rows, np.array([list(map(_floored, v)) for v in x.tolist()], object)


def _fitting(centroids: list[list[int]]) -> np.ndarray:
    """Centroids as 64-bit integers if they are small, otherwise as Python's integers."""
    small = all(abs(x) < SMALL for c in centroids for x in c)
    return np.array(centroids, np.int64 if small else object).reshape(-1, WIDTH)


def _assigned(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(vectors):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = object if object in (vectors.dtype, centroids.dtype) else np.int64
    return nearest(transform(vectors.astype(kind)), transform(centroids.astype(kind)))


def start_vectors(vectors: DataFrame, rule: ClusterRule) -> list[list[int]]:
    """The first centroids. Every task sends on its ``clusters`` best, so the driver gets that many rows."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[str, list[str]]] = []
        for batch in batches:
            rows, vectors = integers(batch.column(1))
            ids = batch.column(0).to_pylist()
            named = ("" if ids[r] is None else str(ids[r]) for r in rows)
            hashes = (hashlib.sha256(f"{rule.prefix}{i}".encode()).hexdigest() for i in named)
            new = heapq.nsmallest(
                rule.clusters, ((h, k) for k, h in enumerate(hashes)), key=lambda x: (x[0], vectors[x[1]].tolist())
            )
            found += [(h, [str(x) for x in vectors[k].tolist()]) for h, k in new]
            found = heapq.nsmallest(rule.clusters, found, key=lambda x: (x[0], list(map(int, x[1]))))
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in found], pa.string()), pa.array([v for _, v in found], pa.list_(pa.string()))],
            ["hash", "vector"],
        )

    rows = (
        vectors.select(rule.id_column, rule.vector_column)
        .mapInArrow(best, "hash string, vector array<string>")
        # Equal ids are ordered by their components, as numbers.
        .orderBy("hash", F.transform("vector", lambda x: x.cast("double")), "vector")
        .limit(rule.clusters)
        .collect()
    )
    return [list(map(int, r["vector"])) for r in rows]


def cluster_sums(vectors: DataFrame, centroids: list[list[int]], rule: ClusterRule) -> list[list[int]]:
    """Per centroid: the exact sums of its vectors' components, of their distances, and their number.

    Every task adds up its own rows; what the driver gets does not grow with the table.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = _fitting(centroids)
        totals = [[0] * (WIDTH + 2) for _ in centroids]
        for batch in batches:
            _, part = integers(batch.column(0))
            cluster, distance = _assigned(part, given)
            for c in np.unique(cluster).tolist():
                held = cluster == c
                sums = [*part[held].sum(axis=0).tolist(), int(distance[held].astype(object).sum()), int(held.sum())]
                totals[c] = [x + y for x, y in zip(totals[c], sums)]
        rows = [(c, j, *digit) for c, sums in enumerate(totals) for j, x in enumerate(sums) for digit in _digits(x)]
        columns = [pa.array(x, t) for x, t in zip(zip(*rows), _SUM_TYPES)] if rows else [pa.array([], t) for t in _SUM_TYPES]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "place", "digit", "total"])

    found = [[0] * (WIDTH + 2) for _ in centroids]
    sums = (
        vectors.select(rule.vector_column)
        .mapInArrow(summed, "cluster int, place int, digit int, total bigint")
        .groupBy("cluster", "place", "digit")
        .agg(F.sum("total").alias("total"))
    )
    for r in sums.collect():
        found[r["cluster"]][r["place"]] += r["total"] << (DIGIT_BITS * r["digit"])
    return found


_SUM_TYPES = (pa.int32(), pa.int32(), pa.int32(), pa.int64())


def _digits(x: int) -> Iterator[tuple[int, int]]:
    """(place, digit with the sign of ``x``) of all digits that are not zero."""
    sign, x, place = (-1 if x < 0 else 1), abs(x), 0
    while x:
        if digit := x & ((1 << DIGIT_BITS) - 1):
            yield place, sign * digit
        x >>= DIGIT_BITS
        place += 1


def final_centroids(vectors: DataFrame, rule: ClusterRule = ClusterRule()) -> list[list[int]]:
    """Centroids after all rounds; one without vectors stays where it is."""
    centroids = start_vectors(vectors, rule)
    for _ in range(rule.rounds if centroids else 0):
        sums = cluster_sums(vectors, centroids, rule)
        centroids = [[x // s[-1] for x in s[:WIDTH]] if s[-1] else c for c, s in zip(centroids, sums)]
    return centroids


def clustered(vectors: DataFrame, rule: ClusterRule = ClusterRule()) -> DataFrame:
    """The rows of ``vectors`` with 64 finite components, with their cluster.

    New are ``cluster``, ``distance`` (squared, to the final centroid), ``cluster_inertia`` and
    ``inertia`` (sums of it) and ``centroid_sha256``. Null, short and long vectors and those with a null
    or a component that is not finite are left out, as are all rows of an empty table. Equal vectors and
    repeated ids are rows of their own; a null id counts as the empty text where starts are chosen. With
    fewer vectors than clusters there are as many centroids as vectors. A distance or a sum beyond 64
    bits is null. All columns stay; those named like new ones are replaced.
    """
    centroids = final_centroids(vectors, rule)
    sums = [s[WIDTH] for s in cluster_sums(vectors, centroids, rule)] if centroids else []
    fits = lambda x: x if x <= LARGEST else None
    inertia, every = [fits(s) for s in sums], fits(sum(sums))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    held = [c for c in vectors.columns if c not in NEW_COLUMNS]
    rows = vectors.select(*held)
    at = held.index(rule.vector_column)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = _fitting(centroids)
        for batch in batches:
            kept, part = integers(batch.column(at))
            cluster, distance = _assigned(part, given)
            of = cluster.tolist()
            new = [
                pa.array(of, pa.int32()),
                pa.array([fits(x) for x in distance.tolist()], pa.int64()),
                pa.array([inertia[c] for c in of], pa.int64()),
                pa.array([every] * len(of), pa.int64()),
                pa.array([digests[c] for c in of], pa.string()),
            ]
            old = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([*old.columns, *new], [*held, *NEW_COLUMNS])

    kinds = (IntegerType(), LongType(), LongType(), LongType(), StringType())
    schema = StructType([*rows.schema.fields, *map(StructField, NEW_COLUMNS, kinds)])
    return rows.mapInArrow(described, schema)
