"""Centroid clustering of integer vectors, filtered in PCA-rotated coordinates.

An orthogonal rotation keeps distances, so with a vector cut into its leading rotated
coordinates p and the norm r of what is left,

    |x - c|^2  >=  |p(x) - p(c)|^2 + (r(x) - r(c))^2 .

Both parts are stored once per vector.  A round works out this bound for all centroids by
one matrix product, verifies the most promising centroid in integers, and then only those
whose bound does not exceed its distance.  Floating point decides what is verified, never
the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import spare

# Leading rotated coordinates that are stored for each vector.
LEADING = 16
# Components below this fit 32 bits and squared distances of some thousand components 64 bits.
MAX_COMPONENT = 1 << 25
# Rows whose bounds, and (vector, centroid) pairs whose differences, are in memory together.
ROWS, PAIRS = 1 << 12, 1 << 14
# Tasks that add up the tasks' sums before the driver adds up theirs.
MERGERS = 32


def quantised(vectors: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, x): the kept vectors as integers floor(scale * component), packed as 32 bit each."""
    value = F.col(f"`{vector}`")
    limit = MAX_COMPONENT / scale
    kept = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), value.cast("array<double>").alias("v"))
    # A comparison with NaN as the largest value and with null as unknown leaves out both.
    kept = kept.filter(F.size("v") == dims).filter(
        F.coalesce(F.forall("v", lambda x: (x < limit) & (x >= -limit)), F.lit(False))
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            whole = np.floor(scale * values).astype("<i4").reshape(-1, dims)
            packed = pa.array([row.tobytes() for row in whole], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["id", "x"])

    return kept.mapInArrow(pack, "id long, x binary")


def _matrix(packed: pa.Array, dtype: str, width: int) -> np.ndarray:
    """Rows of equally long packed vectors as a matrix."""
    return np.frombuffer(b"".join(packed.to_pylist()), dtype).reshape(-1, width)


def first_centroids(vectors: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The k vectors with the smallest hash of their key; fewer if there are fewer keys."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.filter("id is not null").orderBy(name, "x").limit(k).select("x").collect()
    return np.array([np.frombuffer(r.x, "<i4") for r in rows], np.int64).reshape(-1, dims)


def rotation(vectors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, directions of largest variance as columns), from all vectors.

    Each task adds up its vectors and their outer products, MERGERS tasks add up those,
    so that a bounded number of sums reaches the driver.
    """
    width = 1 + dims + dims * dims

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            x = _matrix(batch.column(1), "<i4", dims).astype(float)
            total += np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for packed in batch.column(0):
                total += np.frombuffer(packed.as_buffer(), float)
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    merged = vectors.mapInArrow(sums, "sums binary").repartition(MERGERS).mapInArrow(merge, "sums binary")
    total = sum((np.frombuffer(r.sums, float) for r in merged.collect()), np.zeros(width))
    n = max(total[0], 1.0)
    mean = total[1 : 1 + dims] / n
    _, directions = np.linalg.eigh(total[1 + dims :].reshape(dims, dims) / n - np.outer(mean, mean))
    return mean, np.ascontiguousarray(directions[:, ::-1][:, :LEADING])


def project(x: np.ndarray, mean: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Leading rotated coordinates of each row, and the norm of the rest."""
    moved = x - mean
    leading = moved @ directions
    rest = np.maximum((moved * moved).sum(axis=1) - (leading * leading).sum(axis=1), 0)
    return np.column_stack([leading, np.sqrt(rest)])


def nearest(
    x: np.ndarray, p: np.ndarray, centroids: np.ndarray, projected: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance) of the nearest centroid per vector, and the pairs verified.

    Of centroids equally near, the one with the smallest number.
    """
    n = len(x)
    size, other = (p * p).sum(axis=1), (projected * projected).sum(axis=1)
    # The residual norm is one more coordinate: the bound is a distance itself.
    bound = size[:, None] + other - 2 * (p @ projected.T)
    # Far above the rounding errors of what went into the bound.
    bound -= 1e-6 + 1e-9 * (size[:, None] + other)
    exact = np.full(bound.shape, np.iinfo(np.int64).max)

    def verify(row: np.ndarray, number: np.ndarray) -> None:
        for start in range(0, len(row), PAIRS):
            i, j = row[start : start + PAIRS], number[start : start + PAIRS]
            apart = x[i] - centroids[j]
            exact[i, j] = np.einsum("ij,ij->i", apart, apart)

    every, first = np.arange(n), bound.argmin(axis=1)
    verify(every, first)
    survives = bound <= exact[every, first][:, None]
    survives[every, first] = False
    row, number = np.nonzero(survives)
    verify(row, number)
    best = exact.argmin(axis=1)
    return best, exact[every, best], n + len(row)


def _by_slice(
    dims: int, centroids: np.ndarray, mean: np.ndarray, directions: np.ndarray
) -> Callable[[pa.RecordBatch], Iterator[tuple]]:
    """Function from a batch (id, x, p) to (ids, vectors, numbers, distances) of its slices."""
    projected = project(centroids, mean, directions)

    def run(batch: pa.RecordBatch) -> Iterator[tuple]:
        for start in range(0, batch.num_rows, ROWS):
            ids, packed, coordinates = batch.slice(start, ROWS).columns
            x = _matrix(packed, "<i4", dims).astype(np.int64)
            p = _matrix(coordinates, "<f8", projected.shape[1])
            yield ids, x, *nearest(x, p, centroids, projected)[:2]

    return run


def moved_centroids(
    stored: DataFrame, centroids: np.ndarray, mean: np.ndarray, directions: np.ndarray
) -> np.ndarray:
    """Centroids after one round: floor of the exact mean of the vectors assigned to each."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _by_slice(dims, centroids, mean, directions)
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, x, best, _ in run(batch):
                np.add.at(total, best, x)
                count += np.bincount(best, minlength=k)
        used = np.flatnonzero(count)
        arrays = [pa.array(used, pa.int32()), pa.array(count[used])]
        arrays += [pa.array(np.ascontiguousarray(total[used, i])) for i in range(dims)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["cluster", "n", *[f"s{i}" for i in range(dims)]]
    schema = "cluster int, " + ", ".join(f"{c} long" for c in names[1:])
    # At most one row per task and centroid is shuffled, one per centroid comes back.
    per_cluster = stored.mapInArrow(sums, schema).groupBy("cluster").agg(
        *[F.sum(c).alias(c) for c in names[1:]]
    )
    after = centroids.copy()
    for row in per_cluster.collect():
        cluster, n, *total = row
        after[cluster] = [value // n for value in total]
    return after


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    *,
    dims: int = 64,
    k: int = 40,
    rounds: int = 5,
    scale: int = 256,
    seed: int = 2,
) -> DataFrame:
    """Per kept vector: key, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``dims`` components, none null or non-finite; each component
    x becomes floor(scale * x).  Vectors with a component beyond 2^25 after scaling, whose
    squared distances could leave 64 bits, are left out like non-finite ones.  Centroids
    start as the kept vectors with the ``k`` smallest hashes of ``<seed>:<key>``, in that
    order; each of ``rounds`` rounds assigns all vectors to the nearest centroid (ties: the
    smaller number) and moves every non-empty one to the floored mean of its vectors.

    Fewer than ``k`` vectors give fewer centroids.  A vector without a key is assigned like
    others but never starts a centroid; rows that repeat a key give a row each (equal hashes
    start in the order of their components), and an empty table gives no rows.  Extra
    columns are ignored.

    Vectors are quantised, rotated and stored once; a round reads them and shuffles one row
    of sums per task and centroid.  Only ``k`` rows and sums of ``dims`` squared numbers
    reach the driver, whatever the number of vectors.
    """
    kept = quantised(vectors, key, vector, dims, scale)
    centroids = first_centroids(kept, k, seed, dims)
    mean, directions = rotation(kept, dims) if len(centroids) else (np.zeros(dims), np.eye(dims))

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                ids, packed = batch.slice(start, ROWS).columns
                p = project(_matrix(packed, "<i4", dims), mean, directions)
                rows = pa.array([row.tobytes() for row in p], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, packed, rows], names=["id", "x", "p"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _by_slice(dims, centroids, mean, directions)
        for batch in batches:
            for ids, _, best, distance in run(batch):
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(best, pa.int32()), pa.array(distance)],
                    names=["id", "cluster", "distance"],
                )

    spark = vectors.sparkSession
    columns = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        # Without a key there is no centroid, and so no assignment.
        assigned, per_cluster = spark.createDataFrame([], "id long, cluster int, distance long"), []
    else:
        stored = materialize(kept.mapInArrow(rotate, "id long, x binary, p binary"), "rotated")
        for _ in range(rounds):
            centroids = moved_centroids(stored, centroids, mean, directions)
        assigned = materialize(stored.mapInArrow(assign, "id long, cluster int, distance long"), "assigned")
        per_cluster = assigned.groupBy("cluster").agg(F.sum("distance")).collect()
    inertia = sum(total for _, total in per_cluster)
    figures = [
        (number, total, inertia, hashlib.sha256(",".join(map(str, centroids[number].tolist())).encode()).hexdigest())
        for number, total in per_cluster
    ]
    # One row per centroid.
    figures = F.broadcast(spark.createDataFrame(figures, columns))
    (name,) = spare(figures, key) if key.lower() != "distance" else ("_distance",)
    return assigned.join(figures, "cluster").select(
        F.col("id").alias(name), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
