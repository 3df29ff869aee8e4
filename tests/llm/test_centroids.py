"""Centroid clustering against plain integer k-means."""

import hashlib
import math
import random

import numpy as np
import pytest

from tripmart.llm import centroids, queries


def plain(rows, dims=64, k=40, rounds=5, scale=256, seed=2):
    kept = []
    for key, vector in rows:
        if vector is not None and len(vector) == dims and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, [math.floor(scale * x) for x in vector]))
    name = lambda key: hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    named = sorted(((name(key), np.array(x, "<i4").tobytes(), x) for key, x in kept if key is not None))
    centers = [x for _, _, x in named[:k]]
    if not centers:
        return []

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for i, members in groups.items():
            centers[i] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    found = [(key, *nearest(x)) for key, x in kept]
    within = {}
    for _, d, i in found:
        within[i] = within.get(i, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((key, i, d, within[i], sum(within.values()), sha[i]) for key, d, i in found), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_plain_rounds(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    want = plain([(r.vec_id, r.embedding) for r in rows])
    assert got(queries.op11_rotated_centroids(spark, sf_dir)) == want


SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int, ID string, x int"


def messy_vectors(dims):
    """Whole numbers make ties; nulls, wrong lengths, NaN, repeated rows and keys."""
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(dims)]) for i in range(80)]
    rows += [(100 + i, [0.0] * dims) for i in range(40)]
    rows += [rows[3], rows[3], (3, [9.5] * dims), (None, [1.25] * dims), (None, None)]
    rows += [(200, None), (201, []), (202, [1.0] * (dims - 1)), (203, [1.0] * (dims + 1))]
    rows += [(204 + i, [bad] + [0.0] * (dims - 1)) for i, bad in enumerate((None, math.nan, math.inf, -math.inf))]
    return rows


@pytest.mark.parametrize(("dims", "k", "rounds"), [(1, 3, 2), (4, 7, 5), (20, 40, 3), (64, 40, 1)])
def test_messy_vectors(spark, dims, k, rounds):
    rows = messy_vectors(dims)
    df = spark.createDataFrame([(key, v, "c", 1, "i", 2) for key, v in rows], SCHEMA)
    assert got(centroids.cluster(df, dims=dims, k=k, rounds=rounds)) == plain(rows, dims, k, rounds)


def test_few_and_no_vectors(spark):
    few = [(7, [1.0, 2.0]), (8, [5.0, -2.0])]
    df = spark.createDataFrame(few, "vec_id long, embedding array<double>")
    assert got(centroids.cluster(df, dims=2)) == plain(few, 2)
    assert got(centroids.cluster(df, dims=3)) == []
    nameless = spark.createDataFrame([(None, [1.0, 2.0])], df.schema)
    assert got(centroids.cluster(nameless, dims=2)) == []
    huge = spark.createDataFrame([*few, (9, [1e30, 0.0])], df.schema)
    assert got(centroids.cluster(huge, dims=2)) == plain(few, 2)
    assert centroids.cluster(spark.createDataFrame([], df.schema), dims=2).columns[0] == "vec_id"


def test_bounds_spare_most_pairs_and_lose_none():
    rng = np.random.default_rng(1)
    centers = rng.normal(0, 200, (40, 64)).astype(int)
    spread = np.array([60] * 8 + [6] * 56)
    x = centers[rng.integers(0, 40, 3000)] + (rng.normal(0, 1, (3000, 64)) * spread).astype(int)
    mean = x.mean(axis=0)
    _, directions = np.linalg.eigh(np.cov(x.T))
    directions = directions[:, ::-1][:, : centroids.LEADING]
    projected = centroids.project(centers, mean, directions)
    best, distance, pairs = centroids.nearest(x, centroids.project(x, mean, directions), centers, projected)
    every = ((x[:, None, :] - centers) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert pairs < 0.1 * every.size
