"""Centroids against plain integer k-means, the lossless encoding, and edges."""

import hashlib
import math

import numpy as np
import pytest

from carestrata.llm import centroids

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k, rounds, dims, seed=3):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) with Python integers."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x):
            kept.append((vec_id, [math.floor(1024 * float(np.float32(v))) for v in x]))
    named = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centres = [list(x) for _, x in sorted(kept, key=named)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for i, xs in groups.items():
            centres[i] = [sum(column) // len(xs) for column in zip(*xs)]
    found = [(vec_id, *nearest(x)) for vec_id, x in kept]
    held = {}
    for _, distance, i in found:
        held[i] = held.get(i, 0) + distance
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((v, i, d, held[i], sum(held.values()), digest[i]) for v, d, i in found), key=repr)


def random_rows(dims, n=300):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(0, 0.02 if i % 2 else 0.3, dims)]) for i in range(n)]
    rows += [rows[5], rows[5], (7, rows[9][1]), (None, rows[3][1]), (900, None), (901, []), (902, [0.0] * (dims + 1))]
    rows += [(903, [math.nan] * dims), (904, [math.inf] + [0.0] * (dims - 1)), (905, [None] + [0.0] * (dims - 1)), (906, [0.5] * dims)]
    return rows


@pytest.mark.parametrize("width, chunk", [(2, 8192), (1, 50), (3, 7), (64, 100_000)])
def test_against_plain_integers(spark, width, chunk):
    rows = random_rows(7)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS x", "1 AS cluster", "2 AS ids").repartition(3)
    out = centroids.cluster(df, k=8, rounds=10, dims=7, width=width, chunk=chunk)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == plain(rows, 8, 10, 7)


def test_encoding_is_lossless():
    rng = np.random.default_rng(1)
    values = rng.integers(-(2**26), 2**26, (500, 3))
    values[100:400] = values[:300]
    seen, codes = centroids.encode_block(values)
    assert len(seen) == 400 and (seen[codes] == values).all()
    assert [tuple(v) for v in seen] == sorted({tuple(v) for v in values})


def test_few_and_no_vectors(spark):
    rows = [(1, [0.25, -0.25]), (2, [0.25, -0.25]), (3, [-1.0, 1.0])]
    out = centroids.cluster(spark.createDataFrame(rows, SCHEMA), k=8, rounds=3, dims=2)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == plain(rows, 8, 3, 2)
    assert centroids.cluster(spark.createDataFrame([], SCHEMA)).count() == 0
    assert centroids.cluster(spark.createDataFrame(rows, SCHEMA)).count() == 0  # none has 64 components


def test_components_too_large_for_a_long(spark):
    with pytest.raises(Exception, match="a component exceeds"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0])], SCHEMA), dims=2).count()
