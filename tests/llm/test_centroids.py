"""Clustering by bounds against plain rounds over all centroids."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import centroids, registry

SCHEMA = "vec_id long, embedding array<double>, id string, cluster string, v double"


def brute(rows, dims, k, rounds, scale=64):
    """(vec_id, cluster, distance, inertia of the cluster, inertia, digest) of each usable vector, in whole numbers."""
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "")
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    place = lambda: [min(range(len(centres)), key=lambda j: (far(v, centres[j]), j)) for _, v in kept]
    for _ in range(rounds):
        at = place()
        for j in range(len(centres)):
            mine = [v for (_, v), a in zip(kept, at, strict=True) if a == j]
            if mine:
                centres[j] = tuple(sum(x) // len(mine) for x in zip(*mine, strict=True))
    at = place()
    d = [far(v, centres[a]) for (_, v), a in zip(kept, at, strict=True)]
    own = [sum(x for x, b in zip(d, at, strict=True) if b == a) for a in at]
    return [(i, a, x, o, sum(d), hashlib.sha256(",".join(map(str, centres[a])).encode()).hexdigest()) for (i, _), a, x, o in zip(kept, at, d, own, strict=True)]


def result(spark, rows, **more):
    df = spark.createDataFrame([(i, v, "x", "y", 0.5) for i, v in rows], SCHEMA).repartition(3)
    state, centres = centroids.cluster(df, **more)
    got = centroids.described(state, centres)
    return sorted((tuple(r) for r in got.collect()), key=repr), state


@pytest.mark.parametrize("reach", [1.0, 1e5])
def test_rounds_with_odd_rows(spark, reach):
    """Nulls, wrong lengths, nan and infinity, repeated ids and vectors, ids that are null; large components take the whole-number path."""
    rng = np.random.default_rng(3)
    rows = [(int(i), (reach * rng.normal(size=6)).tolist()) for i in rng.integers(0, 200, 250)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(1100, [0.0] * 6), (1101, [-0.0] * 6), (None, [0.25] * 6), (None, None), (1102, None), (1103, []), (1104, [1.0] * 5)]
    rows += [(1105, [1.0] * 5 + [None]), (1106, [1.0] * 5 + [math.nan]), (1107, [1.0] * 5 + [-math.inf])]
    got, _ = result(spark, rows, k=9, rounds=4, dims=6)
    assert got == sorted(brute(rows, 6, 9, 4), key=repr)


def test_fewer_vectors_than_centroids_and_ties(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(7)]
    assert result(spark, rows, k=16, dims=2)[0] == sorted(brute(rows, 2, 16, 3), key=repr)
    rows = [(i, [1.0, 2.0]) for i in range(40)]
    assert result(spark, rows, k=5, dims=2)[0] == sorted(brute(rows, 2, 5, 3), key=repr)
    assert result(spark, [(1, None)], k=5, dims=2)[0] == []


def test_bounds_spare_scans(spark):
    """Of well separated groups nearly no vector is scanned again, and places are those of full scans."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=8) * 0.05 + 10 * np.eye(8)[i % 8]).tolist()) for i in range(800)]
    got, state = result(spark, rows, k=8, rounds=5, dims=8)
    assert got == sorted(brute(rows, 8, 8, 5), key=repr)
    assert state.agg(F.sum("scans")).first()[0] < 400


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        result(spark, [(1, [1e9, 0.0])], k=1, dims=2)


def test_query_on_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=64).astype(np.float32).astype(float).tolist()) for i in range(50)] + [(50, None), (51, [1.0]), (None, [0.5] * 64), (3, [0.5] * 64)]
    spark.createDataFrame([(i, v, "x", "y", 0.5) for i, v in rows], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = registry.QUERIES["op11_centroids"](spark, str(tmp_path)).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, 64, 16, 3), key=repr)
