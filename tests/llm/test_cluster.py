"""Centroid clustering, against exact distances to every centroid."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from talus.llm import cluster


def plain(rows, dims, scale, clusters, rounds, seed):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:clusters]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assign()
        for j in range(len(centroids)):
            members = [v for (_, v), (k, _) in zip(kept, own, strict=True) if k == j]
            if members:
                centroids[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    own = assign()
    each = {j: sum(d for k, d in own if k == j) for j in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, each[k], sum(each.values()), digest[k]) for (i, _), (k, d) in zip(kept, own, strict=True)), key=repr)


def vectors(n=120, dims=16, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(i % 3, 0.7, dims)]) for i in range(n)]
    rows[3] = (3, rows[4][1])
    rows[5] = (5, None)
    rows[6] = (6, rows[6][1][:-1])
    rows[7] = (7, rows[7][1][:-1] + [None])
    rows[8] = (8, rows[8][1][:-1] + [float("nan")])
    rows[9] = (9, rows[9][1][:-1] + [float("-inf")])
    rows[10] = (10, [0.0] * dims)
    rows[12] = (12, [])
    return rows + [rows[20], rows[20], (21, rows[22][1]), (None, rows[23][1]), (None, rows[23][1]), (None, None)]


@pytest.mark.parametrize("clusters, rounds, bits", [(7, 3, 5), (40, 2, 3), (1, 2, 8), (150, 1, 4)])
def test_equals_plain(spark, clusters, rounds, bits):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit("x") for c in ("v", "cluster", "distance", "codes", "length", "n")}).repartition(3)  # clashing names
    out = cluster.cluster(df, dims=16, scale=64, clusters=clusters, rounds=rounds, bits=bits)
    assert sorted(map(tuple, out.collect()), key=repr) == plain(rows, 16, 64, clusters, rounds, 2)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    for spread, bits in ((1, 2), (300, 5), (1 << 20, 7), (1 << 26, 5)):
        c = rng.integers(-spread, spread, (40, 64))
        x = c[rng.integers(0, 40, 500)] + rng.integers(-spread, spread, (500, 64)) // 4
        d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        packed = cluster.compress(x, 8, bits)
        assert (cluster.lower_bounds(packed, c) <= d).all()
        own, least, measured = cluster.nearest(x, packed, c)
        assert (own == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
        assert measured < 0.2 * d.size or bits == 2


def test_ties_and_empty(spark):
    df = spark.createDataFrame([(i, [0.5, -0.5] * 4) for i in range(30)], "vec_id long, embedding array<float>")
    out = cluster.cluster(df, dims=8, clusters=5, rounds=2).collect()
    assert len(out) == 30 and {(r["cluster"], r["distance"], r["inertia"]) for r in out} == {(0, 0, 0)}
    assert cluster.cluster(df.limit(0), dims=8).count() == 0
    assert cluster.cluster(df, dims=16).count() == 0


def test_out_of_range_is_an_error(spark):
    df = spark.createDataFrame([(1, [1e300] * 8)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        cluster.cluster(df, dims=8).count()
    with pytest.raises(ValueError):
        cluster.cluster(df, dims=9)
