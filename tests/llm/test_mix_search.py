"""Mixing and exact search."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from talus.llm import mixing, queries, topk
from tests.compare import rows, views
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    found, told = queries.QUERIES[name](spark, SMALL).toPandas(), views(SMALL).sql(queries.ORACLES[name]).df()
    assert sorted(found.columns) == sorted(told.columns) and rows(found) == rows(told)


def targets(sizes, weights=(1, 2, 3), repeats=3):
    """Shares by weight, the excess of full sources shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > repeats * sizes[s]]
        if not over:
            return full | share
        full |= {s: repeats * sizes[s] for s in over}


def test_targets_and_closeness(odd):
    out = mixing.mix(odd).collect()
    sizes, taken, most, spare = {}, {}, {}, {}
    source = {r["doc_id"]: r["source"] for r in odd.select("doc_id", "source").collect()}
    for r in out:
        s = source[r["doc_id"]] if r["doc_id"] is not None else ("a" if r["size"] else None)
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        most[s] = r["target"], r["source_size"]
        if r["size"] and r["copies"] < 3:
            spare.setdefault(s, []).append(r["size"])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    told = targets(sizes)
    for s, (target, size) in most.items():
        assert target == pytest.approx(told[s]) and size == sizes[s]
        assert abs(taken[s] - target) <= max(0.05 * target, min(spare.get(s, [0])) / 2)  # no document would bring it nearer


def test_reruns_agree_and_partitions_do_not_matter(odd):
    runs = [sorted((r["doc_id"], r["taken"]) for r in mixing.mix(odd.repartition(n)).filter("doc_id is not null").collect()) for n in (1, 5)]
    assert runs[0] == runs[1]


def test_full_sources_get_whole_copies(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, "c " * 1000, "y"), (3, "", "z")], "doc_id long, text string, source string")
    out = {r["doc_id"]: r for r in mixing.mix(df).collect()}
    assert out[1]["taken"] == 6 and out[1]["target"] == 6.0 and out[3]["target"] == 0.0 and out[3]["taken"] == 0


def expected(rows, target, repeats=3):
    """Mean copies by weight, by bisection. rows: size and weight."""
    low, high = 0.0, 1e6
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(n * min(repeats, level * w) for n, w in rows) < target else (low, level)
    return {w: min(repeats, high * w) for _, w in rows}


def test_inclusion_rates_are_the_fractions(spark):
    rng = random.Random(2)
    size = lambda: rng.choice([3, 9, 20, 40, 70, 150])
    df = spark.createDataFrame([(i, "a " * size(), "s" if i % 3 else "t") for i in range(12_000)], "doc_id long, text string, source string")
    out = mixing.mix(df, keep=("source",)).collect()
    for s in "st":
        own = [r for r in out if r["source"] == s]
        told = expected([(r["size"], r["size"].bit_length()) for r in own], own[0]["target"])
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 3
        for w, times in told.items():
            copies = np.array([r["copies"] for r in own if r["size"].bit_length() == w])
            assert set(copies.tolist()) <= {int(times + 1e-9), int(times + 1e-9) + 1}
            assert abs(copies.mean() - times) < 5 * 0.5 / len(copies) ** 0.5
        assert len({round(x, 6) for x in told.values()}) > 3


def test_weight_column(spark):
    df = spark.createDataFrame(
        [(i, "a " * 10, "s" if i % 2 else "t", 4.0 if i % 4 < 2 else 1.0) for i in range(4000)], "doc_id long, text string, source string, w double"
    )
    out = mixing.mix(df, weight="w", keep=("w",)).collect()
    for s in (0, 1):
        own = [r for r in out if r["doc_id"] % 2 == s]
        told = expected([(10, r["w"]) for r in own], own[0]["target"])
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 10
        assert all(abs(np.mean([r["copies"] for r in own if r["w"] == w]) - times) < 0.06 for w, times in told.items())
    with pytest.raises(ValueError):
        mixing.mix(df.withColumn("size", F.lit(1)), keep=("size",))


def test_mixing_empty_table(none):
    assert mixing.mix(none).count() == 0


def brute(vectors, k):
    ints = {
        i: [int(np.floor(1024 * float(np.float32(x)))) for x in v] for i, v in vectors
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    out = []
    for q in ints:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("seed, shard", [(0, 16), (1, 64)])
def test_search_equals_brute_force(spark, seed, shard):
    rng = random.Random(seed)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(300)]
    same = vectors[7][1]
    vectors += [(i, same) for i in range(300, 380)] + [
        (400, [0.5] * 3), (500, [0.1] * 3), (600, None), (700, [float("nan")] * 8), (800, [None] * 8), (900, [float("inf")] * 8), (None, same),
        vectors[5], vectors[0]
    ]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).repartition(3)
    found = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 100 == 0, k=5, shard_rows=shard, block_rows=2).collect()))
    assert found == brute({i: (i, v) for i, v in vectors}.values(), 5)


def test_shards_of_other_lengths_are_left_out(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, (rng.standard_normal(6) * (8 if i < 40 else 0.1)).tolist()) for i in range(400)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 100 == 0, k=3, shard_rows=8, block_rows=2).collect()))
    ints = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in vectors}
    told = []
    for q in range(0, 400, 100):
        best = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q)[:3]
        told += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert found == told
    big, small = (np.array([ints[i] for i in r], float) for r in (range(40), range(40, 400)))
    ball = lambda x: (x.mean(axis=0)[None], np.array([np.sqrt(((x - x.mean(axis=0)) ** 2).sum(axis=1)).max()]))
    q = ints[0][None].astype(float)
    assert topk.bounds(q, *ball(small))[0, 0] < -sorted(-q[0] @ big[1:].T)[2] <= topk.bounds(q, *ball(big))[0, 0]


def test_later_shards_start_from_scores_of_earlier_ones():
    search = topk._searching(2, False)
    table = lambda **c: topk.pa.table({k: topk.pa.array(v) for k, v in c.items()})
    q = table(block=[0], q_ids=[[7]], q_rows=[[1, 1]], scores=[[5, 4]], at=[[0]])
    one = search((topk.pa.scalar(2), 0, 0), q, table(c_ids=[[1, 2, 3]], c_rows=[[9, 9, 8, 8, 0, 1]]))
    assert sorted(one["scores"][0].as_py()) == [16, 18]
    two = search((topk.pa.scalar(2), 1, 0), q, table(c_ids=[[4, 5]], c_rows=[[3, 3, 8, 9]]))
    assert two["scores"][0].as_py() == [17]
    assert search((topk.pa.scalar(2), 2, 0), q, table(c_ids=[[6]], c_rows=[[8, 8]])).num_rows == 0


def test_search_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 1, 1024 * 1024 * 11)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_large_components_stay_exact(spark):
    df = spark.createDataFrame([(0, [3e5, 1.0]), (1, [3e5, 2.0]), (2, [3e5, 1.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in topk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [1, 2]
