"""Exact top-k inner products by ball trees.

Candidates lie in shards of bounded size: classes of vectors of about one length, split by a hash of the id. Each has a ball tree.
Queries come in blocks. A block first meets the shard whose root ball allows it the highest score; that gives each query k scores.
A shard is left out for all queries whose kth score lies above the bound of its root ball, query times centre plus length of the
query times radius, and only the pairs of shards and blocks that are left are brought together. Inside a shard, nodes are visited in
the order of their bounds, and left out for queries whose kth score lies above. The kth score is shared: by the nodes of a tree, and by
all shards that a task searches, each of which starts from the best scores that the task has seen for the block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talus.llm.common import prepare, staged

K, SCALE, SHARD, BLOCK, LEAF = 10, 1024, 4096, 256, 64
#: Balls that a block is compared with at once, blocks that share a copy of a shard, and blocks whose scores a task remembers.
BALLS, SLICE, KNOWN = 512, 64, 2048
LOWEST = np.iinfo(np.int64).min


class BallTree:
    """rows: integer vectors as float64 where all products are exact, else as int64."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.root = self._node(np.arange(len(ids)))

    def _node(self, at: np.ndarray):
        x = self.rows[at].astype(np.float64)
        centre = x.mean(axis=0)
        far = np.sqrt(((x - centre) ** 2).sum(axis=1))
        radius = float(far.max())
        if len(at) <= LEAF or radius == 0:
            return centre, radius, at, None
        one = x[far.argmax()]
        to_one = ((x - one) ** 2).sum(axis=1)
        gap = to_one - ((x - x[to_one.argmax()]) ** 2).sum(axis=1)
        half = np.argsort(gap, kind="stable")
        return centre, radius, None, (self._node(at[half[: len(at) // 2]]), self._node(at[half[len(at) // 2 :]]))

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the best k for each query, worst places LOWEST; candidates below ``least`` may be missing."""
        score, who, least = np.full((len(ids), k), LOWEST), np.full((len(ids), k), np.iinfo(np.int64).max), least.copy()
        as_float = queries.astype(np.float64)

        def bound(node, q):
            return bounds(as_float[q], node[0][None, :], np.array([node[1]]))[:, 0]

        def visit(node, q):
            q = q[bound(node, q) >= least[q]]
            if not len(q):
                return
            if node[3] is not None:
                for child in sorted(node[3], key=lambda c: -bound(c, q).max()):
                    visit(child, q)
                return
            found = (queries[q] @ self.rows[node[2]].T).astype(np.int64)
            them = self.ids[node[2]]
            found[ids[q][:, None] == them[None, :]] = LOWEST
            live = (found >= least[q][:, None]).any(axis=1)
            q, found = q[live], found[live]
            if len(q):
                s, w = np.concatenate([score[q], found], axis=1), np.concatenate(
                    [who[q], np.where(found == LOWEST, np.iinfo(np.int64).max, them[None, :])], axis=1
                )
                order = np.lexsort((w, ~s))[:, :k]
                score[q], who[q] = np.take_along_axis(s, order, 1), np.take_along_axis(w, order, 1)
                least[q] = np.maximum(least[q], score[q][:, -1])

        visit(self.root, np.arange(len(ids)))
        return score, who


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as double; null if the vector or a component is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))


def _matrix(column: pa.ListArray, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    most = (np.abs(a).max(initial=0) * 1.0) * (np.abs(b).max(initial=0) * 1.0) * max(1, a.shape[1])
    return (a.astype(np.float64), b.astype(np.float64)) if most < 2**52 else (a, b)


def bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """For each query and ball the highest inner product that a vector inside may have."""
    top = queries @ centres.T + np.sqrt((queries**2).sum(axis=1))[:, None] * radii
    return top + 1e-9 * np.abs(top) + 1e-3  # room for rounding


def _balls(batches):
    """A shard's root ball."""
    for b in batches:
        centres, radii = [], []
        for i in range(b.num_rows):
            x = _matrix(b["c_rows"].slice(i, 1), len(b["c_ids"].slice(i, 1).flatten())).astype(np.float64)
            centres.append(x.mean(axis=0))
            radii.append(float(np.sqrt(((x - centres[-1]) ** 2).sum(axis=1)).max()))
        yield pa.RecordBatch.from_arrays(
            [b["dim"], b["shard"], pa.array([c.tolist() for c in centres], pa.list_(pa.float64())), pa.array(radii, pa.float64())],
            names=["dim", "shard", "centre", "radius"]
        )


def _meetings(k: int):
    """Blocks with balls: with scores, the shards that some query's bound still allows, and those queries' places; without, the shard of the highest bound."""

    def of(batches):
        for b in batches:
            out = []
            for i in range(b.num_rows):
                row = {c: b[c].slice(i, 1) for c in b.schema.names}
                n, shards = len(row["q_ids"].flatten()), row["shards"].flatten().to_numpy()
                top = bounds(_matrix(row["q_rows"], n).astype(np.float64), _matrix(row["centres"], len(shards)), row["radii"].flatten().to_numpy())
                dim, block = row["dim"][0].as_py(), row["block"][0].as_py()
                if k:
                    least = row["scores"].flatten().to_numpy().reshape(n, k)[:, -1]
                    live = (top >= least[:, None]) & (shards != row["home"][0].as_py())[None, :]
                    out += [(dim, block, int(shards[j]), 0.0, np.flatnonzero(live[:, j]).tolist()) for j in np.flatnonzero(live.any(axis=0))]
                else:
                    best = top.max(axis=0)
                    out.append((dim, block, int(shards[best.argmax()]), float(best.max()), []))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["dim", "block", "shard", "top", "at"])

    return of


def _searching(k: int, first: bool):
    """Searches a shard for blocks of queries."""
    known: dict[tuple, np.ndarray] = {}  # the best scores that this task has seen, by block

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        columns = {"block": pa.int32(), "q_ids": pa.list_(pa.int64()), "who": pa.list_(pa.int64()), "scores": pa.list_(pa.int64())}
        out = []
        if left.num_rows and right.num_rows:
            row = {c: right[c].combine_chunks().slice(0, 1) for c in ("c_ids", "c_rows")}
            c_ids = row["c_ids"].flatten().to_numpy()
            rows, trees = _matrix(row["c_rows"], len(c_ids)), {}
            left = left.combine_chunks()
            for i in range(left.num_rows):
                one = {c: left[c].combine_chunks().slice(i, 1) for c in left.column_names}
                ids, block = one["q_ids"].flatten().to_numpy(), one["block"][0].as_py()
                queries = _matrix(one["q_rows"], len(ids))
                c, q = _exact(rows, queries)
                if c.dtype not in trees:
                    trees[c.dtype] = BallTree(c_ids, c)
                if first:
                    at, before = np.arange(len(ids)), np.full((len(ids), k), LOWEST)
                else:
                    at = one["at"].flatten().to_numpy()
                    before = known.pop((key[0].as_py(), block), None)
                    if before is None:
                        before = one["scores"].flatten().to_numpy().reshape(-1, k)
                score, who = trees[c.dtype].search(ids[at], q[at], k, before[at, -1])
                if first:
                    out.append((block, np.repeat(ids, k).tolist(), who.ravel().tolist(), score.ravel().tolist()))
                    continue
                good = (score > LOWEST) & (score >= before[at, -1][:, None])
                if good.any():
                    r, place = np.nonzero(good)
                    out.append((block, ids[at[r]].tolist(), who[r, place].tolist(), score[r, place].tolist()))
                    before = before.copy()
                    before[at] = np.sort(np.concatenate([before[at], score], axis=1), axis=1)[:, : -k - 1 : -1]
                known[key[0].as_py(), block] = before
                if len(known) > KNOWN:
                    known.pop(next(iter(known)))
        cols = list(zip(*out, strict=True)) or [[]] * len(columns)
        dim = pa.array([key[0].as_py()] * len(out), pa.int32())
        return pa.table([dim, *[pa.array(c, t) for c, t in zip(cols, columns.values(), strict=True)]], names=["dim", *columns])

    return search


def top_k(
    vectors: DataFrame, query: Column, vector: str = "embedding", vec_id: str = "vec_id", k: int = K, scale: int = SCALE,
    shard_rows: int = SHARD, block_rows: int = BLOCK,
) -> DataFrame:
    """query_id, rank from 1, vec_id and score: for each row where query holds its k highest inner products of integer parts.

    A row's own id is never among its results. Ties go to the smaller id. Rows with a null id, a null vector, or a null or
    non-finite component take no part; vectors meet those of their own length only. Rows that repeat an id and its vector count
    once. Scores are exact as long as they fit 64 bits. An empty table gives an empty result.
    """
    prepare(vectors.sparkSession)
    rows = vectors.select(
        vectors[vec_id].cast("long").alias("id"), query.alias("_query"), integers(vectors[vector], scale).alias("v")
    ).filter("id is not null and v is not null")
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = staged(rows.select("id", "_query", "v", F.size("v").alias("dim"), F.floor(F.log2(length + 1) * 4).cast("int").alias("_class")), "vectors")
    sizes = rows.groupBy("dim", "_class").agg(F.count("*").alias("n"), F.count_if("_query").alias("q"))
    sizes = staged(sizes.withColumn("_parts", F.ceil(F.col("n") / shard_rows)), "sizes")  # a row for each quarter of a doubling of length
    total = sizes.agg(F.coalesce(F.sum("_parts"), F.lit(0)), F.coalesce(F.sum("q"), F.lit(0))).first()
    groups, blocks = max(1, -(-total[0] // BALLS)), max(1, -(-total[1] // block_rows))
    slices = -(-blocks // SLICE)
    bucket = lambda c, n: F.pmod(F.xxhash64(c), n)
    packed = lambda df, name: df.groupBy("dim", name).agg(F.collect_set(F.struct("id", "v")).alias("rows"))
    split = lambda name: [F.col("rows.id").alias(f"{name}_ids"), F.flatten("rows.v").alias(f"{name}_rows")]
    shard = (F.shiftleft(F.col("_class").cast("long"), 32) + bucket("id", F.col("_parts"))).alias("shard")
    candidates = staged(
        packed(
            rows.join(sizes.select("dim", "_class", "_parts"), ["dim", "_class"]).select("dim", shard, "id", "v"), "shard"
        ).select("dim", "shard", *split("c")),
        "shards"
    )
    asked = staged(
        packed(
            rows.filter("_query").select("dim", bucket("id", F.lit(blocks)).cast("int").alias("block"), "id", "v"), "block"
        ).select("dim", "block", *split("q")),
        "blocks"
    )

    balls = candidates.mapInArrow(
        _balls, "dim int, shard long, centre array<double>, radius double"
    ).withColumn("group", bucket("shard", F.lit(groups)).cast("int"))
    balls = balls.groupBy("dim", "group").agg(F.collect_list(F.struct("shard", "centre", "radius")).alias("b"))
    balls = staged(
        balls.select("dim", "group", F.col("b.shard").alias("shards"), F.flatten("b.centre").alias("centres"), F.col("b.radius").alias("radii")),
        "balls"
    )
    every = lambda df: df.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(balls, ["dim", "group"])
    met, found = "dim int, block int, shard long, top double, at array<int>", "dim int, block int, q_ids array<long>, who array<long>, scores array<long>"

    def searched(pairs: DataFrame, first: bool) -> DataFrame:
        pairs = pairs.withColumn("slice", F.pmod("block", F.lit(slices)))
        copies = candidates.join(pairs.select("dim", "shard", "slice").distinct(), ["dim", "shard"])
        copies = copies.select(*[F.col(c).alias(c) for c in copies.columns])  # columns of their own beside those of pairs
        keys = ["dim", "shard", "slice"]
        return pairs.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(_searching(k, first), found)

    home = every(asked).mapInArrow(_meetings(0), met).groupBy("dim", "block").agg(F.max_by("shard", "top").alias("shard"))
    home = staged(home, "home")
    start = staged(searched(asked.join(home, ["dim", "block"]), True), "first")
    ready = asked.join(start.select("dim", "block", "scores"), ["dim", "block"]).join(home.withColumnRenamed("shard", "home"), ["dim", "block"])
    pairs = staged(every(ready).mapInArrow(_meetings(k), met).select("dim", "block", "shard", "at"), "pairs")
    rest = searched(pairs.join(ready.drop("home"), ["dim", "block"]), False)
    each = start.unionByName(rest).select(F.explode(F.arrays_zip("q_ids", "who", "scores")).alias("x")).filter(F.col("x.scores") > int(LOWEST))
    each = each.select(F.col("x.q_ids").alias("query_id"), F.col("x.who").alias("vec_id"), F.col("x.scores").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return each.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
