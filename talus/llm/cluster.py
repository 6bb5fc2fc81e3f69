"""Centroid clustering of integer vectors, with block-norm screening.

Vectors are compressed once: each segment of components becomes signed codes of a few bits with a scale, and the norm of what the
codes leave over is stored beside them. In a round, the codes times the centroids give approximate inner products, and by the
inequality of Cauchy and Schwarz, segment by segment, the remainders can add at most the product of the norms. That is a lower bound
of every distance. The centroid with the least bound is measured exactly, and so is every other one whose bound isn't above that
distance; the rest are pruned. Distances, sums and centroids are exact integers.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.llm.common import prepare, staged

#: Fixed values of the registered query.
DIMS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 256, 40, 5, 2
SEGMENT, BITS, PAIRS = 8, 5, 1 << 16
#: Components beyond this have squared distances that 64 bits may not hold.
LARGEST = 1 << 27


def integers(vector: Column, dims: int, scale: int) -> Column:
    """floor(scale * x) of each component as double; null where the vector doesn't take part."""
    fine = (F.size(vector) == dims) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    beyond = F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}"))
    wide = F.exists(vector, lambda x: F.abs(x.cast("double") * F.lit(float(scale))) > F.lit(float(LARGEST)))
    return F.when(fine, F.when(wide, beyond.cast("array<bigint>")).otherwise(scaled))


class Compressed(NamedTuple):
    """Of n vectors: codes (n, dims), a scale and a norm of the remainder for each segment, and the squared length."""

    codes: np.ndarray
    scale: np.ndarray
    left: np.ndarray
    length: np.ndarray


def compress(x: np.ndarray, segment: int = SEGMENT, bits: int = BITS) -> Compressed:
    n, dims = x.shape
    parts = x.reshape(n, dims // segment, segment).astype(np.float64)
    scale = np.maximum(np.abs(parts).max(axis=2), 1) / ((1 << bits - 1) - 1)
    scale = scale.astype(np.float32).astype(np.float64)
    codes = np.rint(parts / scale[:, :, None])
    left = np.sqrt(((parts - codes * scale[:, :, None]) ** 2).sum(axis=2))
    return Compressed(codes.astype(np.int8).reshape(n, dims), scale.astype(np.float32), np.nextafter(left.astype(np.float32), np.float32(np.inf)), (x * x).sum(axis=1))


def lower_bounds(of: Compressed, centroids: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Below every squared distance, rounding included."""
    n, dims = of.codes.shape
    near = (of.codes.reshape(n, -1, segment) * of.scale.astype(np.float64)[:, :, None]).reshape(n, dims)
    c = centroids.astype(np.float64)
    norms = np.sqrt((c.reshape(len(c), -1, segment) ** 2).sum(axis=2))
    sizes = of.length.astype(np.float64)[:, None] + (c * c).sum(axis=1)[None, :]
    return sizes - 2 * (near @ c.T + of.left.astype(np.float64) @ norms.T) - 1e-9 * sizes - 1e-6


def nearest(x: np.ndarray, of: Compressed, centroids: np.ndarray, segment: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, int]:
    """Each vector's centroid (ties: the smaller number), its exact distance, and how many distances were measured."""
    low = lower_bounds(of, centroids, segment)
    guess = low.argmin(axis=1)
    gap = x - centroids[guess]
    known = (gap * gap).sum(axis=1)
    row, column = np.nonzero(low <= known[:, None])  # by row, then by number
    distance = np.empty(len(row), np.int64)
    for at in range(0, len(row), PAIRS):
        gap = x[row[at : at + PAIRS]] - centroids[column[at : at + PAIRS]]
        distance[at : at + PAIRS] = (gap * gap).sum(axis=1)
    starts = np.searchsorted(row, np.arange(len(x)))  # each row has its guess at least
    least = np.minimum.reduceat(distance, starts)
    hit = np.flatnonzero(distance == least[row])
    first = hit[np.searchsorted(row[hit], np.arange(len(x)))]
    return column[first], least, len(row) + len(x)


def _packing(segment: int, bits: int):
    def of(batches):
        for b in batches:
            x = b["v"].flatten().to_numpy().reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, segment), np.int64)
            c = compress(x, segment, bits)
            packed = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
            wide = np.int16 if np.abs(x).max(initial=0) < 1 << 15 else np.int32
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], packed(x.astype(wide)), packed(c.codes), packed(c.scale), packed(c.left), pa.array(c.length, pa.int64())],
                names=["vec_id", "v", "codes", "scale", "left_over", "length"]
            )

    return of


def _matrix(column: pa.Array, kind) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _unpacked(b: pa.RecordBatch) -> tuple[np.ndarray, Compressed]:
    codes = _matrix(b["codes"], np.int8)
    dims = codes.shape[1]
    rows = b["v"].to_pylist()
    x = np.stack([np.frombuffer(r, np.int16 if len(r) == 2 * dims else np.int32) for r in rows]).astype(np.int64)
    return x, Compressed(codes, _matrix(b["scale"], np.float32), _matrix(b["left_over"], np.float32), b["length"].to_numpy())


def _summing(centroids: np.ndarray, segment: int):
    """For each centroid that a task's vectors chose: their number and their sums."""

    def of(batches):
        k, dims = centroids.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            if b.num_rows:
                x, c = _unpacked(b)
                own = nearest(x, c, centroids, segment)[0]
                count += np.bincount(own, minlength=k)
                order = np.argsort(own, kind="stable")
                chosen, starts = np.unique(own[order], return_index=True)
                total[chosen] += np.add.reduceat(x[order], starts, axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(count[used], pa.int64()), pa.array(total[used].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"]
        )

    return of


def _assigning(centroids: np.ndarray, segment: int):
    def of(batches):
        for b in batches:
            own, distance = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if b.num_rows:
                own, distance, _ = nearest(*_unpacked(b), centroids, segment)
            yield pa.RecordBatch.from_arrays([b["vec_id"], pa.array(own, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return of


def cluster(
    vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", dims: int = DIMS, scale: int = SCALE, clusters: int = CLUSTERS,
    rounds: int = ROUNDS, seed: int = SEED, segment: int = SEGMENT, bits: int = BITS
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 for every row that takes part.

    A row takes part if its vector has exactly ``dims`` components (a multiple of ``segment``), none null or not finite. Centroids
    start as the vectors with the least hashes of seed and id: a null id counts as the empty text, and rows that share an id are told
    apart by their vectors, so equal rows can start as equal centroids, of which the smaller number gets all. Fewer rows than
    ``clusters`` give as many centroids as rows. Ties go to the smaller number. Repeated rows come back as often as they are there. A
    component whose integer is beyond 2^27 is an error. Other columns are not read, whatever their names. An empty table gives an
    empty result. The driver holds the centroids and, each round, their new sums: clusters times dims numbers.
    """
    if dims % segment:
        raise ValueError(f"{dims} components can't be cut into segments of {segment}")
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(vectors[vec_id].alias("vec_id"), integers(vectors[vector], dims, scale).alias("v")).filter("v is not null")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = rows.select(key.alias("_key"), "v").orderBy("_key", "v").limit(clusters).collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(len(first), dims)
    id_type = vectors.schema[vec_id].dataType
    packed = T.StructType([T.StructField("vec_id", id_type)]).add("v", "binary").add("codes", "binary").add("scale", "binary")
    packed = packed.add("left_over", "binary").add("length", "long")
    ready = staged(rows.mapInArrow(_packing(segment, bits), packed), "compressed")
    if len(first):
        for _ in range(rounds):
            found = ready.mapInArrow(_summing(centroids, segment), "cluster int, n bigint, sums array<bigint>")
            each = found.select("cluster", "n", F.posexplode("sums").alias("place", "x"))
            sums = each.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
            centroids = centroids.copy()
            for r in sums.collect():  # a number for each component of each centroid
                centroids[r["cluster"], r["place"]] = r["x"] // r["n"]
    out = T.StructType([T.StructField("vec_id", id_type)]).add("cluster", "integer").add("distance", "long")
    own = staged(ready.mapInArrow(_assigning(centroids, segment), out), "assigned")
    digest = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    each = own.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    digests = spark.createDataFrame(digest, "cluster int, centroid_sha256 string")
    of_cluster = each.join(F.broadcast(digests), "cluster")  # a row for each centroid
    whole = own.agg(F.sum("distance").alias("inertia"))
    return own.join(F.broadcast(of_cluster), "cluster").crossJoin(F.broadcast(whole)).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _oracle(rounds: int = ROUNDS) -> str:
    """All rounds unrolled."""
    parts = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), v) - 1)::INTEGER AS cluster, v AS c FROM v
  ORDER BY sha256('2:' || vec_id::VARCHAR), v LIMIT 40)""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, cluster, d FROM (
    SELECT v.r, v.vec_id, v.v, c.cluster, list_sum(list_transform(list_zip(v.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM v CROSS JOIN c{i} c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1)""")
        if i < rounds:
            parts.append(f"""e{i} AS (
  SELECT cluster, place, ((s - ((s % n) + n) % n) // n)::BIGINT AS x FROM (
    SELECT cluster, place, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i})
    GROUP BY cluster, place))""")
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(n.c, c.c) AS c FROM c{i} c LEFT JOIN (SELECT cluster, list(x ORDER BY place) AS c FROM e{i} GROUP BY cluster) n
    ON c.cluster = n.cluster)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, a.cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
  sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.cluster
"""


ORACLE = _oracle()
