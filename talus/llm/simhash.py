"""SimHash near-dedup: an exact comparison of all fingerprints, tile by tile.

Distinct fingerprints lie in classes by the population counts of their four 16-bit quarters. The counts of two fingerprints
differ in sum by no more than their Hamming distance, so only tiles of classes within the radius of each other meet; all
other pairs of tiles are skipped without being read. A pair of tiles is compared by numpy exclusive-or and bit counts, and
hands on a spanning forest of its links, never all of them. Components come from rounds of contraction in which each node
joins the neighbour of least priority, or stays; every round is written to the shared folder.

With ``similarity``, links are pairs of texts whose sets of shingles have that Jaccard similarity or more. Links of fingerprints
are candidates then, beside those of min-hash bands, which catch the similar pairs that differ in more bits. What meets in a
band is compared there by signatures, so that texts which share no more than a passage aren't candidates. Candidates are gathered
in coarse components; within each, all pairs are compared by their whole sets, tile by tile.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.llm import jaccard
from talus.llm.common import prepare, split_words, staged

SEED, SHINGLE, RADIUS, TILE = 42, 3, 3, 4096
#: Nodes of a tile of sets: components up to the first number are one tile, larger ones up to eight, then tiles hold the second number.
SMALL, LARGE = 64, 1024
_STEP = 1 << 15


def majority(h: np.ndarray) -> int:
    """64 bits: each 1 if set in over half the hashes."""
    count = np.zeros(64, np.int64)
    for at in range(0, len(h), _STEP):
        bits = np.unpackbits(h[at : at + _STEP].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view("<u8")[0])


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits: each 1 if set in over half the shingles' hashes; 0 for a text without words."""
    words = [w.lower() for w in split_words(text)]
    if not words:
        return 0
    grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))) if len(words) >= shingle else [b" ".join(words)]
    return majority(np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), np.uint64, len(grams)))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fp, the fingerprint's 64 bits as a long, for every row."""
    prepare(docs.sparkSession)

    def of(batches):
        for b in batches:
            fp = np.array([simhash(t, shingle, seed) for t in b["_text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("fp", T.LongType())])
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("_text")).mapInArrow(of, schema)


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between n nodes, reduced to one from each node to the least of its component."""
    least = np.arange(n)
    while True:
        before, low = least.copy(), np.minimum(least[i], least[j])
        np.minimum.at(least, i, low)
        np.minimum.at(least, j, low)
        least = least[least]
        if (least == before).all():
            node = np.flatnonzero(least != np.arange(n))
            return node, least[node]


def links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (x, y) that connect just what is connected by links between the tiles a and b; a may be b."""
    nodes, step = np.concatenate([a, b]), max(1, (1 << 20) // max(1, len(b)))
    i, j = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(a), step):
        x, y = np.nonzero(np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius)
        i, j = np.concatenate([i, x + at]), np.concatenate([j, y + len(a)])
        if len(i) > len(nodes):
            i, j = forest(i, j, len(nodes))
    x, y = nodes[i], nodes[j]
    return x[x != y], y[x != y]


def _quarters(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * q).bitwiseAND(F.lit(0xFFFF))) for q in range(4)]


def linked(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Of a column fp of distinct fingerprints: pairs u, v that connect all that links at radius bits connect."""
    spark = distinct.sparkSession
    code = [f"q{q}" for q in range(4)]
    classed = distinct.select("fp", *[c.cast("int").alias(f"q{i}") for i, c in enumerate(_quarters(F.col("fp")))])
    sizes = classed.groupBy(*code).agg(F.ceil(F.count("*") / tile).alias("parts"))  # 17**4 classes at most
    tiles = (
        classed.join(F.broadcast(sizes), code)
        .groupBy(*code, F.pmod(F.xxhash64("fp"), "parts").alias("part"))
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    )
    tiles = staged(tiles.withColumn("tile", F.xxhash64(*code, "part")), "tiles")
    steps = [s for s in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]
    step = F.explode(F.array(*[F.array(*map(F.lit, s)) for s in steps])).alias("step")
    # which tiles meet is settled by their classes; fingerprints come in where two do
    near = tiles.select(*code, F.col("part").alias("part_a"), F.col("tile").alias("tile_a"), step)
    near = near.select(
        "part_a", "tile_a", (F.expr("step = array(0, 0, 0, 0)")).alias("same"), *[(F.col(c) + F.col("step")[i]).alias(c) for i, c in enumerate(code)]
    )
    near = near.filter(" and ".join(f"{c} between 0 and 16" for c in code))
    met = near.join(tiles.select(*code, "part", "tile"), code).filter("not same or part_a <= part").select("tile_a", "tile")
    pairs = met.join(
        tiles.select(F.col("tile").alias("tile_a"), F.col("fps").alias("a")), "tile_a"
    ).join(tiles.select("tile", F.col("fps").alias("b")), "tile").select("a", "b")

    def of(batches):
        for batch in batches:
            (a, ia), (b, ib) = ((c.values.to_numpy().view(np.uint64), c.offsets.to_numpy()) for c in (batch["a"], batch["b"]))
            out = [links(a[ia[k] : ia[k + 1]], b[ib[k] : ib[k + 1]], radius) for k in range(batch.num_rows)]
            out = [x for x in out if len(x[0])]
            if out:
                u, v = (np.concatenate(x).view(np.int64) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    prepare(spark)
    return pairs.mapInArrow(of, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """node and label, the same for all nodes of a component; only nodes with an edge to another have a row.

    In every second round priorities are the nodes themselves, so that stars around their least node, which is how groups come,
    are one node after the first; in the others they are random, so that paths get shorter by a share whatever their order.
    """
    edges = staged(edges.select("u", "v").distinct(), "edges")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        turn = len(rounds)
        order = lambda c: F.struct((F.xxhash64(F.lit(turn), c) if turn % 2 else c).alias("p"), c.alias("x"))  # noqa: E731, B023
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joins = staged(
            both.groupBy("u").agg(F.min(order(F.col("v"))).alias("to")).select("u", F.least(order(F.col("u")), F.col("to"))["x"].alias("to")), "joins"
        )
        side = lambda c: joins.select(F.col("u").alias(c), F.col("to").alias(f"{c}_to"))  # noqa: E731, B023
        moved = edges.join(side("u"), "u").join(side("v"), "v").filter("u_to <> v_to")
        edges = staged(moved.select(F.least("u_to", "v_to").alias("u"), F.greatest("u_to", "v_to").alias("v")).distinct(), "edges")
        rounds.append(joins)
    if not rounds:
        return edges.sparkSession.createDataFrame([], "node long, label long")
    label = rounds[0].select(F.col("u").alias("node"), F.col("to").alias("label"))
    for joins in rounds[1:]:
        label = label.join(joins.select(F.col("u").alias("label"), "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return staged(label, "label")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, seed: int = SEED, radius: int = RADIUS,
    similarity: float | None = None,
) -> DataFrame:
    """doc_id, fp (a long) and component_id, the least id among documents that links reach; one row for each input row.

    Links: fingerprints of radius bits or fewer, or with similarity (0.8 or more for the bands' share of misses) sets of shingles
    that are so similar. A null text counts as empty; texts without words have fingerprint 0 and link like others. Fewer words
    than a shingle: one shingle of all. Rows with a null id are members but never name a component, unless all ids of it are
    null: then it is null. Repeated rows are members each. An empty table gives an empty result.
    """
    if similarity is None:
        each = staged(fingerprints(docs, text, doc_id, shingle, seed), "simhash").withColumn("node", F.col("fp"))
        label = components(linked(each.select("fp").distinct(), radius))
    else:
        each, label = _similar(docs, text, doc_id, shingle, radius, similarity)
    nodes = each.groupBy("node").agg(F.min("doc_id").alias("first"))
    nodes = staged(nodes.join(label, "node", "left").select("node", "first", F.coalesce("label", "node").alias("label")), "nodes")
    named = staged(
        nodes.groupBy("label").agg(F.min("first").alias("component_id")), "named"
    )  # so that Spark can split the join of a label that many nodes have
    return each.join(nodes.join(named, "label").select("node", "component_id"), "node").select("doc_id", "fp", "component_id")


def _similar(docs: DataFrame, text: str, doc_id: str, shingle: int, radius: int, least: float) -> tuple[DataFrame, DataFrame]:
    """doc_id, node (of equal sets) and fp of each row, and labels of nodes that links of similarity least or more connect."""
    prepare(docs.sparkSession)
    key = F.xxhash64(docs[doc_id], docs[text]).alias("_key")

    def of(batches):
        for b in batches:
            found = [jaccard.shingles(t, shingle) for t in b["_text"].to_pylist()]
            low = [jaccard.minima(x) for x in found]
            marks = np.concatenate([jaccard.bands(x) for x in low] or [np.zeros(0, np.uint64)]).view(np.int64)
            signs = pa.array([x.astype(np.uint8).tobytes() for x in low], pa.binary())
            nodes = np.array([jaccard.node_of(x) for x in found], np.uint64).view(np.int64)
            fps = np.array([majority(x) for x in found], np.uint64).view(np.int64)
            bounds = pa.array(np.arange(len(found) + 1, dtype=np.int32) * jaccard.BANDS)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["_key"], pa.array(nodes), pa.array(fps), pa.ListArray.from_arrays(bounds, pa.array(marks)), signs],
                names=["doc_id", "_key", "node", "fp", "bands", "signs"]
            )

    kinds = {"_key": T.LongType(), "node": T.LongType(), "fp": T.LongType(), "bands": T.ArrayType(T.LongType()), "signs": T.BinaryType()}
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *[T.StructField(c, k) for c, k in kinds.items()]])
    each = staged(docs.select(docs[doc_id].alias("doc_id"), key, docs[text].alias("_text")).mapInArrow(of, schema), "shingles")
    once = staged(each.groupBy("node").agg(*[F.first(c).alias(c) for c in ("fp", "bands", "signs")]), "sets")
    # nodes of a fingerprint are linked to the least of them: enough to bring all of them into one coarse component
    same = staged(once.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    pairs = linked(same.select("fp"), radius)
    edges = [
        _met(once, least),
        once.select("fp", "node").join(same, "fp").select(F.col("head").alias("u"), F.col("node").alias("v")),
        pairs.join(
            same.select(F.col("fp").alias("u"), F.col("head").alias("hu")), "u"
        ).join(same.select(F.col("fp").alias("v"), F.col("head").alias("hv")), "v").select(F.col("hu").alias("u"), F.col("hv").alias("v")),
    ]
    coarse = components(edges[0].union(edges[1]).union(edges[2]).filter("u <> v"))
    sizes = coarse.groupBy("label").agg(F.count("*").alias("n"))
    parts = F.expr(f"cast(case when n <= {SMALL} then 1 else greatest(least(ceil(n / {SMALL}), 8), ceil(n / {LARGE})) end as int)")
    sizes = staged(sizes.select("label", parts.alias("parts")), "sizes")
    members = staged(coarse.join(sizes, "label").select("node", "label", "parts"), "members")
    packs = max(8, members.count() // 512)
    one = each.join(members, "node").groupBy("node", "label", "parts").agg(F.min("_key").alias("_key"))
    texts = docs.select(key, docs[text].alias("_text")).join(one, "_key").select("node", "label", "parts", "_text")

    def sets(batches):
        for b in batches:
            found = pa.array([jaccard.shingles(t, shingle).tobytes() for t in b["_text"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b["node"], b["label"], b["parts"], found], names=["node", "label", "parts", "shingles"])

    tiles = _tiles(texts.mapInArrow(sets, "node long, label long, parts int, shingles binary"), "shingles", packs)

    def compared(sets: list[bytes], across: int):
        return forest(*jaccard.similar([np.frombuffer(x, np.uint64) for x in sets], least, across), len(sets))

    return each, components(_linked_tiles(tiles, "shingles", compared))


def _met(once: DataFrame, least: float) -> DataFrame:
    """Pairs u, v that connect all nodes which meet in a band and have signatures as similar sets do."""
    band = once.select("node", F.explode("bands").alias("band"))
    of = (F.count("*").alias("n"), F.min("node").alias("head"), F.expr("bit_xor(xxhash64(node))").alias("who"))
    # copies meet in most bands: of all buckets with the same nodes one is enough
    buckets = band.groupBy("band").agg(*of).filter("n > 1").groupBy("n", "head", "who").agg(F.min("band").alias("band"))
    buckets = buckets.select("band", F.ceil(F.col("n") / TILE).cast("int").alias("parts"))
    rows = band.join(buckets, "band").join(once.select("node", "signs"), "node").withColumnRenamed("band", "label")
    tiles = _tiles(rows, "signs", max(8, once.count() // 512))

    def compared(signs: list[bytes], across: int):
        return jaccard.resembling(np.frombuffer(b"".join(signs), np.uint8).reshape(len(signs), -1), least)

    return _linked_tiles(tiles, "signs", compared)


def _tiles(rows: DataFrame, what: str, packs: int) -> DataFrame:
    """Of node, label, parts and a column: a row for each tile (a pair of a label's parts) that a node is in; labels of one part share packs."""
    part = F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part")
    tiles = rows.select("*", part, F.explode(F.expr("sequence(0, parts - 1)")).alias("other"))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    pack = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("label"), F.lit(packs))).otherwise(F.xxhash64("label", low, high))
    return tiles.select("node", "label", "part", low.alias("low"), high.alias("high"), what, pack.alias("tile"))


def _linked_tiles(tiles: DataFrame, what: str, links_of) -> DataFrame:
    """Pairs u, v of the links in all tiles. links_of takes the column's values, and how many belong to the first of two parts (or 0)."""

    def of(table):
        label, first, last, part, node = (table[c].to_numpy() for c in ("label", "low", "high", "part", "node"))
        order = np.lexsort((node, part, last, first, label))
        rows = np.stack([label, first, last, node])[:, order]
        new = np.ones(len(order), bool)
        new[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)  # repeated rows bring a node twice
        order = order[new]
        cut = np.flatnonzero((np.diff(rows[:3, new], axis=1) != 0).any(axis=0)) + 1
        u, v = [], []
        for at in np.split(order, cut):
            across = int((part[at] == first[at[0]]).sum()) if first[at[0]] != last[at[0]] else 0
            if across == len(at):
                continue
            i, j = links_of(table[what].take(pa.array(at)).to_pylist(), across)
            u.append(node[at[i]]), v.append(node[at[j]])
        return pa.table([pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (u, v)], names=["u", "v"])

    return tiles.groupBy("tile").applyInArrow(of, "u long, v long")
