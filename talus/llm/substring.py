"""Substring dedup: a log-structured index of window fingerprints.

Every window of ``window`` words has a fingerprint: the smallest hash among the ``gram``-word runs inside it. Equal
windows have equal fingerprints, and neighbouring windows mostly share one, so a document adds about two entries per
``window - gram`` words to the index instead of one per word. The index is a list of immutable runs, each a Parquet table
sorted by fingerprint that holds the number of places of each. A batch is merge-joined with the runs written before it;
windows whose fingerprint has a second place are verified by a 128-bit digest of their whole word sequence; compaction merges
runs. An index that outlives a call also has sorted runs of its windows' digests beside their fingerprints: windows of later calls are
verified against those whose fingerprint they share, and texts of earlier calls are never read again. ``commit`` makes what was added
durable in a manifest, by which another application opens the index.

Rows whose text is null or has fewer words than a window keep all their words. A null text has no words. Repeated rows are
documents of their own, so each is a copy of the other. Columns other than the text and those in ``keep`` are not read.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.llm.common import Memo, Rolling, hashed, mix, new_path, prepare, sliding, split_words, staged
from talus.operators import bloom

WINDOW, GRAM = 35, 8
#: Characters of text in a block, the unit that one Python call holds.
BLOCK_CHARS = 4 << 20
#: Runs of one level that a commit merges into one of the next; windows in a batch of digests.
FAN, SLICE = 4, 1 << 18
ENTRIES, DIGESTS = "m long, n long", "m long, a long, b long"
_roll, _roll2 = Rolling(0x9E3779B97F4A7C15), Rolling(0xD6E8FEB86659FD93)


def fingerprints(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Of word hashes: each window's fingerprint, and the hashes of the gram positions that are one."""
    if len(h) < window:
        none = np.zeros(0, np.uint64)
        return none, none
    g = _roll(h, gram)
    low = sliding(g, span := window - gram + 1)
    edge = np.zeros(span - 1, np.uint64)
    return low, g[g == sliding(np.concatenate([edge, low, edge]), span, np.maximum)]


def digests(h: np.ndarray, window: int, at: np.ndarray) -> np.ndarray:
    """128 bits of the whole word sequence of the windows that start at the given places."""
    return np.stack([_roll(h, window)[at], _roll2(mix(h), window)[at]], axis=1)


class FingerprintIndex:
    """Runs under ``path``, by default one in the shared folder that goes with the application. ``append`` adds a batch as a run, ``compact`` merges all runs.

    ``remember`` adds the digests of all windows; without them a run tells which fingerprints occur, but no window of it can be verified.
    ``commit`` writes a numbered manifest of the runs and then removes what it no longer names. An index that is opened where a manifest
    lies goes on from the last one; runs that a broken application left behind without a manifest are ignored and removed by the next
    commit. So write a call's result, then commit: a call that is broken off before can be repeated. One application writes at a time; of
    two that commit the same number the second fails.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, window: int = WINDOW, gram: int = GRAM):
        if not 0 < gram <= window:
            raise ValueError("gram must be from 1 to window")
        self.spark, self.window, self.gram, self.path = spark, window, gram, (path or new_path(spark, "fingerprints")).rstrip("/")
        self.version, self.runs, self.windows = 0, [], []
        if known := self._manifests():
            self.version = max(known)
            told = json.loads(spark.read.option("wholetext", True).text(known[self.version]).first()["value"])
            if (told["window"], told["gram"]) != (window, gram):
                raise ValueError(f"{path} holds windows of {told['window']} words in grams of {told['gram']}")
            self.runs, self.windows = ([f"{self.path}/{name}" for name in told[kind]] for kind in ("runs", "windows"))

    def _at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._at(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        fs = self._fs()
        return [f.getPath().getName() for f in fs.listStatus(self._at(self.path))] if fs.exists(self._at(self.path)) else []

    def _manifests(self) -> dict[int, str]:
        return {int(n[9:-5]): f"{self.path}/{n}" for n in self._names() if n.startswith("manifest-") and n.endswith(".json")}

    def _write(self, rows: DataFrame, kind: str, level: int = 0) -> str:
        """A run, sorted by fingerprint, each row once; its level stands in its name."""
        path = f"{self.path}/{kind}-{level}-{uuid.uuid4().hex[:12]}"
        rows = rows.groupBy("m").agg(F.sum("n").alias("n")) if kind == "run" else rows.distinct()
        rows.sortWithinPartitions("m").write.option("compression", "zstd").parquet(path)
        return path

    def entries(self) -> DataFrame:
        """All runs: fingerprint and number of places; one row per run and fingerprint."""
        return self.spark.read.schema(ENTRIES).parquet(*self.runs) if self.runs else self.spark.createDataFrame([], ENTRIES)

    def append(self, batch: DataFrame) -> DataFrame:
        """batch: m, n of new documents, as ``places`` gives them. Returns its fingerprints (m) with a second place in it or one in the runs before it."""
        before = self.entries().select("m") if self.runs else None
        self.runs.append(self._write(batch.select("m", "n"), "run"))
        run = self.spark.read.schema(ENTRIES).parquet(self.runs[-1])
        inside = run.filter("n > 1").select("m")
        if before is None:
            return inside
        if self.windows:  # a history may be far larger than the batch
            before = bloom.maybe(before, bloom.key_filter(run.select("m"), run.count()), F.col("m"))
        return inside.union(run.filter("n = 1").select("m").join(before.hint("merge"), "m", "left_semi"))

    def remember(self, blocks: DataFrame) -> None:
        """blocks: ``_text`` of documents that were appended. Adds fingerprint and digest of each of their windows."""
        window, gram = self.window, self.gram

        def of(batches):
            Memo.only()
            for b in batches:
                for text in b["_text"].to_pylist():
                    h = hashed(split_words(text))
                    low, _ = fingerprints(h, window, gram)
                    if len(low):
                        found = digests(h, window, np.arange(len(low)))
                        for i in range(0, len(low), SLICE):
                            cols = [low[i : i + SLICE], *found[i : i + SLICE].T]
                            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).view(np.int64)) for c in cols], names=["m", "a", "b"])

        self.windows.append(self._write(blocks.select("_text").mapInArrow(of, DIGESTS), "windows"))

    def remembered(self, repeated: DataFrame) -> DataFrame:
        """Digests (a, b) of all remembered windows that have one of the fingerprints."""
        every = self.spark.read.schema(DIGESTS).parquet(*self.windows) if self.windows else self.spark.createDataFrame([], DIGESTS)
        met = bloom.maybe(every, bloom.key_filter(repeated.select("m"), repeated.count()), F.col("m"))
        return met.join(repeated.select("m"), "m", "left_semi").select("a", "b")

    def compact(self, since: int = 0) -> None:
        """One run in place of all from a place in their order on; the old runs' files stay for readers that have begun, until a commit."""
        if len(self.runs) > since + 1:
            self.runs[since:] = [self._write(self.spark.read.schema(ENTRIES).parquet(*self.runs[since:]), "run")]

    def _merged(self, paths: list[str], kind: str, schema: str) -> list[str]:
        """Levels with FAN runs or more become one run of the next level, so a row is written again a logarithmic number of times."""
        level = lambda path: int(path.rsplit("/", 1)[1].split("-")[1])
        while full := [n for n in sorted(set(map(level, paths))) if sum(level(p) == n for p in paths) >= FAN]:
            old = [p for p in paths if level(p) == full[0]]
            paths = [p for p in paths if p not in old] + [self._write(self.spark.read.schema(schema).parquet(*old), kind, full[0] + 1)]
        return paths

    def commit(self) -> int:
        """Makes all that was added durable; returns the manifest's number. Results of calls that weren't written before may fail afterwards."""
        runs, windows = self._merged(self.runs, "run", ENTRIES), self._merged(self.windows, "windows", DIGESTS)
        name = lambda path: path.rsplit("/", 1)[1]
        told = {"window": self.window, "gram": self.gram, "runs": list(map(name, runs)), "windows": list(map(name, windows))}
        fs, new = self._fs(), f"manifest-{self.version + 1:06d}.json"
        written, final = self._at(f"{self.path}/.{new}-{uuid.uuid4().hex[:12]}"), self._at(f"{self.path}/{new}")
        out = fs.create(written, False)
        try:
            out.write(bytearray(json.dumps(told).encode()))
        finally:
            out.close()
        if fs.exists(final) or not fs.rename(written, final):
            fs.delete(written, False)
            raise OSError(f"{new} is there: another application has committed to {self.path}")
        self.version, self.runs, self.windows = self.version + 1, runs, windows
        stay = {new, *map(name, runs), *map(name, windows)}
        for old in self._names():
            if old not in stay and old.startswith(("run-", "windows-", "manifest-", ".manifest-")):
                fs.delete(self._at(f"{self.path}/{old}"), True)
        return self.version

    def repeated(self) -> DataFrame:
        """Fingerprints with a second place."""
        found = self.entries()
        if len(self.runs) > 1:
            found = found.groupBy("m").agg(F.sum("n").alias("n"))
        return found.filter("n > 1").select("m")

    def places(self, blocks: DataFrame) -> DataFrame:
        """Of ``_block``, ``_text``: fingerprint m, its block, and n, its places in one document."""
        window, gram = self.window, self.gram

        def of(batches):
            Memo.only()
            for b in batches:
                ms, ns, at = [], [], []
                for block, text in zip(b["_block"].to_numpy(), b["_text"].to_pylist(), strict=True):
                    _, chosen = fingerprints(hashed(split_words(text)), window, gram)
                    if len(chosen):
                        m, n = np.unique(chosen, return_counts=True)
                        ms.append(m.view(np.int64)), ns.append(n), at.append(np.full(len(m), block))
                if ms:
                    cols = [pa.array(np.concatenate(ms)), pa.array(np.concatenate(at).astype(np.int32)), pa.array(np.concatenate(ns).astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(cols, names=["m", "block", "n"])

        return blocks.select("_block", "_text").mapInArrow(of, "m long, block int, n long")


def _candidates(texts: list, repeated: np.ndarray, window: int, gram: int):
    """For each text its words and the starts and digests of windows with a repeated fingerprint."""
    repeated = np.sort(repeated)
    for text in texts:
        words = split_words(text)
        starts, found = np.zeros(0, np.int64), np.zeros((0, 2), np.uint64)
        if len(words) >= window and len(repeated):
            low, _ = fingerprints(h := hashed(words), window, gram)
            at = np.minimum(np.searchsorted(repeated, low), len(repeated) - 1)
            starts = np.flatnonzero(repeated[at] == low)
            if len(starts):
                found = digests(h, window, starts)
        yield words, starts, found


def _ordered(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digests in order, how often each occurs, and each input's place among them."""
    rows = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    rows = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    rank = np.cumsum(new) - 1
    place = np.empty(len(rows), np.int64)
    place[order] = rank
    return rows[new], np.bincount(rank, minlength=0), place


def _longs(table: pa.Table, column: str) -> np.ndarray:
    lists = [x for x in table[column].combine_chunks().to_pylist() if x]
    return np.concatenate([np.array(x, np.int64) for x in lists]).view(np.uint64) if lists else np.zeros(0, np.uint64)


def _buckets(rows: np.ndarray, n: int) -> np.ndarray:
    """Ranges of the first 64 bits, so sorted digests lie bucket by bucket."""
    return ((rows[:, 0] >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def dedup_substrings(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW, gram: int = GRAM, batches: int = 2,
    index: FingerprintIndex | None = None, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The columns in keep, then n_words, n_removed and kept_text: the words that no window covers which starts anywhere else, joined by one space.

    index: history to which docs are added: windows that start anywhere in it count as copies, and docs' runs join it, for good by
    ``index.commit()`` once the result is written; without one, docs alone count. batches: runs that docs are appended as.
    An empty table gives an empty result. Memory: a block of about block_chars characters, or one longer text, for each task.
    """
    spark = docs.sparkSession
    prepare(spark)
    lasting, index = index is not None, index or FingerprintIndex(spark, window=window, gram=gram)
    window, gram = index.window, index.gram
    chars = docs.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0]
    n = max(8, -(-chars // block_chars))
    kept = [docs[c].alias(f"_keep{i}") for i, c in enumerate(keep)]
    fields = [T.StructField(c, docs.schema[c].dataType) for c in keep]
    key = F.xxhash64(*[docs[c] for c in keep], docs[text])
    blocks = docs.select(*kept, docs[text].alias("_text"), F.pmod(key, F.lit(n)).cast("int").alias("_block"))

    places = staged(index.places(blocks), "places")
    history, at = bool(index.windows), len(index.runs)
    repeated = reduce(DataFrame.union, [index.append(places.filter(F.pmod("block", F.lit(batches)) == i)) for i in range(batches)])
    index.compact(at)
    if lasting:
        repeated = staged(repeated.distinct(), "repeated")
        old = staged(index.remembered(repeated), "remembered") if history else None
        index.remember(blocks)
    shared = places.select("m", "block").join(repeated, "m", "left_semi").groupBy("block").agg(F.collect_set("m").alias("ms"))

    def spread(rows, count, block):
        """Digests in order and their counts, cut by bucket."""
        bucket = _buckets(rows, n)
        cut = np.flatnonzero(np.diff(bucket)) + 1
        out = [
            (int(b[0]), block, r.tobytes(), np.minimum(c, 2).astype(np.uint8).tobytes())
            for b, r, c in zip(np.split(bucket, cut), np.split(rows, cut), np.split(count, cut), strict=True) if len(b)
        ]
        cols = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
            names=["bucket", "block", "rows", "count"]
        )

    def candidates(key, left, right):
        rows, count, _ = _ordered([f for _, _, f in _candidates(left["_text"].to_pylist(), _longs(right, "ms"), window, gram)])
        return spread(rows, count, key[0].as_py())

    def earlier(batches):
        for b in batches:
            rows, count, _ = _ordered([np.stack([b[c].to_numpy().view(np.uint64) for c in ("a", "b")], axis=1)])
            yield from spread(rows, count, -1).to_batches()

    def verified(key, table):
        parts = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in table["rows"].to_pylist()]
        count = np.concatenate([np.frombuffer(x, np.uint8) for x in table["count"].to_pylist()]).astype(np.int64)
        _, _, place = _ordered(parts)
        again = np.bincount(place, count)[place] > 1
        ends = np.cumsum([len(p) for p in parts])[:-1]
        bits = [np.packbits(x).tobytes() for x in np.split(again, ends)]
        return pa.table([table["block"], pa.array([key[0].as_py()] * len(bits), pa.int32()), pa.array(bits, pa.binary())], names=["block", "bucket", "bits"])

    def removed(key, left, right):
        texts = left["_text"].to_pylist()
        each = list(_candidates(texts, _longs(right, "ms"), window, gram))
        rows, _, place = _ordered([f for _, _, f in each])
        bits = {b: x for b, x in zip(right["bucket"].to_pylist(), right["bits"].to_pylist(), strict=True) if x is not None}
        bucket = _buckets(rows, n)
        again = np.zeros(len(rows), bool)
        for b in np.unique(bucket):
            lo, hi = np.searchsorted(bucket, [b, b + 1])
            again[lo:hi] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=hi - lo)
        n_words, n_removed, texts, at = [], [], [], 0
        for words, starts, _ in each:
            starts, at = starts[again[place[at : at + len(starts)]]], at + len(starts)
            if len(starts):
                edge = np.zeros(len(words) + 1, np.int64)
                edge[starts] += 1
                edge[starts + window] -= 1
                out = np.cumsum(edge)[:-1] > 0
                kept_words = [w for w, gone in zip(words, out.tolist(), strict=True) if not gone]
            else:
                kept_words = words
            n_words.append(len(words)), n_removed.append(len(words) - len(kept_words)), texts.append(b" ".join(kept_words).decode("utf-8", "surrogatepass"))
        return pa.table(
            [*[left[f"_keep{i}"] for i in range(len(keep))], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())],
            names=[*keep, "n_words", "n_removed", "kept_text"]
        )

    piece = "bucket int, block int, rows binary, count binary"
    found = blocks.groupBy("_block").cogroup(shared.withColumnRenamed("block", "_block").groupBy("_block")).applyInArrow(candidates, piece)
    if history:
        found = found.union(old.mapInArrow(earlier, piece))
    marks = found.groupBy("bucket").applyInArrow(verified, "block int, bucket int, bits binary").filter("block >= 0")
    told = shared.select(
        "block", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("bits"), "ms"
    ).unionByName(marks.select("block", "bucket", "bits", F.lit(None).cast("array<long>").alias("ms")))
    out = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])
    return blocks.groupBy("_block").cogroup(told.withColumnRenamed("block", "_block").groupBy("_block")).applyInArrow(removed, out)
