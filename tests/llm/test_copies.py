"""Substring dedup and SimHash against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from talus.llm import queries, simhash, substring
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def kept(texts, window=35):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def test_windows_equal_brute_force(odd):
    rows = odd.select("doc_id", "text").collect()
    found = substring.dedup_substrings(odd, block_chars=2000).collect()
    told = [(r["doc_id"], *k) for r, k in zip(rows, kept([r["text"] for r in rows]), strict=True)]
    assert sorted(map(tuple, found), key=key) == sorted(told, key=key)


@pytest.mark.parametrize("window, gram", [(5, 2), (8, 8), (1, 1), (6, 1)])
def test_other_windows(spark, window, gram):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40)))) for i in range(40)]
    found = substring.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), window=window, gram=gram, block_chars=200).collect()
    assert sorted(map(tuple, found)) == sorted((i, *k) for (i, _), k in zip(rows, kept([t for _, t in rows], window), strict=True))


def test_index_keeps_history_over_batches(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    frame = lambda *texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = substring.FingerprintIndex(spark)
    first = substring.dedup_substrings(frame(f"one {passage}", "two"), index=index).collect()
    assert {r["n_removed"] for r in first} == {0} and len(index.runs) == 1
    n = index.entries().count()
    index.append(index.places(frame("x").select(F.lit(0).alias("_block"), F.col("text").alias("_text"))))
    assert len(index.runs) == 2
    index.compact()
    assert len(index.runs) == 1 and index.entries().count() == n
    with pytest.raises(ValueError):
        substring.FingerprintIndex(spark, window=3, gram=4)


def test_later_call_meets_history(spark):
    rng = random.Random(5)
    passage, other, alone = (" ".join(f"{p}{rng.randrange(50)}" for _ in range(40)) for p in "pqa")
    frame = lambda *texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    calls = [(f"one {passage} x", "two", None), (f"three {other}", alone), (f"new {passage} end {other} {alone[:30]}", "two"), ("none", f"{alone} y")]
    index, before = substring.FingerprintIndex(spark), []
    for texts in calls:
        found = substring.dedup_substrings(frame(*texts), index=index, block_chars=60)
        told = kept([*before, *texts])[len(before) :]
        assert sorted(map(tuple, found.collect())) == sorted((i, *k) for i, k in enumerate(told))
        before += texts
    assert told[1][1] == 40 and kept(calls[2])[0][1] == 0


def test_index_is_opened_again(spark, tmp_path):
    rng = random.Random(6)
    passages = [" ".join(f"{p}{rng.randrange(50)}" for _ in range(40)) for p in "abcdefgh"]
    frame = lambda *texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path, before = f"file://{tmp_path}/index", []
    for i in range(8):  # each call a new index on the same folder; passages come back after some calls, once inside another text
        texts = [passages[i], f"new {i} {passages[max(0, i - 3)]} end", None, f"{passages[i // 2][:60]} {i}"]
        broken = substring.FingerprintIndex(spark, path)
        substring.dedup_substrings(frame("lost", passages[i]), index=broken, block_chars=100).collect()  # never committed
        index = substring.FingerprintIndex(spark, path)
        found = substring.dedup_substrings(frame(*texts), index=index, block_chars=100).collect()
        told = kept([*before, *texts])[len(before) :]
        assert sorted(map(tuple, found)) == sorted((j, *k) for j, k in enumerate(told))
        before += texts
        assert index.commit() == i + 1
        assert len(index.runs) < 2 * substring.FAN and len(index.windows) == len(index.runs)
        assert len([f for f in (tmp_path / "index").iterdir() if not f.name.startswith(".")]) == 1 + len(index.runs) + len(index.windows)
    assert any(p.rsplit("/", 1)[1].startswith("windows-1-") for p in index.windows)
    with pytest.raises(OSError, match="another application"):
        other = substring.FingerprintIndex(spark, path)
        other.version -= 1
        other.commit()
    with pytest.raises(ValueError, match="35 words"):
        substring.FingerprintIndex(spark, path, window=20)


def test_index_never_reads_earlier_texts(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    index = substring.FingerprintIndex(spark, f"file://{tmp_path}/index")
    substring.dedup_substrings(docs, index=index).collect()
    index.commit()
    stored = {f.name for f in spark.read.parquet(*index.windows).schema} | {f.name for f in index.entries().schema}
    assert stored == {"m", "a", "b", "n"}
    again = substring.dedup_substrings(docs, index=substring.FingerprintIndex(spark, index.path)).collect()
    assert again[0]["n_removed"] == 60


def test_batches_meet_runs_before_them(spark):
    frame = lambda *rows: spark.createDataFrame(rows, "m long, block int, n long")
    index = substring.FingerprintIndex(spark)
    met = [
        sorted(r["m"] for r in index.append(b).collect())
        for b in (frame((1, 0, 1), (2, 0, 2), (3, 0, 1)), frame((1, 1, 1), (4, 1, 1)), frame((4, 2, 1), (4, 3, 1), (3, 2, 1), (5, 2, 1)))
    ]
    assert met == [[2], [1], [3, 4]]


def test_substring_empty_table(none):
    out = substring.dedup_substrings(none)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_text"] and out.count() == 0


def test_op1_digest(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in queries.op1_substring_dedup(spark, SMALL).collect()}
    for d, (n, gone, text) in zip(docs, kept([d["text"] for d in docs]), strict=True):
        r = found[d["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, gone, hashlib.sha256(text.encode()).hexdigest())


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, radius=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    a = np.array(prints, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= radius).tolist():
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(a))]


def test_near_duplicates_equal_brute_force(odd):
    rows = odd.select("doc_id", "text").collect()
    prints = [fingerprint(r["text"]) for r in rows]
    part = classes(prints)
    least = {}
    for r, c in zip(rows, part, strict=True):
        if r["doc_id"] is not None:
            least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    told = [(r["doc_id"], p, least.get(c)) for r, p, c in zip(rows, prints, part, strict=True)]
    found = [(r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(odd).collect()]
    assert sorted(found, key=key) == sorted(told, key=key)


@pytest.mark.parametrize("seed, tile", [(0, 4), (1, 64)])
def test_tiles_lose_no_link(spark, seed, tile):
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(12)]
    for _ in range(250):  # chains of near fingerprints
        prints.append(rng.choice(prints) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    prints = sorted(set(prints))
    frame = spark.createDataFrame([(p - (p >> 63 << 64),) for p in prints], "fp long")
    label = {r["node"]: r["label"] for r in simhash.components(simhash.linked(frame, tile=tile)).collect()}
    part = classes(prints)
    groups = lambda names: sorted(tuple(sorted(i for i, n in enumerate(names) if n == x)) for x in set(names))
    assert groups([label.get(p - (p >> 63 << 64), i) for i, p in enumerate(prints)]) == groups(part)


def test_forest_is_small_and_connects():
    rng = np.random.default_rng(1)
    i, j = rng.integers(0, 50, 400), rng.integers(0, 50, 400)
    node, root = simhash.forest(i, j, 50)
    assert len(node) < 50 and (root < node).all()


def test_long_path_contracts(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long")
    assert len({r["label"] for r in simhash.components(edges).collect()}) == 1


def test_simhash_empty_table(none):
    assert simhash.near_duplicates(none).count() == 0
