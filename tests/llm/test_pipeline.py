"""The pipeline's stages against brute force, one after the other."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as pipeline
from talus.llm import jaccard, queries, simhash
from tests.llm.conftest import SCHEMA, rows_of
from tests.llm.test_copies import classes, fingerprint, kept

COLUMNS = list(pipeline.COLUMNS)


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_stages_on_odd_rows(spark):
    docs = spark.createDataFrame(rows_of(), SCHEMA).repartition(3)
    before = rows(docs)
    stages = dict(pipeline.STAGES)

    told = pipeline.staged(stages["language"](spark, docs, ""), "t")
    assert told.columns == COLUMNS
    assert sorted(rows(told), key=repr) == sorted((r for r in before if any(c.isalpha() for c in r[1] or "")), key=repr)

    near = pipeline.staged(stages["near"](spark, told, ""), "t")
    part = classes([fingerprint(r[1]) for r in rows(told)])
    groups = {}
    for r, c in zip(rows(told), part, strict=True):
        groups.setdefault(c, []).append(r)
    ids = {min((r[0] for r in g if r[0] is not None), default=None) for g in groups.values()}
    assert near.columns == COLUMNS and sorted(r[0] is not None and r[0] for r in rows(near)) == sorted(i is not None and i for i in ids)

    once = pipeline.staged(stages["repeats"](spark, near, ""), "t")
    source = rows(near)
    expected = []
    for r, (n, gone, text) in zip(source, kept([r[1] for r in source]), strict=True):
        if not gone:
            expected.append(r)
        elif gone < n:
            expected.append((r[0], text, r[2], r[3], len(text)))
    assert once.columns == COLUMNS and sorted(rows(once), key=repr) == sorted(expected, key=repr)

    mixed = pipeline.staged(stages["mix"](spark, once, ""), "t")
    assert mixed.columns == COLUMNS and set(rows(mixed)) <= set(rows(once))
    assert max(rows(mixed).count(r) for r in set(rows(mixed))) <= 3

    out = stages["encode"](spark, mixed, "").collect()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    assert len(out) == mixed.count() and all(r["exact"] for r in out)
    assert sorted(map(repr, (r["ids"] for r in out))) == sorted(map(repr, (library.encode(r[1] or "") for r in rows(mixed))))


def test_near_keeps_a_row_of_each_component(spark):
    rng = random.Random(3)
    text = lambda: " ".join(f"v{rng.randrange(10**6)}" for _ in range(40))
    a, b, c, d, e, f = (text() for _ in range(6))
    row = lambda i, t: (i, t, "en", "s", len(t))
    docs = [row(None, a), row(None, b), row(None, b), row(7, c), row(7, d), row(None, e), row(9, e), row(8, e), row(5, f), row(5, f)]
    near = dict(pipeline.STAGES)["near"](spark, spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), "")
    told = [row(None, a), row(None, b), row(7, c), row(7, d), row(8, e), row(5, f)]
    assert sorted(rows(near), key=repr) == sorted(told, key=repr)


def five(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


@pytest.mark.parametrize("small, tile", [(64, 1024), (4, 5)])
def test_near_equals_brute_force_jaccard(spark, monkeypatch, small, tile):
    monkeypatch.setattr(simhash, "SMALL", small), monkeypatch.setattr(simhash, "LARGE", tile)
    rng = random.Random(4)
    words = lambda k: [f"v{rng.randrange(500)}" for _ in range(k)]
    texts = [words(rng.choice([1, 3, 5, 40, 200])) for _ in range(20)] + [[]]
    for _ in range(25):  # near copies of one text, chains of edits, and edits at all places of others
        texts.append([rng.choice(["x", "y"]) if rng.random() < 0.01 else w for w in texts[3 if rng.random() < 0.5 else -1]])
    for _ in range(80):
        t = list(rng.choice(texts))
        for _ in range(rng.randint(0, max(1, len(t) // 30))):
            if t:
                t[rng.randrange(len(t))] = words(1)[0]
        texts.append(t)
    texts = [" ".join(t) for t in texts]
    sets, root = list(map(five, texts)), list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    found = simhash.near_duplicates(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), shingle=5, similarity=0.8
    ).select("doc_id", "component_id")
    assert 10 < len(set(root)) < len(root) - 40
    assert sorted(map(tuple, found.collect())) == list(enumerate(root))


def test_near_links_what_simhash_missed(spark):
    rng = random.Random(6)
    docs = []
    for i in range(0, 60, 2):
        t = [f"v{rng.randrange(10**6)}" for _ in range(100)]
        docs += [(i, " ".join(t), "en", "s", 1), (i + 1, " ".join(t[:50] + ["other"] + t[50:]) + " two more", "en", "s", 1)]
    near = dict(pipeline.STAGES)["near"](spark, spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), "")
    assert sorted(r[0] for r in rows(near)) == list(range(0, 60, 2))


def test_texts_with_a_shared_passage_are_no_candidates(spark, monkeypatch):
    """Texts of similarity 0.14 meet in some bands; their signatures keep them apart before anything is gathered."""
    rng, met, real = random.Random(8), [], simhash._met
    words = lambda k: " ".join(f"v{rng.randrange(10**6)}" for _ in range(k))
    passage = words(60)
    docs = [(i, f"{passage} {words(180)}") for i in range(1500)]
    docs += [(1500 + i, docs[i][1] + " more") for i in range(20)]
    monkeypatch.setattr(simhash, "_met", lambda once, least: met.append((once, real(once, least))) or met[0][1])
    found = simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=5, similarity=0.8)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {i: i % 1500 for i in range(1520)}
    once, candidates = met[0]
    buckets = once.selectExpr("explode(bands) as band").groupBy("band").count()
    assert buckets.filter("count > 2").count() > 0 and candidates.distinct().count() == 20  # a pair may meet in several buckets


def test_signatures_connect_what_pairs_connect():
    rng = np.random.default_rng(9)
    signs = rng.integers(0, 256, (12, 160)).astype(np.uint8)[rng.integers(0, 12, 120)]
    for row, share in zip(signs, rng.random(120) * 0.5, strict=True):  # up to half the places differ: chains and pairs on both sides of the limit
        other = rng.random(160) < share
        row[other] = rng.integers(0, 256, int(other.sum()))
    limit = int(160 * 0.8 - jaccard.DEVIATIONS * (160 * 0.8 * 0.2) ** 0.5)
    root = list(range(120))
    for x in range(120):
        for y in range(x):
            if int((signs[x] == signs[y]).sum()) >= limit and root[x] != root[y]:
                low, high = sorted((root[x], root[y]))
                root = [low if r == high else r for r in root]
    label = np.arange(120)
    node, least = simhash.forest(*jaccard.resembling(signs, 0.8), 120)
    label[node] = least
    assert label.tolist() == root and 12 < len(set(root)) < 100


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in pipeline.STAGES:
        docs = pipeline.staged(stage(spark, docs, ""), f"empty-{name}")
        assert docs.count() == 0
