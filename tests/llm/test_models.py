"""Classifiers: held-out accuracy, folds and odd rows."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from talus.llm import language, quality, queries
from tests.conftest import SMALL

MEDIUM = "/root/testdata/sf0.01"


def test_quality_held_out_accuracy(spark):
    out = queries.op6_quality(spark, MEDIUM).join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert (out["predicted"] == out["quality"]).mean() > 0.93
    assert out[out["quality"] == 1]["predicted"].mean() > 0.95
    assert out["score"].between(0, 1).all()


def test_quality_learns_outside_the_fold_only(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    texts = [r["text"] for r in docs.limit(20).collect()]
    assert np.array_equal(quality.fit(docs, labels).score(texts), quality.fit(docs, flipped).score(texts))


def test_quality_odd_rows(odd, none, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = quality.score(odd, quality.fit(odd, labels)).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode() if r["doc_id"] is not None else b"") % 5 == 0)
    assert quality.score(none, quality.fit(none, labels.limit(0))).count() == 0
    assert {r["score"] for r in quality.score(odd, quality.fit(odd, labels.filter("quality = 1"))).collect()} != {0.5}


def plain_passages(text):
    """Feature counts by their definition, passage by passage."""
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    out = []
    for at in range(0, len(words), quality.PASSAGE):
        part, row = words[at : at + quality.PASSAGE], [0.0] * quality.FEATURES
        for i, w in enumerate(part):
            row[quality.shape(w) & 255] += 1
            for lag in (1, 2, 3):
                row[quality.SHAPES + lag - 1] += at + i >= lag and words[at + i - lag] == w
            row[quality.SHAPES + 3] += w in part[:i]
        row[quality.SHAPES + 4] = min(255, int(sum(map(len, part)) / len(part)))
        out.append(row)
    return out or [[0.0] * (quality.FEATURES - 1) + [1.0]]


def plain_score(p, text):
    """The score by loops: encoded passages, gated attention, logistic of the weighted mean."""
    p = {k: v.astype(float).tolist() for k, v in p.items()}
    hidden, weight = [], []
    for row in plain_passages(text):
        n = max(1.0, sum(row[: quality.SHAPES]))
        x = [math.sqrt(v / n) for v in row[: quality.SHAPES + 4]] + [row[quality.SHAPES + 4] / 16, row[quality.SHAPES + 5]]
        h = [math.tanh(p["b"][j] + sum(v * p["W"][i][j] for i, v in enumerate(x) if v)) for j in range(quality.HIDDEN)]
        gate = lambda m, k, h=h: sum(v * p[m][i][k] for i, v in enumerate(h))
        weight.append(math.exp(sum(p["w"][k] * math.tanh(gate("V", k)) / (1 + math.exp(-gate("U", k))) for k in range(quality.GATE))))
        hidden.append(h)
    z = [sum(a * h[j] for a, h in zip(weight, hidden, strict=True)) / sum(weight) for j in range(quality.HIDDEN)]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(z, p["c"], strict=True)) - p["d"][0]))


def test_quality_equals_plain_code(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    found = {r["doc_id"]: r for r in queries.op6_quality(spark, SMALL).collect()}
    few = sorted(docs.select("doc_id", "text").collect(), key=lambda r: len(r["text"] or ""))[:120]
    for r in few:
        told = plain_score(model.p, r["text"])
        assert found[r["doc_id"]]["score"] == pytest.approx(told, abs=2e-4) and found[r["doc_id"]]["predicted"] == (found[r["doc_id"]]["score"] >= 0.3)


def test_attention_gradient():
    rng = np.random.default_rng(0)
    model = quality.GatedAttention(rng)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, starts, y = rng.random((7, quality.FEATURES)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])
    loss = lambda: -(np.log(np.where(y > 0, s := model.forward(x, starts)[0], 1 - s))).mean()  # noqa: E731, F841
    grad = model.gradient(x, starts, y)
    for name in ("W", "V", "U", "w", "c", "d", "b"):
        flat, at = model.p[name].reshape(-1), 0
        before = flat[at]
        flat[at] = before + 1e-5
        up = loss()
        flat[at] = before - 1e-5
        down = loss()
        flat[at] = before
        assert grad[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-5, abs=1e-5)


def test_language_held_out_accuracy(spark):
    out = queries.op10_language_id(spark, MEDIUM).join(
        spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).filter("held_out").toPandas()
    assert (out["lang_pred"] == out["lang"]).mean() > 0.95


def test_language_equals_plain_code(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit(docs)
    found = {r["doc_id"]: r["lang_pred"] for r in queries.op10_language_id(spark, SMALL).collect()}
    for r in docs.select("doc_id", "text").collect():
        if not language.has_letter(r["text"]):
            assert found[r["doc_id"]] == "und"
            continue
        value = [float(v) for v in language.features(r["text"]) @ model.weights + model.bias]  # of the whole text at once
        n = len(model.families)
        kin = model.families[max(range(n), key=lambda i: (value[i], -i))]
        own = [c for c in model.langs if language.family(c) == kin]
        pairs = {ab: v for ab, v in zip(model.pairs, value[n:], strict=True) if ab[0] in own}
        won = {c: sum(v > 0 for (a, _), v in pairs.items() if a == c) + sum(v < 0 for (_, b), v in pairs.items() if b == c) for c in own}
        total = {c: sum(v for (a, _), v in pairs.items() if a == c) - sum(v for (_, b), v in pairs.items() if b == c) for c in own}
        assert found[r["doc_id"]] == min(own, key=lambda c: (-won[c], -total[c], c))


def test_words_survive_a_generation(monkeypatch):
    rng = np.random.default_rng(1)
    texts = ["le chat noir dort", "the black cat sleeps", "der schwarze hund"] * 4
    model = language.Hierarchy(np.stack([language.features(t) for t in texts]) + rng.random((12, language.DIM)) * 1e-6, ["fr", "en", "de"] * 4)
    monkeypatch.setattr(language, "VALUE_BYTES", 2000)
    small, large = language.WordValues(model), language.WordValues(model)
    for k in range(30):
        words = [f"w{chr(97 + (k + i) % 26)}{chr(97 + i)}!" for i in range(6)] + ["cat", "12"]
        small.learn(set(words))
        assert len(small.place) < 40
        monkeypatch.setattr(language, "VALUE_BYTES", 1 << 30)
        large.learn(set(words))
        monkeypatch.setattr(language, "VALUE_BYTES", 2000)
        assert np.allclose(small.mean(words), large.mean(words))


def test_language_sample_is_the_same_in_every_run(spark):
    rows = [(None if i % 3 else i, f"aaa bbb {'x' * (i % 7)}" if i % 2 else f"ccc ddd {'y' * (i % 5)}", "en" if i % 2 else "fr") for i in range(400)]
    frame = lambda n: spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(n)
    one, two = (language.fit(frame(n), per_language=20) for n in (1, 7))
    assert np.array_equal(one.weights, two.weights) and one.langs == ["en", "fr"]
    with pytest.raises(ValueError):
        language.predict(frame(1).withColumn("score", F.lit(1)), one, keep=("score",))


def test_language_odd_rows(odd, none):
    model = language.fit(odd)
    out = {(r["doc_id"], r["text"]): r for r in language.predict(odd, model, keep=("doc_id", "text")).collect()}
    for (_, text), r in out.items():
        letter = any(c.isalpha() for c in text or "")
        assert (r["lang_pred"] == "und") == (not letter) and 0 <= r["score"] <= 1 and r["lang_pred"] in ("und", "en", "fr")
    assert language.predict(none, language.fit(none)).count() == 0
    assert {r["lang_pred"] for r in language.predict(odd, language.fit(none)).collect()} == {"und"}


def test_more_languages_than_the_bound(spark):
    codes = [f"q{c}" for c in "abcdef"]
    rows = [(100 * i + k, f"{c}{c} {c}{k % 5}{c}r {c}l{c}", c) for i, c in enumerate(codes) for k in range(30 - 4 * i)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, languages=3)
    assert model.langs == codes
    assert all(r["lang_pred"] == r["lang"] for r in language.predict(df, model, keep=("lang",)).collect())


def test_one_language_and_families(spark):
    df = spark.createDataFrame([(i, "some words here", "en") for i in range(20)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.predict(df, language.fit(df)).collect()} == {"en"}
    assert language.family("en") == language.family("de-AT") != language.family("fr") and language.family("xx") == "xx"
