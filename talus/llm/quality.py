"""Quality classifier: attention-based multiple-instance learning with gated attention.

A document is a bag of passages of 64 words. Each passage is a vector of word-shape frequencies (shapes hashed to a fixed
number of places, with repetition counts beside them), encoded by one tanh layer. A gate, tanh times sigmoid, gives every
passage an attention weight, softmax over the document; the score is logistic in the weighted mean of the encodings. Only
document labels train it, by Adam in numpy on a sample of at most ``sample`` labelled documents; scoring reads whole texts.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.llm.common import Memo, doc_crc, prepare

PASSAGE, SHAPES, HIDDEN, GATE = 64, 256, 24, 12
FEATURES = SHAPES + 6
SAMPLE, THRESHOLD, FOLDS, SEED = 4000, 0.3, 5, 11


def shape(word: bytes) -> int:
    """A hash of the word above 8 bits that tell its shape: runs of upper, lower, digit or one other character."""
    kinds = ("U" if c.isupper() else "l" if c.isalpha() else "d" if c.isdigit() else c for c in word.decode("utf-8", "replace"))
    runs = "".join(k + "+" * (sum(1 for _ in g) > 1) for k, g in groupby(kinds))
    return (xxhash.xxh64_intdigest(word) & 0xFFFFFFFFFFFF) << 8 | xxhash.xxh32_intdigest(runs[:24].encode()) % SHAPES


_shapes = Memo(shape, 48 << 20)


def passages(text: str | None) -> np.ndarray:
    """Counts of each feature, a row for each passage; a text without words is one passage that only says so."""
    words = text.encode("utf-8", "surrogatepass").split() if text else []
    n = len(words)
    rows = max(1, -(-n // PASSAGE))
    out = np.zeros((rows, FEATURES), np.uint8)
    if not n:
        out[0, SHAPES + 5] = 1
        return out
    v = np.fromiter(map(_shapes.__getitem__, words), np.int64, n)
    at = np.arange(n) // PASSAGE
    out[:, :SHAPES] = np.bincount(at * SHAPES + (v & 255), minlength=rows * SHAPES).reshape(rows, SHAPES)
    for lag in (1, 2, 3):
        same = np.flatnonzero(v[lag:] == v[:-lag]) + lag
        out[:, SHAPES + lag - 1] = np.bincount(at[same], minlength=rows)
    order = np.lexsort((v, at))
    again = np.flatnonzero((v[order][1:] == v[order][:-1]) & (at[order][1:] == at[order][:-1])) + 1
    out[:, SHAPES + 3] = np.bincount(at[order][again], minlength=rows)
    out[:, SHAPES + 4] = np.minimum(255, np.bincount(at, np.fromiter(map(len, words), np.int64, n), minlength=rows) / np.bincount(at, minlength=rows))
    return out


def _scaled(counts: np.ndarray) -> np.ndarray:
    x = counts.astype(np.float32)
    n = np.maximum(1, x[:, :SHAPES].sum(axis=1, keepdims=True))
    x[:, : SHAPES + 4] = np.sqrt(x[:, : SHAPES + 4] / n)
    x[:, SHAPES + 4] /= 16
    return x


class GatedAttention:
    """Parameters: encoder W, b; gate V, U, w; output c, d."""

    def __init__(self, rng: np.random.Generator):
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {
            "W": draw(FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE), "w": draw(GATE),
            "c": draw(HIDDEN), "d": np.zeros(1, np.float32)
        }

    def forward(self, x: np.ndarray, starts: np.ndarray):
        """x: passages of all bags, one after the other; starts: where each bag begins."""
        p, sizes = self.p, np.diff(np.append(starts, len(x)))
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return score, (h, t, s, a, z, sizes)

    def gradient(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        score, (h, t, s, a, z, sizes) = self.forward(x, starts)
        err = ((score - y) / len(y)).astype(np.float32)
        dz = np.repeat(err[:, None] * p["c"], sizes, axis=0)
        da = (dz * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), sizes))
        dts = de[:, None] * p["w"]
        dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
        dh = (dz * a[:, None] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ err, "d": err.sum(keepdims=True)}

    def fit(
        self, bags: list[np.ndarray], y: np.ndarray, rng: np.random.Generator, epochs: int = 25, size: int = 64, rate: float = 3e-3,
        decay: float = 1e-5
    ) -> None:
        m = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in self.p.items()}
        turn = 0
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(bags), size):
                own = order[at : at + size]
                part = [bags[i] for i in own]
                starts = np.concatenate([[0], np.cumsum([len(b) for b in part])[:-1]])
                grad, turn = self.gradient(_scaled(np.concatenate(part)), starts, y[own]), turn + 1
                for k, g in grad.items():
                    one, two = m[k]
                    one += 0.1 * (g + decay * self.p[k] - one)
                    two += 0.001 * (g * g - two)
                    self.p[k] -= (rate * one / (1 - 0.9**turn) / (np.sqrt(two / (1 - 0.999**turn)) + 1e-8)).astype(np.float32)

    def score(self, texts: list[str | None]) -> np.ndarray:
        bags = [passages(t) for t in texts]
        if not bags:
            return np.zeros(0)
        starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
        return self.forward(_scaled(np.concatenate(bags)), starts)[0].astype(np.float64)


class Constant:
    """Where labels are of one kind or none: their smoothed share."""

    def __init__(self, share: float):
        self.share = share

    def score(self, texts: list[str | None]) -> np.ndarray:
        return np.full(len(texts), self.share)


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", folds: int = FOLDS, sample: int = SAMPLE,
    seed: int = SEED
):
    """A model from labelled documents outside the held-out fold: at most ``sample`` of them, those with the least hashes of the id and the seed."""
    prepare(docs.sparkSession)
    known = labels.filter(labels[label].isNotNull() & labels[doc_id].isNotNull() & (doc_crc(labels[doc_id]) % folds != 0))
    few = known.select(labels[doc_id].alias("_id"), labels[label].cast("double").alias("_y")).orderBy(F.xxhash64("_id", F.lit(seed)), "_id", "_y").limit(sample)

    def of(batches):
        for b in batches:
            bags = [passages(t) for t in b["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["_id"], b["_y"], pa.array([x.tobytes() for x in bags], pa.binary())], names=["_id", "_y", "bag"])

    ids = T.StructField("_id", docs.schema[doc_id].dataType)
    # the sample has at most ``sample`` rows of an id and a number, so it is small enough to broadcast
    joined = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text")).join(F.broadcast(few), "_id").select("_id", "_y", "_text")
    rows = joined.mapInArrow(of, T.StructType([ids, T.StructField("_y", T.DoubleType()), T.StructField("bag", T.BinaryType())]))
    # documents that share an id could be more than the sample; of those the least by bag are taken, whatever the order of tasks
    rows = sorted(rows.orderBy("_id", "_y", F.xxhash64("bag"), "bag").limit(2 * sample).collect(), key=lambda r: (str(r["_id"]), r["_y"], bytes(r["bag"])))
    y = np.array([r["_y"] >= 0.5 for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return Constant(float((y.sum() + 1) / (len(y) + 2)))
    rng = np.random.default_rng(seed)
    model = GatedAttention(rng)
    model.fit([np.frombuffer(r["bag"], np.uint8).reshape(-1, FEATURES) for r in rows], y, rng)
    return model


def score(docs: DataFrame, model, text: str = "text", doc_id: str = "doc_id", folds: int = FOLDS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row.

    A null text counts as empty; an empty text is one passage of its own kind. A null id counts as the empty text for the
    fold, so it is held out. Repeated rows get equal scores. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)

    def of(batches):
        Memo.only(_shapes)
        for b in batches:
            found = model.score(b["_text"].to_pylist())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(found, pa.float64())], names=["doc_id", "held_out", "score"])

    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())
    ])
    rows = docs.select(docs[doc_id].alias("doc_id"), (doc_crc(docs[doc_id]) % folds == 0).alias("held_out"), docs[text].alias("_text"))
    return rows.mapInArrow(of, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
