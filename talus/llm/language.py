"""Language ID by hierarchical discrimination: the family first, then one-versus-one linear SVMs inside it.

A word is the mean of hashed runs of one to four of its letters, lower-cased, with marks for its ends; a document is the mean of
its words, so a linear model's value for a document is the mean of its values for the words, which workers remember. Family and
pair models are linear SVMs (squared hinge) fitted in numpy on a sample: at most ``per_language`` documents of each language, on
average, chosen by a hash of the id. Every language is learned; beyond ``languages`` of them each gets fewer documents, so that
the sample grows no further, but no fewer than ``FEWEST``. Scoring reads whole texts.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.llm.common import ENTRY_BYTES, Memo, doc_crc, mix, prepare

DIM, GRAMS = 4096, 4
PER_LANGUAGE, LANGUAGES, FOLDS, HELD_OUT, SEED = 800, 16, 4, 2, "lang-1"
#: Letters-only words whose values a worker holds in a generation, in bytes.
VALUE_BYTES = 16 << 20
#: Documents of a language that many languages leave it; by chance, none are drawn for one in e**20.
FEWEST = 20
UNKNOWN = "und"
#: Families of language codes; a code that is not here is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "fo", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "baltic": ("lt", "lv"), "celtic": ("ga", "cy", "gd", "br"), "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tt"), "indic": ("hi", "bn", "ur", "mr", "gu", "pa", "ne", "si"),
    "iranian": ("fa", "ku", "ps", "tg"), "semitic": ("ar", "he", "am", "mt"), "sinitic": ("zh", "yue"),
    "austronesian": ("id", "ms", "tl", "jv"), "dravidian": ("ta", "te", "kn", "ml"),
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes}


def family(code: str) -> str:
    return _FAMILY.get(code.lower().split("-")[0].split("_")[0], code)


def letters_of(word: str) -> str:
    return (word if word.isalpha() else "".join(filter(str.isalpha, word))).lower()


def places(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words (none empty): places of all their features, the word of each, and each word's number of features."""
    code = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(words)), size)
    left = end[owner] - np.arange(len(code))  # characters to the word's end
    run, power = np.zeros(len(code), np.uint64), np.uint64(0x100000001B3)
    at, of = [], []
    for k in range(1, GRAMS + 1):
        run = run[: len(code) - k + 1] * power + code[k - 1 :]
        whole = np.flatnonzero(left[: len(run)] >= k)
        at.append(mix(run[whole] + np.uint64(k << 56))), of.append(owner[whole])
    factor = np.cumprod(np.full(int(size.max()), power, np.uint64))
    at.append(mix(np.add.reduceat(code * factor[left - 1], end - size))), of.append(np.arange(len(words)))
    of = np.concatenate(of)
    return (np.concatenate(at) % np.uint64(DIM)).astype(np.int64), of, np.bincount(of, minlength=len(words))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """The mean of the words' features."""
    count = Counter(w for w in map(letters_of, text.split()) if w)
    if not count:
        return np.zeros(DIM)
    at, of, size = places(list(count))
    times = np.fromiter(count.values(), np.float64, len(count))
    return np.bincount(at, (times / size)[of], DIM) / times.sum()


def svm(x: np.ndarray, y: np.ndarray, decay: float = 1e-3, turns: int = 150) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM with squared hinge, by accelerated gradient descent. y is -1 or 1, or 0 for rows that don't count; both classes weigh the same."""
    c = (np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * (y != 0)).astype(x.dtype)
    v, at = np.ones(x.shape[1], x.dtype), 1.0
    for _ in range(12):  # the largest curvature, by power iteration
        out = c * (x @ v + at)
        v, at = x.T @ out, float(out.sum())
        length = max(1e-12, float(np.sqrt((v**2).sum() + at**2)))
        v, at = v / length, at / length
    step = 1 / (2 * float((c * (x @ v + at) ** 2).sum()) * 1.1 + decay)
    w = ahead = np.zeros(x.shape[1], x.dtype)
    bias = bias_ahead = 0.0
    for k in range(turns):
        push = 2 * c * y * np.maximum(0, 1 - y * (x @ ahead + bias_ahead))
        new, new_bias = ahead - step * (decay * ahead - x.T @ push), bias_ahead - step * (decay * bias_ahead - float(push.sum()))
        far = k / (k + 3)
        w, ahead, bias, bias_ahead = new, new + far * (new - w), new_bias, new_bias + far * (new_bias - bias)
    return w, bias


class Hierarchy:
    """Linear models in one matrix: a column for each family (against the rest), then one for each pair within a family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family(c) for c in self.langs})
        own, fam = np.array(langs), np.array([family(c) for c in langs])
        x = np.asarray(x, np.float32)
        scale = 1 / (np.sqrt(np.einsum("ij,ij->j", x, x) / max(1, len(x))) + 1e-4) / np.sqrt(DIM)
        x *= scale.astype(np.float32)  # the sample's only copy
        self.pairs = [(a, b) for f in self.families for a, b in combinations([c for c in self.langs if family(c) == f], 2)]
        sides = [np.where(fam == f, 1, -1) if len(self.families) > 1 else np.zeros(len(x)) for f in self.families]
        sides += [(own == a) * 1 - (own == b) * 1 for a, b in self.pairs]
        fitted = [svm(x, y.astype(np.float32)) for y in sides]
        self.weights = np.stack([w for w, _ in fitted], axis=1).astype(np.float64) * scale[:, None] if fitted else np.zeros((DIM, 0))
        self.bias = np.array([b for _, b in fitted])

    def values(self, words: list[str]) -> np.ndarray:
        """Of words (letters only): what each adds to every column, bias aside."""
        at, of, size = places(words)
        order = np.argsort(of, kind="stable")
        return np.add.reduceat(self.weights[at[order]], np.cumsum(size) - size, axis=0) / size[:, None]

    def predict(self, values: np.ndarray) -> tuple[str, float]:
        """values: of the document for each column. The family of the largest value, then the language with most pairs won (then the larger sum, then the code's order)."""
        if not self.langs:
            return UNKNOWN, 0.0
        n = len(self.families)
        best = int(values[:n].argmax())
        rest = max((v for i, v in enumerate(values[:n]) if i != best), default=values[best] - 20)
        sure = 1 / (1 + np.exp(-np.clip(2 * (values[best] - rest), -30, 30)))
        members = [c for c in self.langs if family(c) == self.families[best]]
        won, total, least = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0), dict.fromkeys(members, 20.0)
        for (a, b), v in zip(self.pairs, values[n:], strict=True):
            if a in won:
                for c, m in ((a, v), (b, -v)):
                    won[c] += m > 0
                    total[c] += m
                    least[c] = min(least[c], m)
        lang = min(members, key=lambda c: (-won[c], -total[c], c))
        return lang, float(sure / (1 + np.exp(-np.clip(2 * least[lang], -30, 30))))


class WordValues:
    """A worker's memory of words' values, in two generations; words with the same letters share theirs, words without letters have none."""

    def __init__(self, model: Hierarchy):
        self.model = model
        self.place, self.rows, self.old = {"": 0}, np.zeros((1, len(model.bias))), ({}, None)

    def learn(self, words: set[str]) -> None:
        """Afterwards these words are known."""
        if ENTRY_BYTES * len(self.place) + self.rows.nbytes > VALUE_BYTES:
            self.old, self.place, self.rows = (self.place, self.rows), {"": 0}, np.zeros((1, len(self.model.bias)))
        place, (before, values) = self.place, self.old
        new = {w: letters_of(w) for w in words if w not in place}
        fresh = {x for x in new.values() if x not in place}
        kept = [x for x in fresh if x in before]
        fresh = [x for x in fresh if x not in before]
        place.update(zip([*kept, *fresh], range(len(self.rows), len(self.rows) + len(kept) + len(fresh)), strict=True))
        more = ([values[[before[x] for x in kept]]] if kept else []) + ([self.model.values(fresh)] if fresh else [])
        self.rows = np.concatenate([self.rows, *more])
        place.update((w, place[x]) for w, x in new.items())

    def mean(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        return self.rows[at].sum(axis=0) / max(1, np.count_nonzero(at))


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
    per_language: int = PER_LANGUAGE, languages: int = LANGUAGES, folds: int = FOLDS, held_out: int = HELD_OUT,
) -> Hierarchy:
    """A model from documents with a language, a letter and an id outside the held-out fold.

    The sample's rows are drawn by hashes of id and text; the driver holds them as one matrix of DIM single-precision numbers a
    row, 200 MB for up to ``languages`` languages, and beyond them 0.3 MB for each language that FEWEST documents stand for.
    """
    prepare(docs.sparkSession)
    rows = docs.select(docs[doc_id].cast("string").alias("_id"), docs[lang].alias("_lang"), docs[text].alias("_text"))
    rows = rows.filter("_lang is not null and _text is not null").filter(doc_crc(F.col("_id")) % folds != held_out)
    count = {r["_lang"]: r["n"] for r in rows.groupBy("_lang").agg(F.count("*").alias("n")).collect()}
    if not count:
        return Hierarchy(np.zeros((0, DIM)), [])
    per_language = min(per_language, max(FEWEST, per_language * languages // len(count)))
    share = F.create_map(*[F.lit(x) for c, n in count.items() for x in (c, min(1.0, per_language / n))])
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), "_id", F.xxhash64("_text")).cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)

    def of(batches):
        for b in batches:
            texts = b["_text"].to_pylist()
            known = [i for i, t in enumerate(texts) if has_letter(t)]
            values = [features(texts[i]) for i in known]
            at = [np.flatnonzero(x) for x in values]
            own = b.take(pa.array(known, pa.int64()))
            cols = [
                pa.array([a.astype(np.uint16).tobytes() for a in at], pa.binary()),
                pa.array([x[a].astype(np.float32).tobytes() for a, x in zip(at, values, strict=True)], pa.binary())
            ]
            yield pa.RecordBatch.from_arrays([own["_draw"], own["_id"], own["_lang"], *cols], names=["_draw", "_id", "_lang", "at", "value"])

    drawn_rows = rows.withColumn("_draw", drawn).filter(F.col("_draw") < F.coalesce(share[F.col("_lang")], F.lit(0.0)))
    sample = drawn_rows.mapInArrow(of, "_draw double, _id string, _lang string, at binary, value binary")
    # the limit matters only where rows repeat in id and text; it takes the same rows in every run
    sample = sample.orderBy("_draw", "_id", "_lang").limit(2 * per_language * len(count)).collect()
    sample = sorted(sample, key=lambda r: (r["_id"] or "", r["_lang"], bytes(r["at"]), bytes(r["value"])))
    x = np.zeros((len(sample), DIM), np.float32)
    for row, r in zip(x, sample, strict=True):
        row[np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["value"], np.float32)
    return Hierarchy(x, [r["_lang"] for r in sample])


def predict(docs: DataFrame, model: Hierarchy, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in keep, lang_pred and score for every row.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned. Repeated rows get equal results. An
    empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    if clash := {"lang_pred", "score"} & set(keep):
        raise ValueError(f"keep names columns of the result: {sorted(clash)}")

    def of(batches):
        Memo.only()
        known = WordValues(model)
        for b in batches:
            langs, scores = [], []
            texts = [t.split() if has_letter(t) else None for t in b["_text"].to_pylist()]
            known.learn({w for t in texts if t for w in t})
            for words in texts:
                one, sure = model.predict(known.mean(words) + model.bias) if words else (UNKNOWN, 0.0)
                langs.append(one), scores.append(sure)
            cols = [*[b[f"_keep{i}"] for i in range(len(keep))], pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "lang_pred", "score"])

    fields = [T.StructField(c, docs.schema[c].dataType) for c in keep]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(*[docs[c].alias(f"_keep{i}") for i, c in enumerate(keep)], docs[text].alias("_text")).mapInArrow(of, schema)
