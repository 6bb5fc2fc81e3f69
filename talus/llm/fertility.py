"""Quality rules by tokeniser fertility.

The words of a text are tokenised with public vocabularies. For each vocabulary a document has three measures: code points a token,
the share of tokens that are no whole characters (byte fallback), and the entropy of its tokens. Whole documents stand in groups of
one language and script; a group's quartiles of each measure, counted over all of its documents, set bands, and what lies outside a
band is rejected. Base rules on words, symbols, lines and repeats come first.

Measures are whole numbers: thousandths of code points a token, millionths of tokens, thousandths of bits.
"""

from __future__ import annotations

import base64
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.llm.common import prepare, split_words, staged

#: Fixed values of the registered query's base rules: signs that count as symbols, least words, and per cent of repeated words allowed.
SYMBOLS, LEAST_WORDS, MOST_REPEATED = "#*$%&|<>", 50, 50
SPACES = " \t\n\x0b\x0c\r"
#: Words are tokenised in parts of so many code points, since some libraries take quadratic time for longer ones.
PART = 512
#: A band reaches from the quartiles by FENCE times their distance, and at least by FLOOR (a share of the median, or of all tokens).
FENCE, FLOORS = 3.0, {"chars": 0.05, "bytes": 0.03, "entropy": 0.15}
#: Entropy is too low only where it is also below this share of what as many different tokens would have.
EVEN = 0.70
#: Values of a measure that are told apart; beyond them is one more class.
MOST = {"chars": 20_000, "bytes": 1_000_000, "entropy": 40_000}
STEP = {"chars": 5, "bytes": 500, "entropy": 10}

#: First code points of ranges and the scripts they start: fixed values.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0900, "Indic"), (0x0E00, "Thai"), (0x0E80, "other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "other"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "other"), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"),
    (0xA000, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "other"), (0x20000, "Han"), (0x32000, "other"),
)
_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS, _KIND = np.array([s for s, _ in SCRIPTS]), np.array([_NAMES.index(n) for _, n in SCRIPTS])


class Vocabulary(NamedTuple):
    """name: of its columns. path: a .model (pieces) or .tiktoken (byte ranks) file, there on every machine. pattern: what cuts words for ranks."""

    name: str
    path: str
    pattern: str = r"\S+"


@cache
def loaded(v: Vocabulary):
    """Ids of words, one list for each, and for every id whether it is no whole character."""
    if v.path.endswith(".tiktoken"):
        import tiktoken

        with open(v.path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        own = tiktoken.Encoding(v.name, pat_str=v.pattern, mergeable_ranks=ranks, special_tokens={})
        part = np.ones(max(ranks.values()) + 1, bool)
        for piece, at in ranks.items():
            try:
                piece.decode()
                part[at] = False
            except UnicodeDecodeError:
                pass
        encode = own.encode_ordinary
        return lambda words: [encode(" " + w) for w in words], part
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=v.path)
    return lambda words: own.encode(words, num_threads=1), np.array([own.is_byte(i) for i in range(own.vocab_size())])


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words within runs of three that occur twice or more, the first included."""
    n = len(ids)
    if n < 4:
        return 0
    pair, wide = ids[:-1] * kinds + ids[1:], kinds
    if kinds > 1 << 20:  # three numbers wouldn't fit 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    run = pair[:-1] * wide + ids[2:]
    order = np.argsort(run, kind="stable")
    same = run[order][1:] == run[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for lag in range(3):
        covered[lag : n - 2 + lag] |= twice
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def script(text: str) -> str:
    """The script of most code points above the signs and digits; Latin where there is none."""
    if not text or text.isascii():
        return "Latin"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points[points > 0x40]
    if not len(points):
        return "Latin"
    return _NAMES[np.bincount(_KIND[np.searchsorted(_STARTS, points, "right") - 1], minlength=len(_NAMES)).argmax()]


def base_counts(texts: list[str]) -> tuple[list[tuple], list[bytes], np.ndarray, np.ndarray]:
    """Base counts of each text, the different words of all, each word's number in order of the texts, and each text's words."""
    known: dict[bytes, int] = {}
    ids, sizes = [], []
    for text in texts:
        words = split_words(text)
        sizes.append(len(words))
        ids.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
    rows = []
    for text, own in zip(texts, ids, strict=True):
        spaces = sum(map(text.count, SPACES))
        rows.append((len(own), len(text) - spaces, sum(map(text.count, SYMBOLS)), repeated_lines(text), repeated_words(own, len(known) + 1)))
    return rows, list(known), np.concatenate([np.zeros(0, np.int64), *ids]), np.array(sizes, np.int64)


def measures(words: list[bytes], ids: np.ndarray, sizes: np.ndarray, chars: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, ...]:
    """Tokens, code points a token, byte fallback and entropy of each text. Every different word is tokenised once."""
    encode, partial = loaded(vocabulary)
    texts = [w.decode("utf-8", "replace") for w in words]
    parts = [w[i : i + PART] for w in texts for i in range(0, len(w), PART)]
    count = np.array([-(-len(w) // PART) for w in texts], np.int64)
    coded = encode(parts) if parts else []
    per_part = np.fromiter(map(len, coded), np.int64, len(coded))
    flat = np.fromiter((i for x in coded for i in x), np.int64, int(per_part.sum()))
    ends = np.cumsum(np.concatenate([[0], per_part]))[np.cumsum(np.concatenate([[0], count]))]  # where each word's tokens begin
    length = np.diff(ends)
    bytes_before = np.concatenate([[0], np.cumsum(partial[flat])])
    of_word = bytes_before[ends[1:]] - bytes_before[ends[:-1]]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    tokens = np.bincount(owner, length[ids], len(sizes)).astype(np.int64)
    fallback = np.bincount(owner, of_word[ids], len(sizes)).astype(np.int64)
    some = np.maximum(tokens, 1)
    entropy = np.zeros(len(sizes), np.int64)
    # entropy: the tokens of a text in order, counted; texts one after the other, so that a batch's tokens are never all unfolded
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for i in np.flatnonzero(tokens):
        own = ids[starts[i] : starts[i + 1]]
        size = length[own]
        at = np.repeat(ends[:-1][own] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        c = np.bincount(flat[at]) if len(at) > 20_000 else np.unique(flat[at], return_counts=True)[1]
        p = c[c > 0] / len(at)
        entropy[i] = round(-1000 * float((p * np.log2(p)).sum()))
    return tokens, chars * 1000 // some, fallback * 1_000_000 // some, entropy


def _measured(vocabularies: tuple[Vocabulary, ...]):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def of(batches):
        for b in batches:
            texts = [t or "" for t in b["_text"].to_pylist()]
            rows, words, ids, sizes = base_counts(texts)
            base = np.array(rows, np.int64).reshape(len(rows), len(names))
            columns = {"doc_id": b["doc_id"], "lang": b["lang"], "script": pa.array(map(script, texts), pa.string())}
            columns |= {c: pa.array(base[:, i]) for i, c in enumerate(names)}
            for v in vocabularies:
                found = measures(words, ids, sizes, base[:, 1], v)
                columns |= {f"{v.name}_{c}": pa.array(x) for c, x in zip(("tokens", *MOST), found, strict=True)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return of


def measured(docs: DataFrame, vocabularies: tuple[Vocabulary, ...], text: str = "text", doc_id: str = "doc_id", lang: str | None = "lang") -> DataFrame:
    """Base counts and measures of every row, with its language (null if there is no such column) and script."""
    prepare(docs.sparkSession)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    counts += [f"{v.name}_{c}" for v in vocabularies for c in ("tokens", *MOST)]
    fields = [T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("lang", T.StringType()), T.StructField("script", T.StringType())]
    language = (docs[lang] if lang in docs.columns else F.lit(None)).cast("string").alias("lang")
    rows = docs.select(docs[doc_id].alias("doc_id"), language, docs[text].alias("_text"))
    return rows.mapInArrow(_measured(vocabularies), T.StructType(fields + [T.StructField(c, T.LongType()) for c in counts]))


def _group() -> Column:
    return F.concat_ws(":", F.coalesce("lang", F.lit("")), "script").alias("group")


def bands(found: DataFrame, vocabularies: tuple[Vocabulary, ...], fence: float = FENCE) -> DataFrame:
    """group, measure, low and high: a row for each language and script, vocabulary and measure.

    Quartiles are of all documents that have tokens, counted in steps, so a group of any size is a table of some thousand steps.
    """
    each = []
    for v in vocabularies:
        for m in MOST:
            step = F.floor(F.least(F.col(f"{v.name}_{m}"), F.lit(MOST[m])) / STEP[m]).cast("int")
            each.append(F.struct(F.lit(f"{v.name}_{m}").alias("measure"), F.lit(m).alias("kind"), step.alias("step")))
    steps = found.filter(F.col(f"{vocabularies[0].name}_tokens") > 0).select(_group(), F.explode(F.array(*each)).alias("x"))
    steps = steps.groupBy("group", "x.measure", "x.kind", "x.step").agg(F.count("*").alias("n"))
    of = Window.partitionBy("group", "measure")
    so_far = F.sum("n").over(of.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    steps = steps.withColumn("upto", so_far).withColumn("all", F.sum("n").over(of))
    quartile = lambda share: F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("step")))
    of_kind = lambda values: F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("kind"))
    q = steps.groupBy("group", "measure", "kind").agg(quartile(0.25).alias("q1"), quartile(0.5).alias("q2"), quartile(0.75).alias("q3"))
    size = of_kind({k: float(s) for k, s in STEP.items()})
    q = q.select("group", "measure", "kind", *[((F.col(c) + 0.5) * size).alias(c) for c in ("q1", "q2", "q3")])
    least = F.when(F.col("kind") == "bytes", 1e6 * FLOORS["bytes"]).otherwise(F.col("q2") * of_kind({k: v for k, v in FLOORS.items()}))
    reach = F.greatest(fence * (F.col("q3") - F.col("q1")), least)
    low = F.when(F.col("kind") != "bytes", F.col("q1") - reach)
    high = F.when(F.col("kind") != "entropy", F.col("q3") + reach)
    return q.select("group", "measure", low.alias("low"), high.alias("high"))


def rules(
    docs: DataFrame, vocabularies: tuple[Vocabulary, ...], text: str = "text", doc_id: str = "doc_id", lang: str | None = "lang",
    fence: float = FENCE, least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED
) -> DataFrame:
    """Base counts, measures, base_failed, rejected (measures outside their bands) and kept for every row.

    A null or empty text has no words: it fails the base rules, and its measures are 0. Rows without a language stand in groups of
    their script, as all rows do where there is no such column. A group of one document is its own median and is kept. Repeated rows
    get equal verdicts. Other columns are not read, whatever their names. A very long text is held by one task, as its row is; its
    words are tokenised once each. An empty table gives an empty result.
    """
    found = staged(measured(docs, vocabularies, text, doc_id, lang), "measured")
    names = [f"{v.name}_{m}" for v in vocabularies for m in MOST]
    entries = lambda c: F.map_from_entries(F.collect_list(F.struct("measure", c))).alias(f"{c}s")
    limits = staged(bands(found, vocabularies, fence).groupBy("group").agg(entries("low"), entries("high")), "bands")
    rows = found.withColumn("group", _group()).join(limits, "group", "left")  # a row for each language and script: Spark sees the table's size

    def outside(name: str) -> Column:
        value, low, high = F.col(name), F.element_at("lows", name), F.element_at("highs", name)
        below = value < low
        if name.endswith("_entropy"):
            tokens = F.col(name.removesuffix("entropy") + "tokens")
            below = below & (value < 1000 * EVEN * F.log2(tokens.cast("double")))
        return F.when(below | F.coalesce(value > high, F.lit(False)) if name.endswith(("_chars", "_entropy")) else value > high, F.lit(name))

    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumn("rejected", F.array_compact(F.array(*[outside(n) for n in names])))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.size("rejected") == 0))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    tokens = [f"{v.name}_tokens" for v in vocabularies]
    return rows.select("doc_id", "lang", "script", *base, *tokens, *names, "base_failed", "rejected", "kept")
