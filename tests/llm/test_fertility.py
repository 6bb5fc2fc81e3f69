"""Quality rules, against plain code."""

import base64
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from talus.llm import fertility, queries
from tests.conftest import SMALL

SPACE = " \t\n\x0b\x0c\r"


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, twice = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            twice += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), twice, len(covered)


@pytest.fixture(scope="module")
def libraries():
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def broken(i):
        try:
            own.decode_single_token_bytes(i).decode()
        except UnicodeDecodeError:
            return True
        return False

    cut = lambda w: [w[i : i + 512] for i in range(0, len(w), 512)]
    return {
        "piece": lambda words: [(i, pieces.is_byte(i)) for w in words for p in cut(w) for i in pieces.encode(p)],
        "rank": lambda words: [(i, broken(i)) for w in words for p in cut(w) for i in own.encode_ordinary(" " + p)],
    }


def told(text, encode):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    tokens = encode(words)
    if not tokens:
        return 0, 0, 0, 0
    n = len(tokens)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(i for i, _ in tokens).values())
    return n, sum(map(len, words)) * 1000 // n, sum(b for _, b in tokens) * 1_000_000 // n, 1000 * entropy


def same(found, plain):
    return found[:3] == plain[:3] and abs(found[3] - plain[3]) <= 1


def test_base_counts_and_measures(spark, odd, libraries):
    rows = {(r["doc_id"], r["text"]) for r in odd.collect()}
    extra = {(900, "日本語 テスト ☃☃ 𝔘"), (901, "a\n\na\n \nb\na"), (902, "z" * 1300), (903, "a\xa0b\x1cc a\xa0b\x1cc d a\xa0b\x1cc"), (904, "x y x y x y")}
    df = spark.createDataFrame(sorted(rows | extra, key=repr), "doc_id long, text string").repartition(3)
    found = Counter()
    for r in fertility.measured(df, queries.vocabularies()).collect():
        found[(r["doc_id"],) + tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))] += 1
        text = [t for i, t in rows | extra if i == r["doc_id"] and base(t)[:2] == (r["n_words"], r["word_chars"])][0]
        for v in ("piece", "rank"):
            assert same(tuple(r[f"{v}_{c}"] for c in ("tokens", "chars", "bytes", "entropy")), told(text, libraries[v])), (text, v)
    assert found == Counter((i,) + base(t) for i, t in rows | extra)


def verdicts(rows):
    """Bands from sorted lists of each group, and what lies outside them."""
    values = defaultdict(list)
    for r in rows:
        for v in ("piece", "rank"):
            for m in fertility.MOST:
                if r["piece_tokens"]:
                    values[r["lang"], r["script"], v, m].append(min(r[f"{v}_{m}"], fertility.MOST[m]) // fertility.STEP[m])
    out = []
    for r in rows:
        bad = []
        for v in ("piece", "rank"):
            for m in fertility.MOST:
                x = sorted(values[r["lang"], r["script"], v, m])
                if not x:
                    continue
                q1, q2, q3 = ((x[math.ceil(len(x) * s) - 1] + 0.5) * fertility.STEP[m] for s in (0.25, 0.5, 0.75))
                reach = max(fertility.FENCE * (q3 - q1), fertility.FLOORS[m] * (1e6 if m == "bytes" else q2))
                value = r[f"{v}_{m}"]
                low = m != "bytes" and value < q1 - reach and (m == "chars" or value < 700 * math.log2(max(1, r[f"{v}_tokens"])))
                if low or (m != "entropy" and value > q3 + reach):
                    bad.append(f"{v}_{m}")
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        out.append((r["doc_id"], failed, bad, not failed and not bad))
    return sorted(out, key=repr)


def test_verdicts_on_the_small_table(spark, libraries):
    out = queries.QUERIES["op13_quality_rules"](spark, SMALL).collect()
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SMALL}/documents.parquet'").fetchall()
    by_id = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows)
    for i, text, lang in rows:
        r = by_id[i]
        assert (r["lang"], r["script"]) == (lang, "Latin")
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == base(text)
        assert all(same(tuple(r[f"{v}_{c}"] for c in ("tokens", "chars", "bytes", "entropy")), told(text, libraries[v])) for v in libraries)
    assert sorted(((r["doc_id"], r["base_failed"], r["rejected"], r["kept"]) for r in out), key=repr) == verdicts(out)


def test_junk_goes_and_clean_documents_stay(spark):
    out = {r["doc_id"]: r for r in fertility.rules(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), queries.vocabularies()).collect()}
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet' WHERE doc_id IS NOT NULL").fetchall()
    some = [(q, out[i]["kept"]) for i, q in labels if i in out and not out[i]["base_failed"]]
    good, bad = [k for q, k in some if q == 1], [k for q, k in some if q == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.5


def test_odd_rows(spark, odd, none):
    out = fertility.rules(odd, queries.vocabularies())
    assert sorted(((r["doc_id"], r["base_failed"], r["rejected"], r["kept"]) for r in out.collect()), key=repr) == verdicts(out.collect())
    assert out.count() == odd.count() and fertility.rules(none, queries.vocabularies()).count() == 0
    without = fertility.rules(odd.drop("lang"), queries.vocabularies()).collect()
    assert len(without) == odd.count() and {r["lang"] for r in without} == {None}


def test_one_word_more_often_than_numbers_fit_and_long_texts(spark):
    rng = random.Random(5)
    words = [str(rng.randrange(1 << 40)) for _ in range(1_100_000)]  # more kinds than three fit in 63 bits
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    import numpy as np

    ids = np.array([known[w] for w in words + words[500:503] + words[:2]], np.int64)
    assert fertility.repeated_words(ids, len(known) + 1) == 6
    text = " ".join(words[:400_000] + words[:10])  # beyond an Arrow batch
    df = spark.createDataFrame([(1, text), (2, "y" * 5_000_000)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in fertility.rules(df, queries.vocabularies()).collect()}
    assert rows[1]["n_words"] == 400_010 and rows[1]["n_repeat_words"] == 20 and rows[2]["word_chars"] == 5_000_000 and rows[2]["base_failed"]


@pytest.mark.parametrize("text, name", [("abc", "Latin"), ("", "Latin"), ("привет a", "Cyrillic"), ("日本語の文", "Han"), ("ひらがな", "Kana"), ("123 !", "Latin")])
def test_script(text, name):
    assert fertility.script(text) == name
