import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, m long, size string, ids string, score string, block string"


def rows_of(seed=1, n=60, long_words=3000):
    """Small documents with all odd cases: nulls in any column, empty and very long texts, repeats, near copies and shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Éa", "ça", "naïve", "x,", "12", "日本"]
    words = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage = words(60)
    texts = [words(rng.choice([1, 2, 5, 30, 80])) for _ in range(n)]
    texts[3] = texts[4] = words(90)
    texts[5] = texts[3].replace("w1", "w2", 1)
    for i in (7, 8, 9):
        texts[i] = f"{words(10)}\n{passage}\t{words(10)}"
    texts[10] = " ".join(["again"] * 120)
    texts[11], texts[12], texts[13], texts[14] = None, "", " \t\n ", words(long_words)
    texts[15] = f"{passage} {passage}"
    texts[16] = "!!! 123 ..."
    rows = [
        (i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "é", None]), None if t is None else len(t), 0, "x", None, "s", "b")
        for i, t in enumerate(texts)
    ]
    rows += [
        rows[3], rows[3], (None, texts[20], "en", "a", 5, 0, "", "", "", ""), (None, texts[20], "en", "a", 5, 0, "", "", "", ""),
        (None, None, None, None, None, None, None, None, None, None)
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows_of(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
