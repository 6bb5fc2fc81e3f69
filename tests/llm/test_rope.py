"""Fill-in-the-middle over ropes, against plain slicing."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from talus.llm import fim

TEXTS = st.text(alphabet="ab\né<>PSM日 \r", max_size=60)


def plain(text, doc_id, seed=7, rate=100, spm=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    a, m, z = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    spm = h[3] % 100 < spm
    return len(units), "spm" if spm else "psm", len(a), len(m), f"<S>{z}<P>{a}<M>{m}" if spm else f"<P>{a}<S>{z}<M>{m}"


def heights(node):
    """The height, with every node's balance tested."""
    if node is None or node.text is not None:
        return 0
    left, right = heights(node.left), heights(node.right)
    assert abs(left - right) < 2 and node.height == max(left, right) + 1
    assert node.chars == node.left.chars + node.right.chars and node.units == node.left.units + node.right.units
    return node.height


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 7), st.integers(0, 70), st.booleans())
def test_split_and_concat(text, size, rank, by_units):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    tree = fim.rope(text, size)
    heights(tree)
    assert fim.text_of(tree) == text and (tree.units if tree else 0) == len(units)
    left, right = fim.split(tree, rank, by_units)
    told = ("".join(units[:rank]), "".join(units[rank:])) if by_units else (text[:rank], text[rank:])
    assert (fim.text_of(left), fim.text_of(right)) == told
    heights(left), heights(right)
    again = fim.concat(right, left)
    heights(again)
    assert fim.text_of(again) == told[1] + told[0]


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(0, 1 << 30), st.integers(1, 9))
def test_equals_slicing_and_comes_back(text, doc_id, size):
    digest = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    found = fim.rearranged(text, tuple(int(digest[8 * i : 8 * i + 8], 16) for i in range(4)), size=size)
    assert found == plain(text, doc_id) and fim.restored(found[4], found[1], size) == text


@pytest.mark.parametrize("rate, spm", [(100, 50), (60, 30), (0, 50)])
def test_rows(odd, rate, spm):
    out = fim.fill_in_middle(odd, rate=rate, spm=spm, leaf_chars=50).collect()
    told = sorted(((r["doc_id"],) + plain(r["text"] or "", r["doc_id"], 7, rate, spm) + (r["text"] or "",) for r in odd.collect()), key=repr)
    assert sorted(map(tuple, out), key=repr) == told


def test_long_texts_shallow_trees_and_empty_tables(spark, none):
    rng = random.Random(3)
    text = "".join(rng.choice("ab é\n") for _ in range(6_000_000))
    assert fim.rope(text).height < 13
    one = fim.rope("x" * 50_000, 1)  # concatenation of uneven trees stays balanced
    for at in (1, 2, 77, 49_999):
        a, b = fim.split(one, at)
        assert heights(fim.concat(b, a)) < 1.45 * 17
    df = spark.createDataFrame([(1, text), (2, "x" * 5_000_000), (3, "a<S>\nb"), (4, "\n\n")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in fim.fill_in_middle(df).collect()}
    for i, t in ((1, text), (2, "x" * 5_000_000), (3, "a<S>\nb"), (4, "\n\n")):
        assert tuple(out[i])[1:6] == plain(t, i) and out[i]["restored_text"] == t
    assert out[3]["form"] == "plain" and fim.fill_in_middle(none).count() == 0
