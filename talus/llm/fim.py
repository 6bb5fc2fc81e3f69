"""Fill-in-the-middle transformation over ropes.

A rope is a height-balanced tree whose leaves hold bounded pieces of a text; every node caches how many units (lines) end in it and
how many code points it has. A document is split at two unit ranks, the parts are concatenated in another order with sentinels
between them, and the form is inverted by splitting the tree of the output at the sentinels' places. Splitting and concatenating
touch a path of the tree each, not the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.llm.common import prepare

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Fixed values of the registered query: the salt of a document's draws and the shares in per cent of transformed and of spm documents.
SEED, RATE, SPM = 7, 100, 50
LEAF = 4096


class Node(NamedTuple):
    """text: a leaf's piece, else None. units: units that end in it. chars: code points."""

    units: int
    chars: int
    height: int
    text: str | None
    left: Node | None = None
    right: Node | None = None


def leaf(text: str, last: bool = False) -> Node | None:
    """A leaf; the last one of a text ends a unit that has no line break."""
    return Node(text.count("\n") + (last and text[-1] != "\n"), len(text), 0, text) if text else None


def _over(left: Node, right: Node) -> Node:
    return Node(left.units + right.units, left.chars + right.chars, max(left.height, right.height) + 1, None, left, right)


def concat(left: Node | None, right: Node | None) -> Node | None:
    """One balanced rope of two; only nodes on the border between them are made anew."""
    if left is None or right is None:
        return right if left is None else left
    if abs(left.height - right.height) < 2:
        return _over(left, right)
    if left.height > right.height:
        inner = concat(left.right, right)
        if inner.height <= left.left.height + 1:
            return _over(left.left, inner)
        if inner.left.height > inner.right.height:
            return _over(_over(left.left, inner.left.left), _over(inner.left.right, inner.right))
        return _over(_over(left.left, inner.left), inner.right)
    inner = concat(left, right.left)
    if inner.height <= right.right.height + 1:
        return _over(inner, right.right)
    if inner.right.height > inner.left.height:
        return _over(_over(inner.left, inner.right.left), _over(inner.right.right, right.right))
    return _over(inner.left, _over(inner.right, right.right))


def rope(text: str, size: int = LEAF) -> Node | None:
    """The rope of a text, built level by level from its leaves."""
    level = [leaf(text[i : i + size], i + size >= len(text)) for i in range(0, len(text), size)]
    while len(level) > 1:
        level = [_over(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        if len(level) > 1 and level[-1].height < level[-2].height:  # an odd node out joins its neighbour, so heights differ by one at most
            level[-2:] = [concat(level[-2], level[-1])]
    return level[0] if level else None


def _cut(node: Node, rank: int, by_units: bool) -> int:
    """Where in a leaf the given number of units has ended, or of code points has passed."""
    if not by_units:
        return rank
    at = -1
    for _ in range(rank):
        at = node.text.find("\n", at + 1)
        if at < 0:
            return len(node.text)  # the unit that the text's end closes
    return at + 1


def split(node: Node | None, rank: int, by_units: bool = False) -> tuple[Node | None, Node | None]:
    """Two ropes: the first ``rank`` units (or code points), and the rest."""
    if node is None or rank <= 0:
        return None, node
    if not by_units and rank >= node.chars:
        return node, None
    if node.text is not None:
        at = _cut(node, rank, by_units)
        ends = node.units - node.text.count("\n")  # 1 in the leaf that closes a text without a line break
        head, tail = node.text[:at], node.text[at:]
        first = Node(head.count("\n") + (0 if tail else ends), len(head), 0, head) if head else None
        return first, Node(tail.count("\n") + ends, len(tail), 0, tail) if tail else None
    before = node.left.units if by_units else node.left.chars
    if rank <= before:
        first, rest = split(node.left, rank, by_units)
        return first, concat(rest, node.right)
    first, rest = split(node.right, rank - before, by_units)
    return concat(node.left, first), rest


def pieces(node: Node | None) -> Iterator[str]:
    """The texts of the leaves, left to right."""
    stack = [node] if node else []
    while stack:
        node = stack.pop()
        if node.text is not None:
            yield node.text
        else:
            stack += (node.right, node.left)


def text_of(node: Node | None) -> str:
    return "".join(pieces(node))


def chars(node: Node | None) -> int:
    return node.chars if node else 0


def rearranged(text: str, draws: tuple[int, int, int, int], rate: int = RATE, spm: int = SPM, size: int = LEAF):
    """n, form, code points of prefix and middle, output."""
    whole = rope(text, size)
    n = whole.units if whole else 0
    if not text or draws[2] % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    low, high = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    rest, suffix = split(whole, high, True)
    prefix, middle = split(rest, low, True)
    form = "spm" if draws[3] % 100 < spm else "psm"
    order = ((SUFFIX, suffix), (PREFIX, prefix), (MIDDLE, middle)) if form == "spm" else ((PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle))
    out = None
    for sign, part in order:
        out = concat(concat(out, leaf(sign)), part)
    return n, form, chars(prefix), chars(middle), text_of(out)


def restored(output: str, form: str, size: int = LEAF) -> str:
    """The text of an output: its rope is split at the sentinels' places, and the parts are put back in order.

    A transformed text holds no sentinel itself, and none can arise at a border, since each begins with its only "<" and ends with its
    only ">"; so the three that are found are those that were put in.
    """
    if form == "plain":
        return output
    tree, part = rope(output, size), {}
    signs = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    places = [output.index(s) for s in signs]
    for sign, at in reversed(list(zip(signs, places, strict=True))):
        tree, tail = split(tree, at)
        part[sign] = split(tail, len(sign))[1]
    return text_of(concat(concat(part[PREFIX], part[MIDDLE]), part[SUFFIX]))


def draw(doc_id: Column, seed: int, group: int) -> Column:
    """A group of eight hex digits of the sha256 of seed and id, as an unsigned number; a null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = SEED, rate: int = RATE, spm: int = SPM, leaf_chars: int = LEAF
) -> DataFrame:
    """doc_id, n (lines), form (plain, psm or spm), prefix_chars, middle_chars, output and restored_text for every row.

    A null text counts as empty; empty texts and those that hold a sentinel stay as they are, with null counts of code points. A text
    of one line may have an empty prefix, middle or suffix. Draws depend on seed and id alone: rows that share an id share draws, a
    null id counts as the empty text. Restored texts are made from output and form only. Other columns are not read, whatever their
    names. A very long text is held by one task, as its row is. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored_text"]
    kinds = [None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def of(batches):
        for b in batches:
            draws = zip(*(b[f"h{i}"].to_pylist() for i in range(4)), strict=True)
            rows = [rearranged(t or "", h, rate, spm, leaf_chars) for t, h in zip(b["_text"].to_pylist(), draws, strict=True)]
            columns = list(zip(*(r + (restored(r[4], r[1], leaf_chars),) for r in rows), strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([b["doc_id"], *(pa.array(c, k) for c, k in zip(columns, kinds[1:], strict=True))], names=names)

    long = T.LongType()
    types = [docs.schema[doc_id].dataType, long, T.StringType(), long, long, T.StringType(), T.StringType()]
    h = [draw(docs[doc_id], seed, i).alias(f"h{i}") for i in range(4)]
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("_text"), *h)
    return rows.mapInArrow(of, T.StructType([T.StructField(c, t) for c, t in zip(names, types, strict=True)]))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (
  SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
    ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM d),
c AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS lo, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS hi,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
         WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, array_to_string(u[1:lo], '') AS a, array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:n], '') AS z FROM c)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(a) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
    ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""
