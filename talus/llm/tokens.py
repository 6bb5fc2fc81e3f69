"""Token ids in files: Re-Pair grammar compression of shards of documents.

Documents are dealt by ranges of doc_id, tokenized, and stored shard by shard in Parquet rows. A shard replaces its most
frequent pairs of neighbouring ids by nonterminals, round after round; it stores the rules, their expansion lengths and where
each document's symbols begin, so one document is decoded without the others. No rule reaches over a document's end.

A shard's bytes: magic, crc32 of what follows, then counts (first nonterminal, rules, symbols, documents), the widths in bits of
symbols, lengths and places, and the arrays: left and right of each rule, its expansion length, the symbols, first symbol of each
document, first id of each document. An array holds its numbers' low bits as whole 16-bit and 8-bit words, little-endian, and each
of the bits that are left as a row of bits.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from itertools import count as count_up

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.llm.common import Memo, new_path, prepare

MAGIC, HEAD = b"TRP2", struct.Struct("<IIQQBBB")
#: Rounds of pair replacement: None goes on until no pair is left that occurs LEAST times.
END, ROUNDS, PAIRS, LEAST = 2, None, 65_536, 6
#: Bytes of a generation of remembered words, and of parts of words.
WORD_BYTES, PART_BYTES, BITS = 192 << 20, 96 << 20, 20
#: Ids of a shard; a task holds one shard at a time.
SHARD = 1 << 20


def slot(key: np.ndarray) -> np.ndarray:
    return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).view(np.int64)


def ragged(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of an array, one after the other."""
    at = np.cumsum(size) - size
    return flat[np.repeat(begin - at, size) + np.arange(size.sum())]


def expanded(left: np.ndarray, right: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rules, one rule after the other, and each rule's number of them."""
    symbols, owner = np.stack([left, right], axis=1).ravel().astype(np.int64), np.repeat(np.arange(len(left)), 2)
    while (rule := symbols >= base).any():
        size = 1 + rule
        first = (np.cumsum(size) - size)[rule]
        inner = symbols[rule] - base
        symbols, owner = np.repeat(symbols, size), np.repeat(owner, size)
        symbols[first], symbols[first + 1] = left[inner], right[inner]
    return symbols, np.bincount(owner, minlength=len(left))


def repair(ids: np.ndarray, ends: np.ndarray, base: int, rounds: int | None = ROUNDS, pairs: int = PAIRS, least: int = LEAST):
    """Symbols, rules (a row of two symbols each) and the places of documents' first symbols. ids: below base. ends: last place of each document."""
    seq, rules = ids.astype(np.int64), [np.zeros((0, 2), np.int64)]
    last = np.zeros(len(seq), bool)
    last[ends] = True
    count = 0
    live = np.flatnonzero(~last[:-1])  # places whose pair may be frequent: one of old symbols that isn't won't be later
    for _ in count_up() if rounds is None else range(rounds):
        if not len(live):
            break
        key = seq[live] << 32 | seq[live + 1]
        slots = slot(key)
        common = (np.bincount(slots, minlength=1 << BITS) >= least)[slots]  # a pair is no more frequent than its slot
        live, key, slots = live[common], key[common], slots[common]
        order = np.sort(key)
        if not len(order):
            break
        new = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]]))
        often = np.diff(np.append(new, len(order)))
        few = np.flatnonzero(often >= least)
        if not len(few):
            break
        few = few[np.argsort(-often[few], kind="stable")[:pairs]]
        chosen = order[new[few]]
        chosen = chosen[np.sort(np.unique(slot(chosen), return_index=True)[1])]  # one pair for each slot; others have their turn in a later round
        table = np.full(1 << BITS, -1, np.int32)
        table[slot(chosen)] = np.arange(len(chosen))
        which = table[slots]
        hit = np.flatnonzero(which >= 0)
        hit = hit[chosen[which[hit]] == key[hit]]
        at, which = live[hit], which[hit]
        # of places that overlap the next, every other one counts, from the left
        first = np.concatenate([[True], np.diff(at) > 1])
        run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        odd = (np.arange(len(at)) - run) % 2 == 1
        at, which = at[~odd], which[~odd]
        rules.append(np.stack([chosen >> 32, chosen & 0xFFFFFFFF], axis=1))
        seq[at] = base + count + which
        last[at] = last[at + 1]
        count += len(chosen)
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        # alive are pairs that were common and all that hold a new symbol
        before = at[at > 0] - 1
        alive = np.zeros(len(seq), bool)
        alive[live] = alive[at] = alive[before - ~stay[before]] = True
        seq, last, alive = seq[stay], last[stay], alive[stay]
        live = np.flatnonzero(alive[:-1] & ~last[:-1])
    starts = np.concatenate([[0], np.flatnonzero(last) + 1])[: len(ends)]
    return seq, np.concatenate(rules), starts


def packed(x: np.ndarray, width: int) -> bytes:
    """Numbers of so many bits."""
    x, out, at = x.astype(np.uint64), [], 0
    for kind, bits in (("<u2", 16), ("<u1", 8)):
        while width - at >= bits:
            out.append((x >> np.uint64(at)).astype(kind).tobytes())  # the cast cuts off what is above
            at += bits
    out += [np.packbits((x >> np.uint64(bit) & np.uint64(1)).astype(np.uint8)).tobytes() for bit in range(at, width)]
    return b"".join(out)


def unpacked(data: bytes, n: int, width: int, place: int) -> tuple[np.ndarray, int]:
    """n numbers of so many bits from a place on, and the place behind them."""
    x, at = np.zeros(n, np.int64), 0
    for kind, bits in (("<u2", 16), ("<u1", 8)):
        while width - at >= bits:
            x |= np.frombuffer(data, kind, n, place).astype(np.int64) << at
            at, place = at + bits, place + n * bits // 8
    for bit in range(at, width):
        row = np.frombuffer(data, np.uint8, -(-n // 8), place)
        x |= np.unpackbits(row, count=n).astype(np.int64) << bit
        place += len(row)
    return x, place


def pack(docs: list[bytes], base: int, **how) -> tuple[bytes, int]:
    """A shard's bytes from documents' ids (uint32, each ending in an end id), and how many ids it holds."""
    return packed_ids(np.frombuffer(b"".join(docs), "<u4"), np.array([len(d) // 4 for d in docs], np.int64), base, **how)


def packed_ids(ids: np.ndarray, sizes: np.ndarray, base: int, **how) -> tuple[bytes, int]:
    """``pack`` of ids that lie one document after the other."""
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    seq, rules, starts = repair(ids, bounds[1:] - 1, base, **how)
    _, length = expanded(rules[:, 0], rules[:, 1], base)
    width = [int(x).bit_length() for x in (base + len(rules), length.max(initial=0), len(ids))]
    arrays = [(rules[:, 0], 0), (rules[:, 1], 0), (length, 1), (seq, 0), (starts, 2), (bounds[:-1], 2)]
    body = HEAD.pack(base, len(rules), len(seq), len(sizes), *width) + b"".join(packed(x, width[w]) for x, w in arrays)
    return MAGIC + struct.pack("<I", zlib.crc32(body)) + body, len(ids)


class Shard:
    """Reads a shard's bytes; ``doc(i)`` expands one document alone, ``ids()`` all."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC or struct.unpack_from("<I", data, 4)[0] != zlib.crc32(memoryview(data)[8:]):
            raise ValueError("not a whole shard")
        self.base, n_rules, n_symbols, self.n_docs, *width = HEAD.unpack_from(data, 8)
        at, arrays = 8 + HEAD.size, []
        for n, w in ((n_rules, 0), (n_rules, 0), (n_rules, 1), (n_symbols, 0), (self.n_docs, 2), (self.n_docs, 2)):
            x, at = unpacked(data, n, width[w], at)
            arrays.append(x)
        self.left, self.right, self.length, self.symbols, self.first_symbol, self.first_id = arrays
        inner, found = expanded(self.left, self.right, self.base)
        if (found != self.length).any():
            raise ValueError("rules don't fit their lengths")
        size = np.concatenate([np.ones(self.base, np.int64), found])
        offset = np.concatenate([[0], np.cumsum(size)])
        flat = np.concatenate([np.arange(self.base, dtype=np.uint32), inner.astype(np.uint32)])
        self._size, self._offset, self._flat = size, offset, flat

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        return ragged(self._flat, self._offset[symbols], self._size[symbols])

    def ids(self) -> np.ndarray:
        return self._expand(self.symbols)

    def doc(self, i: int) -> np.ndarray:
        to = self.first_symbol[i + 1] if i + 1 < self.n_docs else len(self.symbols)
        return self._expand(self.symbols[self.first_symbol[i] : to])


_encoders: dict[str, tuple] = {}
#: A pre-tokenizer whose pieces hold no white space, so words can be encoded one by one; and within a word, letters part from other signs.
WORDWISE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters that normalising leaves alone and that have one lower-case form, and signs that no rule of a wordwise tokenizer reads.
LETTERS = frozenset(c for c in map(chr, range(0x41, 0x180)) if c.isalpha() and c not in "ªµºİŉ" and len(c.lower()) == 1)
ALL_LETTERS = "".join(sorted(LETTERS))
SIGNS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in "'<")


def is_wordwise(config: dict) -> bool:
    """Whether the tokenizer's file says that it lower-cases, splits by WORDWISE and encodes bytes, and no added token holds a space."""
    normal, split = config.get("normalizer") or {}, config.get("pre_tokenizer") or {}
    kinds, parts = [x.get("type") for x in normal.get("normalizers", [])], split.get("pretokenizers", [{}, {}])
    first, second = (*parts, {}, {})[:2]
    return (
        kinds == ["NFC", "Replace", "Lowercase"] and len(parts) == 2 and first.get("type") == "Split"
        and first.get("pattern") == {"Regex": WORDWISE} and first.get("invert") is True and first.get("behavior") == "Removed"
        and second.get("type") == "ByteLevel" and not second.get("add_prefix_space") and not second.get("use_regex")
        and all(
            t["content"].startswith("<") and not re.search(r"\s", t["content"]) and not t["lstrip"] and not t["rstrip"]
            for t in config.get("added_tokens", [])
        )
    )


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable ones for themselves, the others in order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*plain}))}


class Wordwise:
    """Texts to ids. A batch's words are told apart by Arrow and cut there into letters and signs, as the tokenizer's own split does; different ones go to the
    library's model apart, other words to the whole tokenizer. What they gave is remembered."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.letter = tokenizer, tokenizer.model, byte_letters()
        self.words, self.parts = Memo(self._word, WORD_BYTES), Memo(self._part, PART_BYTES)

    def _part(self, text: str) -> bytes:
        if not text.isascii():
            text = "".join(map(self.letter.__getitem__, text.encode()))
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _word(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def flat(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has; with the end id behind each, where one is given."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        places = split.flatten().dictionary_encode()
        words, which, bounds = places.dictionary, places.indices.to_numpy(), split.offsets.to_numpy()
        letters, signs = pc.utf8_rtrim(words, SIGNS), pc.utf8_ltrim(words, ALL_LETTERS)
        length = lambda x: pc.binary_length(x).to_numpy()
        other = length(letters) + length(signs) != length(words)  # else the word is letters, then signs
        mask = pa.array(other)
        letters, signs = (pc.if_else(mask, "", x).dictionary_encode() for x in (pc.utf8_lower(letters), signs))
        asked = ((self.parts, letters.dictionary), (self.parts, signs.dictionary), (self.words, words.filter(mask)))
        found = [list(map(memo.__getitem__, x.to_numpy(zero_copy_only=False))) for memo, x in asked]
        known = [v for f in found for v in f]
        ids, size = np.frombuffer(b"".join(known), "<u4"), np.fromiter(map(len, known), np.int64, len(known)) // 4
        first, second = letters.indices.to_numpy().astype(np.int64), signs.indices.to_numpy() + len(found[0])
        first[other] = len(found[0]) + len(found[1]) + np.arange(other.sum())  # its signs are none
        halves = np.stack([first, second], axis=1).ravel()
        ids, size = ragged(ids, (np.cumsum(size) - size)[halves], size[halves]), size[first] + size[second]
        ids, size = np.append(ids, np.uint32(end or 0)), np.append(size, int(end is not None))
        which = np.insert(which, bounds[1:] - bounds[0], len(size) - 1)
        sizes = size[which]
        upto = np.concatenate([[0], np.cumsum(sizes)])[bounds - bounds[0] + np.arange(len(bounds))]
        return ragged(ids, (np.cumsum(size) - size)[which], sizes), np.diff(upto)

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        ids, sizes = self.flat(pa.array(texts, pa.binary()).cast(pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


def with_ends(encode, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts with the end id behind each, and how many each has."""
    if isinstance(encode, Wordwise):
        return encode.flat(texts, end)
    mark = np.array([end], "<u4").tobytes()
    raw = [e + mark for e in encode(texts.cast(pa.binary()).to_pylist())]
    return np.frombuffer(b"".join(raw), "<u4"), np.array([len(r) // 4 for r in raw], np.int64)


def encoder(path: str):
    """(texts in UTF-8 -> bytes of their ids, vocabulary size). A wordwise tokenizer's words are encoded once and remembered; texts of other tokenizers are encoded whole."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        raw = lambda ids: np.array(ids, "<u4").tobytes()
        if is_wordwise(json.loads(tokenizer.to_str())):
            encode = Wordwise(tokenizer)
        else:

            def encode(texts: list[bytes | None]) -> list[bytes]:
                return [raw(e.ids) for e in tokenizer.encode_batch_fast([(t or b"").decode("utf-8") for t in texts], add_special_tokens=False)]

        _encoders[path] = encode, tokenizer.get_vocab_size()
    return _encoders[path]


def _stored(doc_type: T.DataType) -> T.StructType:
    fields = {"part": T.IntegerType(), "seq": T.IntegerType(), "n_ids": T.LongType(), "doc_ids": T.ArrayType(doc_type), "data": T.BinaryType()}
    return T.StructType([T.StructField(*f) for f in fields.items()])


def write_tokens(
    docs: DataFrame, tokenizer: str, path: str | None = None, text: str = "text", doc_id: str = "doc_id", end: int = END, shard: int = SHARD,
) -> str:
    """Write the ids of all documents, each with the end id, in ascending order of doc_id (nulls first, then by a hash of the text); returns the path."""
    spark = docs.sparkSession
    prepare(spark)
    path = path or new_path(spark, "tokens")
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("_text"), F.xxhash64(docs[text]).alias("_tie"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "_text", F.spark_partition_id().alias("_part"))
    kind = docs.schema[doc_id].dataType

    def of(batches):
        encode, base = encoder(tokenizer)
        Memo.only(*([encode.words, encode.parts] if isinstance(encode, Wordwise) else []))
        held, room, seq, part = [], 0, 0, None  # held: document ids, ids and sizes of what the next shard has

        def flush():
            nonlocal held, room, seq
            doc_ids, ids, sizes = zip(*held, strict=True)
            data, n = packed_ids(np.concatenate(ids), np.concatenate(sizes), max(base, end + 1))
            doc_ids = pa.concat_arrays(doc_ids)
            cols = [
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([n], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids), pa.array([data], pa.binary())
            ]
            held, room, seq = [], 0, seq + 1
            return pa.RecordBatch.from_arrays(cols, names=["part", "seq", "n_ids", "doc_ids", "data"])

        for b in batches:
            if not b.num_rows:
                continue
            part = b["_part"][0].as_py()
            ids, sizes = with_ends(encode, b["_text"], end)
            upto, begin = np.concatenate([[0], np.cumsum(sizes)]), 0
            while begin < b.num_rows:  # a shard ends with the document that fills it
                stop = min(int(np.searchsorted(upto, upto[begin] + shard - room)), b.num_rows)
                held.append((b["doc_id"].slice(begin, stop - begin), ids[upto[begin] : upto[stop]], sizes[begin:stop]))
                room, begin = room + int(upto[stop] - upto[begin]), stop
                if room >= shard:
                    yield flush()
        if held:
            yield flush()

    ordered.mapInArrow(of, _stored(kind)).write.option("compression", "zstd").parquet(path)
    return path


def read_tokens(spark: SparkSession, path: str, doc_type: T.DataType | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every stored document, and its ids if asked for."""
    prepare(spark)
    kind = doc_type or T.LongType()
    files = spark.read.schema(_stored(kind)).parquet(path)
    # offsets: of shards within their partition, and of partitions, whose number is bounded by the write
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = files.select("part", "seq", F.coalesce(F.sum("n_ids").over(upto(Window.partitionBy("part").orderBy("seq"))), F.lit(0)).alias("_inside"))
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(upto(Window.orderBy("part"))), F.lit(0)).alias("_before")
    )
    offset = inside.join(parts, "part").select("part", "seq", (F.col("_inside") + F.col("_before")).alias("_offset"))

    def of(batches):
        for b in batches:
            for part, seq, ids, data in zip(b["part"].to_pylist(), b["seq"].to_pylist(), b["doc_ids"], b["data"].to_pylist(), strict=True):
                shard = Shard(data)
                every, first = shard.ids().astype("<u4"), shard.first_id
                size = np.diff(np.append(first, len(every)))
                whole = memoryview(every).cast("B")
                crc = [zlib.crc32(whole[4 * s : 4 * (s + n)]) for s, n in zip(first.tolist(), size.tolist(), strict=True)]
                n = len(size)
                cols = [
                    ids.values, pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, seq, np.int32)), pa.array(first), pa.array(size),
                    pa.array(crc, pa.int64())
                ]
                names = ["doc_id", "part", "seq", "_first", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(first, len(every)).astype(np.int32)), pa.array(every.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    fields = [
        ("doc_id", kind), ("part", T.IntegerType()), ("seq", T.IntegerType()), ("_first", T.LongType()), ("n_tokens", T.LongType()),
        ("ids_crc32", T.LongType())
    ] + [("ids", T.ArrayType(T.IntegerType()))] * with_ids
    rows = files.select("part", "seq", "doc_ids", "data").mapInArrow(of, T.StructType([T.StructField(*f) for f in fields]))
    return rows.join(offset, ["part", "seq"]).select(
        "doc_id", (F.col("_first") + F.col("_offset")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids
    )


def token_files(docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """Writes docs and reads them back: doc_id, start, n_tokens, ids_crc32.

    A null text counts as empty: its document is the end id alone. Null ids come first. Repeated rows are documents each.
    An empty table gives an empty result.
    """
    path = write_tokens(docs, tokenizer, text=text, doc_id=doc_id, **how)
    return read_tokens(docs.sparkSession, path, docs.schema[doc_id].dataType)
