"""Tokens, pieces and media: equality with the libraries and exact round trips."""

import hashlib
import math
import random
import statistics
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from talus.llm import media, pieces, queries, tokens
from tests.conftest import SMALL

WORDS, PIECES = public_tokenizers.path(queries.WORDS), public_tokenizers.path(queries.PIECES)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
ALPHABET = "ab'sTé ß.!<>|_-~\x01\t\n9١ȩ́İΣ漢字  ▁<|endoftext|>edthe"


def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}


def fuzz(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(name):
    path = public_tokenizers.path(name)
    library, (encode, _) = Tokenizer.from_file(path), tokens.encoder(path)
    texts = [*fuzz(1, 3000), "<|endoftext|>a <|startoftext|>'s're", "it's DON'T we've"]
    told = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encode([t.encode() for t in texts]) == told


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=40), min_size=1, max_size=8), st.integers(0, 5))
def test_shards_round_trip(docs, rounds):
    raw = [np.array([*d, 2], "<u4").tobytes() for d in docs]
    data, n = tokens.pack(raw, 10, rounds=rounds, least=2)
    shard = tokens.Shard(data)
    assert n == sum(len(r) // 4 for r in raw) and shard.ids().astype("<u4").tobytes() == b"".join(raw)
    assert [shard.doc(i).astype("<u4").tobytes() for i in range(len(raw))] == raw


def test_grammar_compresses_and_detects_damage():
    data, n = tokens.pack([np.array([3, 4, 5] * 500 + [2], "<u4").tobytes()] * 4, 10)
    assert len(data) < n
    broken = bytearray(data)
    broken[-1] ^= 1
    for bad in (bytes(broken), b"nope" + data[4:]):
        with pytest.raises(ValueError):
            tokens.Shard(bad)


def test_rounds_go_on_until_no_pair_is_frequent():
    passage = np.random.default_rng(2).integers(3, 9000, 2000)
    ids, ends = np.tile(np.append(passage, 2), 40), np.arange(1, 41) * 2001 - 1
    seq, rules, starts = tokens.repair(ids, ends, 10_000)
    assert len(seq) == 40 and len(starts) == 40
    data, n = tokens.pack([np.append(passage, 2).astype("<u4").tobytes()] * 40, 10_000)
    assert n == len(ids) and (tokens.Shard(data).ids() == ids).all()


def test_rounds_look_only_at_pairs_that_may_be_frequent(monkeypatch):
    rare, passage = np.arange(3, 60_003), np.tile(np.append(np.random.default_rng(3).integers(3, 9000, 500), 2), (40, 1))
    looked, slot = [], tokens.slot
    monkeypatch.setattr(tokens, "slot", lambda key: looked.append(len(key)) or slot(key))
    ids = np.concatenate([rare, [2], passage.ravel()])
    seq, _, _ = tokens.repair(ids, np.flatnonzero(ids == 2), 100_000)
    assert len(seq) == 60_001 + 40 and sum(looked) < 2 * len(ids)


def test_a_batch_asks_once_for_each_different_word():
    class Counted(dict):
        asked = 0

        def __getitem__(self, key):
            Counted.asked += 1
            return self.of(key)

    encode, _ = tokens.encoder(WORDS)
    own = tokens.Wordwise(encode.tokenizer)
    for name in ("words", "parts"):
        of, counted = getattr(own, name).of, Counted()
        counted.of = of
        setattr(own, name, counted)
    texts = ["Alpha beta, beta don't \u00c9t\u00e9 *** \u4f60\u597d " * 200, None, ""] * 3
    assert own([t and t.encode() for t in texts]) == encode([t and t.encode() for t in texts])
    ids, sizes = own.flat(tokens.pa.array(texts).slice(1, 4), 2)
    library = Tokenizer.from_file(WORDS)
    assert Counted.asked < 30
    assert np.split(ids, np.cumsum(sizes)[:-1])[2].tolist() == [*library.encode(texts[3], add_special_tokens=False).ids, 2] and sizes[:2].tolist() == [1, 1]


def test_op9_equals_library(spark):
    library, start = Tokenizer.from_file(WORDS), 0
    found = {r["doc_id"]: r for r in queries.op9_token_files(spark, SMALL).collect()}
    for i, text in sorted(documents(spark).items()):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (found[i]["start"], found[i]["n_tokens"], found[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_of_odd_rows_in_many_shards(odd, none, spark):
    path = tokens.write_tokens(odd, WORDS, shard=50)
    out = tokens.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    assert len(out) == odd.count() and out[0]["start"] == 0
    for a, b in zip(out, out[1:], strict=False):
        assert b["start"] == a["start"] + a["n_tokens"] and (a["doc_id"] is None or a["doc_id"] <= b["doc_id"])
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and r["ids"][-1] == 2 for r in out)
    assert spark.read.parquet(path).count() > 3
    assert tokens.token_files(none, WORDS).count() == 0


def test_large_documents_and_shared_ids(spark):
    docs = spark.createDataFrame(
        [(1, "one two " * 400), *[(5, f"same id {i}") for i in range(30)], (5, "same id 3"), (9, None)], "doc_id long, text string"
    ).repartition(4)
    path = tokens.write_tokens(docs, WORDS, shard=64)
    out = tokens.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    library = Tokenizer.from_file(WORDS)
    told = sorted((r["doc_id"], [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in docs.collect())
    assert sorted((r["doc_id"], r["ids"]) for r in out) == told and [r["doc_id"] for r in out] == [i for i, _ in told]
    assert [r["start"] for r in out] == [sum(r["n_tokens"] for r in out[:k]) for k in range(len(out))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 40) - 1), max_size=40))
def test_numbers_of_any_width_round_trip(x):
    width = max([0, *x]).bit_length()
    data = tokens.packed(np.array(x, np.int64), width)
    back, at = tokens.unpacked(b"ab" + data, len(x), width, 2)
    assert back.tolist() == x and at == 2 + len(data)


def test_packed_shards_are_smaller_than_plain_ids(spark):
    library = Tokenizer.from_file(WORDS)
    docs = [np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes() for t in documents(spark).values()]
    data, n = tokens.pack(docs, library.get_vocab_size())
    assert len(data) < 2 * n


def unigram(tmp_path):
    """The public pieces as a unigram model for the library: kind and placeholder scores changed in the file's bytes."""
    out = b""
    n = len(pieces.Model(PIECES).pieces)
    varint = lambda x: bytes([x & 127 | 128, *varint(x >> 7)]) if x > 127 else bytes([x])

    def field(number, value):
        if isinstance(value, int):
            return varint(number << 3) + varint(value)
        kind = 5 if number == 2 and len(value) == 4 else 2
        return varint(number << 3 | kind) + (value if kind == 5 else varint(len(value)) + value)

    for number, value in pieces._wire(open(PIECES, "rb").read()):
        if number == 1:
            parts = dict(pieces._wire(value))
            if struct.unpack("<f", parts.get(2, bytes(4)))[0] < -1e6:
                parts[2] = struct.pack("<f", -float(n))
            value = b"".join(field(k, v) for k, v in parts.items())
        out += field(number, value) if number != 2 else b""
    trainer = field(3, 1) + field(35, 1)  # a unigram model with byte pieces
    (tmp_path / "u.model").write_bytes(out + varint(2 << 3 | 2) + varint(len(trainer)) + trainer)
    return sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "u.model"))


def test_unigram_equals_library(spark, tmp_path):
    library, counter, path = unigram(tmp_path), pieces.Counter(pieces.Model(PIECES, pieces.UNIGRAM)), pieces.Transducer(pieces.Model(PIECES, pieces.UNIGRAM))
    for t in [*fuzz(2, 1500), *documents(spark).values()]:
        ids = library.encode(t)
        assert counter(t) == len(ids) and path.encode(t) == ids


def test_merging_equals_library(spark):
    transducer = pieces.Transducer(pieces.Model(PIECES))
    for t in [*fuzz(3, 1500), *documents(spark).values()]:
        ids = LIBRARY.encode(t)
        assert transducer.encode(t) == ids and transducer.model.decode(ids) == LIBRARY.decode(ids)


def test_every_place_has_one_path_of_finite_weight():
    """The acceptor of merged pairs leaves one sequence of pieces, and that is what merging makes."""
    transducer, rng = pieces.Transducer(pieces.Model(PIECES)), random.Random(4)
    infinite = float("inf")
    for _ in range(150):
        text = "".join(rng.choice("▁theinganotr") for _ in range(rng.randint(1, 9)))
        code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        start, end, symbol = (x.tolist() for x in transducer.lexicon.arcs(code, np.full(len(code), len(code))))
        paths = [[(0, transducer.width - 1, ())]] + [[] for _ in text]
        for place in range(len(text)):
            for a, b, x in zip(start, end, symbol, strict=True):
                if a == place:
                    for _, last, ids in paths[place]:
                        if transducer.acceptor(np.array([last]), np.array([x]))[0] < infinite:
                            paths[b].append((b, x, (*ids, x)))
        assert [len(p) for p in paths] == [1] * (len(text) + 1)
        assert [transducer.lexicon.text[i] for i in paths[-1][0][2]] == transducer.merged(text)


def test_cuts_of_more_than_a_generation(monkeypatch):
    transducer = pieces.Transducer(pieces.Model(PIECES))
    monkeypatch.setattr(pieces, "TOGETHER", 7)
    transducer.memo.most = 2000
    texts = [*fuzz(6, 300), "", None]
    assert [np.frombuffer(x, np.int32).tolist() for x in transducer.packed(texts)] == [LIBRARY.encode(t or "") for t in texts]
    assert transducer.memo.bytes < 10_000


def test_ops_5_and_7(spark, odd, none):
    counts = {r["doc_id"]: r["n_tokens"] for r in queries.op5_token_counts(spark, SMALL).collect()}
    counter = pieces.Counter(pieces.Model(PIECES, pieces.UNIGRAM))
    texts = documents(spark)
    assert counts == {i: counter(t) for i, t in texts.items()}
    found = {r["doc_id"]: r for r in queries.op7_sentencepiece(spark, SMALL).collect()}
    for i, t in texts.items():
        assert found[i]["exact"] and found[i]["n_tokens"] == len(LIBRARY.encode(t)) and found[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    rows = pieces.encoded(odd, PIECES, keep=("doc_id", "text", "score")).collect()
    assert len(rows) == odd.count() and all(r["exact"] and r["decoded"] == (r["text"] or "") and r["ids"] == LIBRARY.encode(r["text"] or "") for r in rows)
    assert {r["n_tokens"] for r in pieces.token_counts(odd.filter("text is null or text = ''"), PIECES).collect()} == {0}
    told = sorted(counter(r["text"]) for r in odd.collect())
    assert sorted(r["n_tokens"] for r in pieces.token_counts(odd, PIECES).collect()) == told
    assert pieces.encoded(none, PIECES).count() == 0 and pieces.token_counts(none, PIECES).count() == 0


def test_op8_equals_plain_code(spark, odd, none):
    texts = documents(spark)
    for r in queries.op8_media(spark, SMALL).collect():
        raw = texts[r["doc_id"]].encode()
        whole = raw + b"\xff" * (576 * max(1, -(-len(raw) // 576)) - len(raw))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (
            len(raw), len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-32:])
        )
        png = media.png_encode(whole)
        assert (r["media_bytes"], r["media_sha256"]) == (len(png), hashlib.sha256(png).hexdigest()) and len(r["feature"]) == 16
    out = media.media_column(odd).collect()
    assert len(out) == odd.count() and all(r["payload_bytes"] % 576 == 0 and r["payload_bytes"] > 0 for r in out)
    assert media.media_column(none).count() == 0


def plain_picture(png):
    """Rows of samples by the format's definition, a sample at a time."""
    at, data = 8, b""
    while at < len(png):
        n, kind = struct.unpack_from(">I4s", png, at)
        if kind == b"IHDR":
            width, height = struct.unpack_from(">II", png, at + 8)
        data += png[at + 8 : at + 8 + n] if kind == b"IDAT" else b""
        at += 12 + n
    raw, rows = zlib.decompress(data), []
    for y in range(height):
        kind, *line = raw[y * (width + 1) : (y + 1) * (width + 1)]
        for x in range(width):
            a, b, c = (line[x - 1] if x else 0), (rows[-1][x] if y else 0), (rows[-1][x - 1] if x and y else 0)
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            line[x] = (line[x] + (0, a, b, (a + b) // 2, paeth)[kind]) % 256
        rows.append(line)
    return rows


def plain_feature(rows):
    """Bits of the lowest cosine coefficients of the picture's 32 by 32 cells, and whether each is far enough from the median to tell."""
    def cells(n):
        return [range(i * n // 32, max((i + 1) * n // 32, i * n // 32 + 1)) for i in range(32)]

    mean = [[sum(rows[y][x] for y in ys for x in xs) / len(ys) / len(xs) for xs in cells(len(rows[0]))] for ys in cells(len(rows))]
    cos = [[math.cos(math.pi * (2 * i + 1) * k / 64) for i in range(32)] for k in range(8)]
    low = [sum(cos[u][i] * cos[v][j] * mean[i][j] for i in range(32) for j in range(32)) for u in range(8) for v in range(8)]
    middle = statistics.median(low)
    return [x > middle for x in low], [abs(x - middle) > 1e-4 for x in low]


def test_op8_features_and_pictures_equal_plain_code(spark):
    texts = sorted(documents(spark).items(), key=lambda kv: len(kv[1]))
    texts = dict([*texts[:150:15], *[x for x in texts if len(x[1]) > 32 * 576][:2]])
    found = {r["doc_id"]: r["feature"] for r in queries.op8_media(spark, SMALL).collect()}
    for i, text in texts.items():
        raw, _ = media.payload(text)
        rows = plain_picture(media.png_encode(raw))
        assert bytes(x for row in rows for x in row) == raw
        bits, sure = plain_feature(rows)
        assert all(b == (int(found[i], 16) >> (63 - k) & 1) for k, (b, s) in enumerate(zip(bits, sure, strict=True)) if s)
        assert sum(sure) > (40 if len(rows) >= 32 else 0)


def test_png_filters_and_damage():
    rng = np.random.default_rng(2)
    picture = rng.integers(0, 256, (11, 7), dtype=np.uint8)
    lines = np.zeros((11, 8), np.uint8)
    for y in range(11):  # every filter, by its definition
        kind = y % 5
        lines[y, 0] = kind
        for x in range(7):
            a = int(picture[y, x - 1]) if x else 0
            b = int(picture[y - 1, x]) if y else 0
            c = int(picture[y - 1, x - 1]) if x and y else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            lines[y, x + 1] = (int(picture[y, x]) - (0, a, b, (a + b) // 2, paeth)[kind]) % 256
    assert (media.unfilter(lines) == picture).all()
    png = media.png_encode(picture.tobytes(), width=7)
    assert (media.png_decode(png) == picture).all()
    for at in (0, 20, 45, len(png) - 5):
        broken = bytearray(png)
        broken[at] ^= 255
        with pytest.raises(ValueError):
            media.png_decode(bytes(broken))
    with pytest.raises(ValueError):
        media.png_decode(png[:-12])


def test_cosine_hash_tells_pictures_apart_and_small_changes_not():
    y, x = np.mgrid[0:64, 0:576]
    wave = (128 + 100 * np.sin(x / 60) * np.cos(y / 9)).astype(np.uint8)
    near = wave.copy()
    near[5, 5] ^= 1
    other = (x * 255 // 576).astype(np.uint8)
    bits = lambda a, b: bin(int(media.cosine_hash(a), 16) ^ int(media.cosine_hash(b), 16)).count("1")
    assert bits(wave, near) <= 2 < bits(wave, other)
