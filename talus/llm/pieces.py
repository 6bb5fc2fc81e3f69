"""Piece models: the model file, count-only Viterbi, and encoding and decoding by weighted finite-state transducers.

* ``Normaliser``: a transducer of three states writes white-space marks. Text is cut where no piece reaches over, and each cut is
  solved once for each worker and remembered.
* ``Counter``: an Aho-Corasick automaton enumerates the pieces that end at each place; dynamic programming carries the best
  score and its number of pieces. Among equal scores the first found from the left wins, that is the longest last piece.
* ``Transducer``: normaliser, pieces with byte fallback, and the acceptor of piece sequences, each compiled once, are composed with
  every cut, and the path of least weight in the tropical semiring is the encoding. A piece weighs its negated score. The acceptor
  of a unigram model takes all sequences. That of a pair-merging model has a state for each last piece; its arcs weigh 0 where
  merging the two pieces' characters keeps them apart, and infinity where it doesn't. A sequence all of whose arcs are finite
  is what merging makes, and each prefix has just one, so each place of the composition has one state of finite weight.

Characters without a piece become byte pieces where the model has them, else the unknown piece.
"""

from __future__ import annotations

import re
import struct
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from talus.llm.common import Memo, prepare

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Bytes of a generation of remembered cuts, and of them in counting, which takes more time for a new one. Places (a power of two) for pairs of pieces.
CUT_BYTES, COUNT_BYTES, PAIR_BITS = 24 << 20, 96 << 20, 21
#: Cuts that are composed at once.
TOGETHER = 40_000
SPACE, PENALTY, LOWEST = "▁", 10.0, float("-inf")
_RUNS = re.compile(" |[^ ]+")


def _wire(data: bytes):
    """Fields of a protocol buffer message: number and value (int, bytes)."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            n = varint()
            at += n
            yield key >> 3, data[at - n : at]
        else:
            n = 4 if key & 7 == 5 else 8
            at += n
            yield key >> 3, data[at - n : at]


class Normaliser:
    """White-space rules as a transducer. Its arcs lead from a state, by a space or another character, to the next state and write
    a text; other characters are copied behind it. Spaces that are pending at the end are lost."""

    START, BODY, GAP = range(3)

    def __init__(self, prefix: bool, strip: bool, mark: str):
        first = mark if prefix else ""
        self.arcs = {
            (self.START, False): (first, self.BODY), (self.START, True): ("", self.START) if strip else (first + mark, self.BODY),
            (self.BODY, False): ("", self.BODY), (self.BODY, True): ("", self.GAP) if strip else (mark, self.BODY),
            (self.GAP, False): (mark, self.BODY), (self.GAP, True): ("", self.GAP),
        }

    def __call__(self, text: str, state: int = START) -> str:
        out, arcs = [], self.arcs
        for run in _RUNS.findall(text):  # behind its first character, a run of others stays in BODY
            written, state = arcs[state, space := run == " "]
            out.append(written if space else written + run)
        return "".join(out)


class Model:
    """A model file. kind: UNIGRAM or BPE, as the file says if None; any piece model's scores can be read as unigram scores."""

    def __init__(self, path: str, kind: int | None = None):
        self.pieces, self.scores, self.types = [], [], []
        self.kind, self.byte_fallback, self.dummy_prefix, self.strip, self.escape = UNIGRAM, False, True, True, True
        with open(path, "rb") as f:
            data = f.read()
        for field, value in _wire(data):
            if field == 1:
                piece = dict(_wire(value))
                self.pieces.append(piece[1].decode("utf-8"))
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.types.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_wire(value))
                self.kind, self.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif field == 3:
                rules = dict(_wire(value))
                if rules.get(2):
                    raise ValueError("models whose normaliser has a table of characters aren't supported")
                self.dummy_prefix, self.strip, self.escape = (bool(rules.get(n, 1)) for n in (3, 4, 5))
        if kind == UNIGRAM and self.kind == BPE:  # some merges have a placeholder for a score, which stands for the last rank
            self.scores = [max(x, -float(len(self.pieces))) for x in self.scores]
        self.kind = kind or self.kind
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and pair-merging models are supported")
        self.id = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t in (NORMAL, USER)}
        self.unknown = self.types.index(UNKNOWN)
        self.byte = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types, strict=True)) if t == BYTE}
        normal = [s for s, t in zip(self.scores, self.types, strict=True) if t == NORMAL]
        self.unknown_score, best = min(normal) - PENALTY, max(normal)
        self.score = {p: len(p) * best - 0.1 if self.types[i] == USER else self.scores[i] for p, i in self.id.items()}
        self.longest = max(map(len, self.id))

    @cached_property
    def normal(self) -> Normaliser:
        return Normaliser(self.dummy_prefix, self.strip, SPACE if self.escape else " ")

    def cut(self, text: str) -> list[str]:
        """Cuts of a text as it is. Stripping looks at the whole text, so there it is normalised first; else a cut is normalised by itself, and the first reads a space in place of the prefix."""
        if self.strip:
            return self.cuts.findall(self.normal(text))
        return self.cuts.findall(" " + text if self.dummy_prefix else text)

    def normal_cut(self, cut: str) -> str:
        return cut if self.strip else self.normal(cut, Normaliser.BODY)

    @cached_property
    def joined(self) -> set[str]:
        """Neighbouring characters in pieces; no piece reaches over any others."""
        return {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}

    @cached_property
    def cuts(self) -> re.Pattern:
        """Finds parts between which no piece reaches, at most at the starts of words."""
        alone = "".join(c for c in "\n\t\r" if not any(c in two for two in self.joined))
        if not self.escape or any(two[1] == SPACE and two[0] != SPACE for two in self.joined):
            return re.compile("(?s).+")
        other = f"[^ {SPACE}{alone}]"
        return re.compile(f"[ {SPACE}]+{other}*|{other}+" + (f"|[{alone}]" if alone else ""))

    def finer(self, part: str) -> list[str]:
        """A part, cut everywhere that no piece reaches over."""
        joined, at = self.joined, [0]
        at += [i for i in range(1, len(part)) if part[i - 1 : i + 1] not in joined]
        return [part[a:b] for a, b in zip(at, [*at[1:], len(part)], strict=True)]

    def rest(self, char: str) -> list[int]:
        """Ids of a character that no piece has."""
        return [self.byte[b] for b in char.encode("utf-8", "surrogatepass")] if self.byte_fallback else [self.unknown]

    @cached_property
    def raw(self) -> list[bytes]:
        """UTF-8 of each id, with spaces for their marks; a byte piece is its byte, a control piece nothing."""
        show = {CONTROL: lambda p: b"", BYTE: lambda p: bytes([int(p[3:5], 16)]), UNKNOWN: lambda p: " ⁇ ".encode()}
        return [
            show[t](p) if t in show else (p.replace(SPACE, " ") if self.escape else p).encode("utf-8")
            for p, t in zip(self.pieces, self.types, strict=True)
        ]

    def decode(self, ids) -> str:
        """The text of ids; byte pieces that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


class Counter:
    """Number of pieces of the best unigram segmentation."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model, self.automaton = model, ahocorasick.Automaton()
        for piece, score in model.score.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.memo = Memo(lambda cut: sum(map(self.part, self.model.finer(self.model.normal_cut(cut)))), COUNT_BYTES)

    def part(self, text: str) -> int:
        n, model = len(text), self.model
        ends: list[list] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(text):
            ends[end].append(match)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(n):
            best = None
            single = False
            for length, s in sorted(ends[end], reverse=True):  # longest first: from the left
                single |= length == 1
                total = score[end + 1 - length] + s
                if best is None or total > best:
                    best, pieces = total, count[end + 1 - length] + 1
            if not single and (best is None or score[end] + model.unknown_score > best):
                best, pieces = score[end] + model.unknown_score, count[end] + len(model.rest(text[end]))
            score[end + 1], count[end + 1] = best, pieces
        return count[n]

    def __call__(self, text: str | None) -> int:
        return sum(map(self.memo.__getitem__, self.model.cut(text))) if text else 0


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).view(np.int64)


class Places:
    """Where keys stand in a sorted array; a table of ``bits`` bits finds most of them in one step."""

    def __init__(self, keys: np.ndarray, bits: int):
        self.keys, self.bits, self.slots = keys, bits, np.zeros(1 << bits, np.int32)
        self.slots[_slot(keys, bits)] = np.arange(len(keys), dtype=np.int32)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each key's place, and whether it is there at all."""
        at = self.slots[_slot(keys, self.bits)]
        found = self.keys[at] == keys
        rest = np.flatnonzero(~found)
        at[rest] = np.minimum(np.searchsorted(self.keys, keys[rest]), len(self.keys) - 1)
        found[rest] = self.keys[at[rest]] == keys[rest]
        return at, found


class Lexicon:
    """The pieces' transducer: a trie whose final states write an id. Symbols are ids, then characters that only longer pieces have."""

    def __init__(self, model: Model):
        names = sorted({c for p in model.id for c in p if c not in model.id})
        self.n, self.bare = len(model.pieces), names
        self.symbol = model.id | {c: len(model.pieces) + i for i, c in enumerate(names)}
        text = {i: p for p, i in self.symbol.items()}
        self.text = [text.get(i, "") for i in range(self.n + len(names))]
        self.weight = np.array([-model.score[t] if i < self.n and t in model.id else -model.unknown_score for i, t in enumerate(self.text)])
        arcs, final, states = {}, {}, 1
        for piece, i in self.symbol.items():
            at = 0
            for c in piece:
                if (at, c) not in arcs:
                    arcs[at, c] = states
                    states += 1
                at = arcs[at, c]
            final[at] = i
        key = np.array([s << 21 | ord(c) for s, c in arcs], np.int64)
        order = np.argsort(key)
        self.arc, self.to = Places(key[order], 18), np.fromiter(arcs.values(), np.int64, len(arcs))[order]
        self.final = np.full(states, -1)
        self.final[list(final)] = list(final.values())
        self.joined = Places(np.array(sorted([-1, *(ord(two[0]) << 21 | ord(two[1]) for two in model.joined)]), np.int64), 16)

    def arcs(self, code: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of characters, and where each one's part ends: start, end and symbol of all pieces in them."""
        start, state, depth, out = np.arange(len(code)), np.zeros(len(code), np.int64), 0, []
        while len(start):
            at, there = self.arc(state << 21 | code[start + depth])
            start, state, depth = start[there], self.to[at[there]], depth + 1
            symbol = self.final[state]
            ends = symbol >= 0
            out.append((start[ends], start[ends] + depth, symbol[ends]))
            more = start + depth < end[start]
            start, state = start[more], state[more]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


class Transducer:
    """Least-weight paths through normaliser, pieces and byte fallback, and the acceptor of sequences, as ids."""

    def __init__(self, model: Model):
        self.model, self.lexicon = model, Lexicon(model)
        self.width = len(self.lexicon.text) + 1  # the last state stands for no piece yet
        self.pair, self.apart = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)
        self.memo = Memo(lambda cut: self.solve([cut])[0], CUT_BYTES, self.solve)

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: the best-scored neighbouring pair first, from the left."""
        parts, score = list(text), self.model.score.get
        gain = [score(a + b, LOWEST) for a, b in zip(parts, parts[1:], strict=False)]
        while gain and (best := max(gain)) > LOWEST:
            i = gain.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del gain[i]
            if i:
                gain[i - 1] = score(parts[i - 1] + parts[i], LOWEST)
            if i < len(gain):
                gain[i] = score(parts[i] + parts[i + 1], LOWEST)
        return parts

    def acceptor(self, last: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Weights of the acceptor's arcs from the states of last pieces by the next: 0 or infinity. Arcs are made when they are first met."""
        if self.model.kind != BPE:
            return np.zeros(len(last))
        key = last * self.width + symbol
        at = _slot(key, PAIR_BITS)
        apart = self.apart[at]
        new = np.flatnonzero(self.pair[at] != key)
        if len(new):
            text, none = self.lexicon.text, self.width - 1
            fresh, which = np.unique(key[new], return_inverse=True)
            both = [(text[k % self.width],) if k // self.width == none else (text[k // self.width], text[k % self.width]) for k in fresh.tolist()]
            found = np.array([self.merged("".join(b)) == list(b) for b in both])
            apart[new] = found[which]
            self.pair[at[new]], self.apart[at[new]] = key[new], apart[new]
        return np.where(apart, 0.0, np.inf)

    def solve(self, cuts: list[str]) -> list[bytes]:
        """Ids of each cut, 32 bits each: all cuts are composed at once, and paths grow from place to place in all of them."""
        texts, lexicon = [self.model.normal_cut(c) for c in cuts], self.lexicon
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        n, bounds = len(code), np.cumsum([0, *map(len, texts)])
        if not n:
            return [b""] * len(cuts)
        # parts: pieces reach over neither cuts nor neighbours that no piece has
        two = code[:-1] << 21 | code[1:]
        begins = np.ones(n, bool)
        begins[1:] = ~lexicon.joined(two)[1]
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        first = np.flatnonzero(begins)
        part = np.cumsum(begins) - 1
        start, end, symbol = lexicon.arcs(code, np.append(first[1:], n)[part])
        far = end - first[part[start]]
        order = np.lexsort((start, end, far))
        start, end, symbol, far = start[order], end[order], symbol[order], far[order]
        total, last, back = np.full(n + 1, np.inf), np.full(n + 1, -1), np.arange(n + 1) - 1
        steps = np.append(np.flatnonzero(np.diff(far, prepend=0)), len(far))
        for a, b in zip(steps[:-1], steps[1:], strict=True):
            s, e, x = start[a:b], end[a:b], symbol[a:b]
            new = begins[s]
            before, state = np.where(new, 0.0, total[s]), np.where(new, self.width - 1, last[s])
            if not (live := before < np.inf).all():
                s, e, x, before, state = s[live], e[live], x[live], before[live], state[live]
            if not len(s):
                continue
            weight = before + lexicon.weight[x] + self.acceptor(state, x)
            group = np.flatnonzero(np.diff(e, prepend=-1))
            least = np.minimum.reduceat(weight, group)
            best = np.flatnonzero(weight == np.repeat(least, np.diff(np.append(group, len(e)))))
            best = best[np.unique(e[best], return_index=True)[1]]  # the first of equal weights
            total[e[best]], last[e[best]], back[e[best]] = weight[best], x[best], s[best]
        on, at = np.zeros(n + 1, bool), np.append(first[1:], n)
        while len(at):
            on[at] = True
            at = back[at]
            at = at[~begins[at]]
        place = np.flatnonzero(on)
        ids = last[place]
        size = np.ones(len(place), np.int64)
        odd = np.flatnonzero((ids < 0) | (ids >= lexicon.n))  # characters without a piece
        rest = [self.model.rest(chr(c)) for c in code[place[odd] - 1].tolist()]
        size[odd] = list(map(len, rest))
        flat = np.repeat(ids, size)
        upto = np.cumsum(size)
        for k, r in zip(odd.tolist(), rest, strict=True):
            flat[upto[k] - size[k] : upto[k]] = r
        raw = flat.astype("<i4").tobytes()
        to = 4 * np.append(0, upto)[np.searchsorted(place, bounds, side="right")]
        return [raw[a:b] for a, b in zip(to[:-1].tolist(), to[1:].tolist(), strict=True)]

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, 32 bits each."""
        out: list[list[bytes]] = [[] for _ in texts]
        held, n = [], 0

        def solve():
            self.memo.learn({c for _, cuts in held for c in cuts})
            for i, cuts in held:
                out[i].extend(map(self.memo.__getitem__, cuts))

        for i, text in enumerate(texts):
            cuts = self.model.cut(text) if text else []
            for at in range(0, len(cuts), TOGETHER):
                held.append((i, cuts[at : at + TOGETHER]))
                n += len(held[-1][1])
                if n >= TOGETHER:
                    solve()
                    held, n = [], 0
        solve()
        return [b"".join(x) for x in out]

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed([text])[0], np.int32).tolist()


_made: dict[tuple, object] = {}


def _worker(make, path: str, kind: int | None):
    """One counter or transducer for each worker process."""
    if (make, path, kind) not in _made:
        _made.clear()
        _made[make, path, kind] = make(Model(path, kind))
    Memo.only(_made[make, path, kind].memo)
    return _made[make, path, kind]


def token_counts(docs: DataFrame, model: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and n_tokens, the number of pieces of the best unigram segmentation, for every row.

    A null or empty text has 0. Scores add up in double precision within a cut (the usual library adds in single precision over
    a whole text, which rounds beyond 2**24). Repeated rows count each. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)

    def of(batches):
        counter = _worker(Counter, model, UNIGRAM)
        for b in batches:
            counts = [counter(t) for t in b["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_tokens", T.LongType())])
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("_text")).mapInArrow(of, schema)


def encoded(
    docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), kind: int | None = None, with_text: bool = True,
) -> DataFrame:
    """The columns in keep, ids (array), and, from decoding them, decoded text and exact: whether it is the text again.

    A null or empty text has no ids and decodes to ''. The white-space mark in a text decodes to a space, so such a text is not
    exact. Repeated rows are encoded each. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)

    def of(batches):
        transducer = _worker(Transducer, model, kind)
        for b in batches:
            texts = b["_text"].to_pylist()
            ids = transducer.packed(texts)
            decoded = [transducer.model.decode(np.frombuffer(i, np.int32).tolist()) for i in ids]
            flat = np.frombuffer(b"".join(ids), np.int32)
            bounds = np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32)
            exact = pa.array([d == (t or "") for d, t in zip(decoded, texts, strict=True)], pa.bool_())
            cols = [*[b[f"_keep{i}"] for i in range(len(keep))], pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)), exact]
            cols += [pa.array(decoded, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "ids", "exact", *["decoded"] * with_text])

    fields = [T.StructField(c, docs.schema[c].dataType) for c in keep] + [
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("exact", T.BooleanType())
    ]
    schema = T.StructType(fields + [T.StructField("decoded", T.StringType())] * with_text)
    return docs.select(*[docs[c].alias(f"_keep{i}") for i, c in enumerate(keep)], docs[text].alias("_text")).mapInArrow(of, schema)
