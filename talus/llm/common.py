"""What the corpus operators share: memories of workers, word splitting and rolling hashes."""

from __future__ import annotations

import weakref
from collections.abc import Callable, Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from talus.sources.shared import new_path, scratch, ship, staged, written

__all__ = ["new_path", "scratch", "staged", "written"]

#: Bytes that separate words; ``bytes.split()`` splits at exactly these.
SPACES = r"\x20\x09-\x0D"
WORD = f"[^{SPACES}]+"
ARROW_ROWS, ARROW_BYTES = 1000, 4 << 20
#: Bytes of a memo's young generation, what an entry weighs, and what each sign of its key adds to it and its value, as estimated.
MEMO_BYTES, ENTRY_BYTES, SIGN_BYTES = 24 << 20, 200, 4


def prepare(spark: SparkSession) -> None:
    """Batches for Python hold few enough rows that very long texts fit a worker; workers get this package by Spark's file server."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def word_count(text: Column) -> Column:
    """Words of a text without an array of them: starts of runs of other characters than spaces. Null counts 0."""
    return F.coalesce(F.length(F.regexp_replace(F.regexp_replace(text, WORD, "w"), f"[{SPACES}]+", "")), F.lit(0)).cast("long")


def doc_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


class Memo(dict):
    """key -> value of a function, in two generations.

    A young one that weighs ``most`` bytes becomes the old one, and what was old is forgotten; keys that are asked for again come
    back from it. ``learn`` gets many keys at once, where a function of many is faster. Keys are texts; values are never None.
    """

    _every: list[weakref.ref] = []

    def __init__(self, of: Callable, most: int = MEMO_BYTES, of_many: Callable[[list], Iterable] | None = None):
        super().__init__()
        self.of, self.of_many, self.most, self.bytes, self.old = of, of_many or (lambda keys: map(of, keys)), most, 0, {}
        Memo._every.append(weakref.ref(self))

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.of(key)
        self._put(key, value)
        return value

    def _put(self, key, value) -> None:
        if self.bytes > self.most:
            self.old, self.bytes = self.copy(), 0
            self.clear()
        self[key] = value
        self.bytes += ENTRY_BYTES + SIGN_BYTES * len(key)

    def learn(self, keys: Iterable) -> None:
        """Afterwards most keys are known, all where they weigh less than a generation."""
        new = []
        for key in keys:
            if key not in self:
                if (value := self.old.get(key)) is None:
                    new.append(key)
                else:
                    self._put(key, value)
        for key, value in zip(new, self.of_many(new) if new else (), strict=True):
            self._put(key, value)

    def forget(self) -> None:
        self.clear()
        self.old, self.bytes = {}, 0

    @classmethod
    def only(cls, *own: Memo) -> None:
        """Forgets all memos of this worker but the given ones: what an earlier stage left isn't carried along."""
        cls._every = [r for r in cls._every if r() is not None]
        for memo in (r() for r in cls._every):
            if memo is not None and not any(memo is x for x in own):
                memo.forget()


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def hashed(words: list[bytes]) -> np.ndarray:
    """A hash of each word; remembering them would take more memory than it saves time."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of all runs of k values: a polynomial modulo 2**64 by prefix sums, then mixed."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base | 1, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __call__(self, h: np.ndarray, k: int) -> np.ndarray:
        n = len(h)
        if n < k:
            return np.zeros(0, np.uint64)
        if len(self.up) < n + 1:
            room = max(n + 1, 1 << 15)
            powers = lambda b: np.concatenate([[np.uint64(1)], np.cumprod(np.full(room, b, np.uint64))])
            self.up, self.down = powers(np.uint64(self.base)), powers(np.uint64(pow(self.base, -1, 1 << 64)))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(h * self.up[:n], out=total[1:])
        return mix((total[k:] - total[:-k]) * self.down[: n - k + 1])


def sliding(x: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """pick over all runs of width values, by doubling."""
    out, step = x, 1
    while step * 2 <= width:
        out, step = pick(out[:-step], out[step:]), step * 2
    rest = width - step
    return pick(out[: len(out) - rest], out[rest:]) if rest else out
