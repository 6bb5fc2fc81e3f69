"""Records of large text files that can't be cut at every line: JSON arrays, and CSV with line breaks in fields.

Spark cuts a file into blocks wherever it likes. What a block's text means depends on the state at its beginning: inside or outside of
quotes, and which brackets are open. A first look at the blocks finds, for both answers to "inside?", where each would end up: how
many open brackets it closes and which it leaves open. These are composed block after block, a row for each block of a file, and give
every block its true state. A second look then cuts all blocks by themselves. Only records that reach over a block's end are put
together from their parts afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby
from typing import ClassVar

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talus.sources.shared import staged

#: Number of a record that goes on in the next block: above that of all others of its block.
LAST = 1 << 40
#: Brackets within brackets that are followed; no reader of JSON takes as many.
DEEPEST = 10_000
BATCH = 500
KEPT_BATCH_BYTES = 4 << 20


def file_path() -> Column:
    """The file's path as it was given; Spark hands it on with signs escaped."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


class Arrays:
    """Objects of one JSON array a file, cut by Spark at closing braces; other elements are passed over."""

    separator, glue, whole = "}", "", True
    _sign, _inside = re.compile(r'["\[\]{}]'), re.compile(r'(?:[^"\\]++|\\.)*+', re.S)

    @classmethod
    def text(cls, value: str, first: bool) -> str:
        """A part with the brace before it; the first part of a file without its byte order mark."""
        return value.removeprefix("﻿") if first else "}" + value

    @classmethod
    def brackets(cls, text: str, inside: bool) -> tuple[list[tuple[int, str]], bool]:
        """Places and signs of the brackets outside strings, and whether the end is inside one."""
        out, i = [], 0
        while i < len(text):
            if inside:
                i = cls._inside.match(text, i).end()
                if i == len(text) or text[i] != '"':
                    break  # the end, or a backslash before it
                inside, i = False, i + 1
            else:
                found = cls._sign.search(text, i)
                if not found:
                    break
                i = found.end()
                if found[0] == '"':
                    inside = True
                else:
                    out.append((found.start(), found[0]))
        return out, inside

    @classmethod
    def steps(cls, text: str, inside: bool) -> tuple[str, bool]:
        """The brackets as one text, and whether the end is inside a string."""
        found, inside = cls.brackets(text, inside)
        return "".join(sign for _, sign in found), inside

    @staticmethod
    def opened(stack: list[tuple[str, int]]) -> int | None:
        """The block in which the object at hand begins."""
        return stack[1][1] if len(stack) > 1 and stack[1][0] == "{" else None

    def __init__(self, block: int, inside: bool, stack: str, opened: int | None, first: bool):
        self.block, self.inside, self.depth, self.n = block, inside, len(stack), 0
        self.key, self.held = opened, None if opened is None else []
        self.begun, self.odd = not first, False

    def feed(self, text: str) -> Iterator[tuple[int, int, int, str]]:
        found, self.inside = self.brackets(text, self.inside)
        start = seen = 0
        for i, sign in found:
            if self.depth == 0:
                self.odd |= self.begun or sign != "[" or bool(text[seen:i].strip())
                self.begun, self.depth = True, 1
            elif sign in "[{":
                if self.depth == 1 and sign == "{":
                    self.held, self.key, start = [], self.block, i
                self.depth += 1
            else:
                self.depth -= 1
                if self.depth == 1 and self.held is not None:
                    self.held.append(text[start : i + 1])
                    yield self.record()
                seen = i + 1
        if self.held is not None:
            self.held.append(text[start:])
        if self.depth == 0:
            self.odd |= bool(text[seen:].strip())

    def record(self) -> tuple[int, int, int, str]:
        """Block and number of the record, the block that this part of it is from (-1: it is whole), and its text."""
        text, whole = self.glue.join(self.held), self.key == self.block
        self.held, self.n = None, self.n + whole
        return (self.block, self.n - 1, -1, text) if whole else (self.key, LAST, self.block, text)

    def rest(self) -> Iterator[tuple[int, int, int, str]]:
        if self.held is not None:
            yield self.key, LAST, self.block, self.glue.join(self.held)


class Csv(Arrays):
    """Records of CSV, cut by Spark at line breaks. A quote counts where a field begins and inside a quoted field, where two stand for one."""

    separator, glue, whole = "\n", "\n", False
    _quoted: ClassVar = re.compile(r'(?:[^"]++|"")*+')

    @classmethod
    def text(cls, value: str, first: bool) -> str:
        return value.removeprefix("﻿") if first else value

    @classmethod
    def open_after(cls, line: str, inside: bool) -> tuple[bool, bool]:
        """Whether a quoted field goes on after the line, and whether it is one that began in it."""
        if '"' not in line:
            return inside, False
        i, new = 0, False
        while True:
            if inside:
                i = cls._quoted.match(line, i).end()
                if i == len(line):
                    return True, new
                inside, i = False, i + 1
            elif line.startswith('"', i):
                inside, new, i = True, True, i + 1
                continue
            i = line.find(",", i) + 1
            if not i:
                return False, False

    @classmethod
    def steps(cls, text: str, inside: bool) -> tuple[str, bool]:
        """A record that goes on is an open bracket; another field that goes on is of the same record."""
        after, _ = cls.open_after(text, inside)
        return ("]" if inside and not after else "[" if after and not inside else ""), after

    @staticmethod
    def opened(stack: list[tuple[str, int]]) -> int | None:
        return stack[0][1] if stack else None

    def feed(self, text: str) -> Iterator[tuple[int, int, int, str]]:
        if self.held is None:
            if not text.strip("\r"):
                return
            self.held, self.key = [], self.block
        self.held.append(text)
        self.inside = self.open_after(text, self.inside)[0]
        if not self.inside:
            self.held[-1] = text.removesuffix("\r")
            yield self.record()


def reduced(steps: str, closes: int, opens: list[str]) -> int:
    """How many brackets that were open before are closed; what is left open is in ``opens``."""
    for sign in steps:
        if sign in "[{":
            opens.append(sign)
            if len(opens) > DEEPEST:
                raise ValueError(f"more than {DEEPEST} brackets within each other")
        elif opens:
            opens.pop()
        else:
            closes += 1
    return closes


def true_states(kind: type[Arrays], blocks: list[tuple[int, list]]) -> Iterator[tuple[int, bool, str, int | None, bool]]:
    """Block, inside, open brackets, the block where the record at hand begins; last a row of block -1 that says whether the file ends well.

    blocks: in order, with what each does when it begins outside and inside: inside at the end, number closed, brackets left open.
    """
    inside, stack, good = False, [], True
    for block, does in blocks:
        yield block, inside, "".join(sign for sign, _ in stack), kind.opened(stack), True
        inside, closes, opens = does[inside]
        good &= closes <= len(stack)
        del stack[max(0, len(stack) - closes) :]
        stack += [(sign, block) for sign in opens]
    yield -1, inside, "", None, good and not inside and not stack


def _runs(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple[tuple, Iterator[str]]]:
    """(file, block, ...) and the texts of each block; a block's rows follow each other."""
    rows = (row for b in batches for row in zip(*(b[c].to_pylist() for c in ("file", "block", *more, "value")), strict=True))
    for key, own in groupby(rows, key=lambda r: r[:-1]):
        yield key, (r[-1] for r in own)


def _looks(kind: type[Arrays]):
    def of(batches):
        for (file, block), values in _runs(batches):
            inside, closes, opens = [False, True], [0, 0], [[], []]
            for i, value in enumerate(values):
                text = kind.text(value, block == 0 and i == 0)
                same = inside[0] == inside[1]
                for way in (0, 1):
                    if way and same:  # both ways have met: what follows is alike
                        steps, inside[1] = found
                    else:
                        found = steps, inside[way] = kind.steps(text, inside[way])
                    closes[way] = reduced(steps, closes[way], opens[way])
            row = {"file": [file], "block": [block]}
            for way in (0, 1):
                row |= {f"inside{way}": [inside[way]], f"closes{way}": [closes[way]], f"opens{way}": ["".join(opens[way])]}
            yield pa.RecordBatch.from_pydict(row, _LOOKED)

    return of


_LOOKED = pa.schema(
    [("file", pa.string()), ("block", pa.int64())]
    + [(f"{name}{way}", t) for way in (0, 1) for name, t in (("inside", pa.bool_()), ("closes", pa.int64()), ("opens", pa.string()))]
)
_LOOKED_DDL = "file string, block bigint, " + ", ".join(f"inside{w} boolean, closes{w} bigint, opens{w} string" for w in (0, 1))


def _composing(kind: type[Arrays]):
    def of(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        ways = [list(zip(frame[f"inside{w}"], frame[f"closes{w}"], frame[f"opens{w}"], strict=True)) for w in (0, 1)]
        found = true_states(kind, list(zip(frame["block"].tolist(), map(list, zip(*ways, strict=True)), strict=True)))
        out = pd.DataFrame(found, columns=["block", "inside", "stack", "opened", "good"])
        out.insert(0, "file", frame["file"].iloc[0])
        return out.astype({"opened": "Int64"})

    return of


_CUT = pa.schema([("file", pa.string()), ("block", pa.int64()), ("row", pa.int64()), ("part", pa.int64()), ("value", pa.string())])
_CUT_DDL = "file string, block bigint, row bigint, part bigint, value string"


def _cutting(kind: type[Arrays]):
    def of(batches):
        out, size = [], 0
        for (file, block, inside, stack, opened), values in _runs(batches, "inside", "stack", "opened"):
            if inside is None:
                raise RuntimeError(f"{file} was cut into other blocks than before")
            one = None
            for i, value in enumerate(values):
                first = block == 0 and i == 0
                one = one or kind(block, inside, stack, opened, first)
                for row in one.feed(kind.text(value, first)):
                    out.append((file, *row))
                    size += len(row[-1])
                if len(out) >= BATCH or size > KEPT_BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), _CUT, strict=True)], schema=_CUT)
                    out, size = [], 0
            out += [(file, *row) for row in one.rest()]
            if one.odd:
                out.append((file, block, -1, -1, None))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), _CUT, strict=True)], schema=_CUT)

    return of


@contextmanager
def same_blocks(spark: SparkSession) -> Iterator[None]:
    """Inside, files are cut alike at every look, however many executors there are by then."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    if before is None:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)


def numbered_blocks(counts: DataFrame) -> DataFrame:
    """file, block, n, and how many records there are before the block, in its file and in all sorted files. counts: file, block and n."""
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    of_file = before(Window.partitionBy("file").orderBy("block")).alias("before_in_file")
    return counts.select("file", "block", "n", of_file, before(Window.orderBy("file", "block")).alias("before"))  # a row for each block


def records(spark: SparkSession, paths: list[str], kind: type[Arrays]) -> DataFrame:
    """file, pos, number (dense from 0 over the sorted files), in_file (the same in its file) and value of all records.

    Files are read twice, and cut records are written to the shared folder. The table of states has a row for each block, of which the
    driver holds as many in its listing of files; it is sent to all executors. ValueError if a JSON file isn't one whole array.
    """
    read = spark.read.option("lineSep", kind.separator).text(paths)
    scan = read.select(file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    with same_blocks(spark):
        looked = scan.mapInArrow(_looks(kind), _LOOKED_DDL)
        states = looked.groupBy("file").applyInPandas(_composing(kind), "file string, block bigint, inside boolean, stack string, opened bigint, good boolean")
        states = staged(states, "states")
        bad = states.filter("not good").select("file").orderBy("file").first() if kind.whole else None
        if bad:
            raise ValueError(f"{bad['file']} is no whole JSON array")
        known = F.broadcast(states.drop("good"))
        cut = scan.join(known, ["file", "block"], "left").select("file", "block", "inside", "stack", "opened", "value")
        cut = staged(cut.mapInArrow(_cutting(kind), _CUT_DDL), "records")
    odd = cut.filter("row = -1").select("file").orderBy("file").first()
    if odd:
        raise ValueError(f"{odd['file']} is no whole JSON array")
    parts = F.array_sort(F.collect_list(F.struct("part", "value")))  # of one record
    joined = cut.filter("part >= 0").groupBy("file", "block", "row").agg(F.array_join(F.transform(parts, lambda p: p["value"]), kind.glue).alias("value"))
    if not kind.whole:
        joined = joined.withColumn("value", F.regexp_replace("value", "\r$", ""))
    every = cut.filter("part < 0").drop("part").unionByName(joined)
    counts = cut.select("file", "block", "row").distinct().groupBy("file", "block").agg(F.count("*").alias("n"))
    places = staged(numbered_blocks(counts), "places")
    place = F.least(F.col("row"), F.col("n") - 1)  # a record that reaches over the end is the last of its block
    return every.join(F.broadcast(places), ["file", "block"]).select(
        "file", F.struct("file", "block", "row").alias("pos"), (F.col("before") + place).alias("number"), (F.col("before_in_file") + place).alias("in_file"), "value"
    )
