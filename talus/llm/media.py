"""Media columns: payloads as greyscale PNG in a binary column, read back with checksum tests, and cosine-transform hashes.

A payload fills rows of ``WIDTH`` 8-bit samples. Encoding picks the filter of each row, none, sub or up, by the least sum of
absolute differences; decoding knows all five filters. Every chunk's crc32 and the data's zlib checksum are tested on reading.
The feature is a 64-bit hash: the picture averaged to 32 by 32 cells, its lowest 8 by 8 cosine coefficients against their median.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talus.llm.common import new_path, prepare

WIDTH, FILL, TAIL, LEVEL = 576, 255, 32, 6
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CELLS, LOW = 32, 8
_n = np.arange(CELLS)
_COSINE = np.cos(np.pi * (2 * _n[None, :] + 1) * _n[:LOW, None] / (2 * CELLS))


def payload(text: str | None, width: int = WIDTH) -> tuple[bytes, int]:
    """UTF-8 bytes filled up to a positive multiple of width, and their number before that."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    return raw + bytes([FILL]) * (width * max(1, -(-len(raw) // width)) - len(raw)), len(raw)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def png_encode(data: bytes, width: int = WIDTH, level: int = LEVEL) -> bytes:
    """data: 8-bit grey samples, row after row."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, width)
    sub, up = rows.copy(), rows.copy()
    sub[:, 1:] -= rows[:, :-1]
    up[1:] -= rows[:-1]
    cost = np.stack([np.abs(x.view(np.int8).astype(np.int16)).sum(axis=1, dtype=np.int64) for x in (rows, sub, up)])
    kind = cost.argmin(axis=0)
    lines = np.empty((len(rows), width + 1), np.uint8)
    lines[:, 0] = kind
    lines[:, 1:] = np.where(kind[:, None] == 1, sub, np.where(kind[:, None] == 2, up, rows))
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def png_decode(png: bytes) -> np.ndarray:
    """Samples of an 8-bit greyscale picture; ValueError if it is damaged or of another kind."""
    if png[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, size, data, ended = 8, None, [], False
    while at < len(png) and not ended:
        if at + 12 > len(png):
            raise ValueError("cut off within a chunk")
        n, kind = struct.unpack_from(">I4s", png, at)
        body = png[at + 8 : at + 8 + n]
        if len(body) != n or at + 12 + n > len(png) or struct.unpack_from(">I", png, at + 8 + n)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"chunk {kind!r} fails its checksum")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        ended, at = kind == b"IEND", at + 12 + n
    if not ended or size is None or size[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not a whole 8-bit greyscale picture")
    try:
        lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    except zlib.error as wrong:
        raise ValueError("picture data fail their checksum") from wrong
    width, height = size[:2]
    if lines.size != height * (width + 1):
        raise ValueError("picture data of another length")
    return unfilter(lines.reshape(height, width + 1))


def unfilter(lines: np.ndarray) -> np.ndarray:
    """Samples of filtered lines, each with its filter before it."""
    kind, out = lines[:, 0], lines[:, 1:].copy()
    if (kind > 4).any():
        raise ValueError("unknown filter")
    alone = kind == 1
    out[alone] = np.cumsum(out[alone], axis=1, dtype=np.uint8)
    above = np.zeros(out.shape[1], np.uint8)
    for y in np.flatnonzero(kind > 1):
        if y:
            above = out[y - 1]
        row = out[y]
        if kind[y] == 2:
            row += above
            continue
        left = upper_left = 0
        for x, (value, b) in enumerate(zip(row.tolist(), above.tolist(), strict=True)):
            if kind[y] == 3:
                guess = (left + b) >> 1
            else:
                p = left + b - upper_left
                near = (abs(p - left), abs(p - b), abs(p - upper_left))
                guess = left if near[0] <= near[1] and near[0] <= near[2] else b if near[1] <= near[2] else upper_left
            left, upper_left = (value + guess) & 255, b
            row[x] = left
    return out


def cosine_hash(picture: np.ndarray) -> str:
    """16 hex digits; each bit tells if a coefficient lies above the median."""
    cell = lambda n: (np.arange(CELLS) * n // CELLS, np.maximum((np.arange(CELLS) + 1) * n // CELLS, np.arange(CELLS) * n // CELLS + 1))
    (top, bottom), (left, right) = cell(picture.shape[0]), cell(picture.shape[1])
    sums = np.zeros((picture.shape[0] + 1, picture.shape[1]), np.int64)
    np.cumsum(picture, axis=0, dtype=np.int64, out=sums[1:])
    bands = sums[bottom] - sums[top]
    across = np.zeros((CELLS, picture.shape[1] + 1), np.int64)
    np.cumsum(bands, axis=1, out=across[:, 1:])
    mean = (across[:, right] - across[:, left]) / ((bottom - top)[:, None] * (right - left)[None, :])
    low = np.round(_COSINE @ mean @ _COSINE.T, 6).ravel()
    return np.packbits(low > np.median(low)).tobytes().hex()


def write_media(docs: DataFrame, path: str | None = None, text: str = "text", doc_id: str = "doc_id") -> str:
    """Parquet with doc_id, n_bytes and the binary column media; returns its path."""
    spark = docs.sparkSession
    prepare(spark)
    path = path or new_path(spark, "media")

    def of(batches):
        for b in batches:
            each = [payload(t) for t in b["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array([n for _, n in each], pa.int64()), pa.array([png_encode(p) for p, _ in each], pa.binary())],
                names=["doc_id", "n_bytes", "media"]
            )

    schema = T.StructType([
        T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())
    ])
    docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("_text")).mapInArrow(of, schema).write.option("compression", "none").parquet(path)
    return path


def media_features(spark: SparkSession, path: str, doc_type: T.DataType | None = None) -> DataFrame:
    """Of what write_media stored: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature. A damaged picture fails the job."""
    prepare(spark)
    kind = T.StructField("doc_id", doc_type or T.LongType())
    stored = spark.read.schema(T.StructType([kind, T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])).parquet(path)
    fields = [
        kind,
        *[
            T.StructField(n, t)
            for n, t in (
                ("n_bytes", T.LongType()), ("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()),
                ("feature", T.StringType()), ("media", T.BinaryType())
            )
        ]
    ]

    def of(batches):
        for b in batches:
            pictures = [png_decode(m) for m in b["media"].to_pylist()]
            raw = [p.tobytes() for p in pictures]
            yield pa.RecordBatch.from_arrays(
                [
                    b["doc_id"], b["n_bytes"], pa.array(map(len, raw), pa.int64()), pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
                    pa.array([zlib.crc32(r[-TAIL:]) for r in raw], pa.int64()), pa.array(map(cosine_hash, pictures), pa.string()), b["media"]
                ],
                names=[f.name for f in fields],
            )

    out = stored.mapInArrow(of, T.StructType(fields))
    return out.select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), "feature"
    )


def media_column(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Stores docs as pictures and returns their features; one row for each input row.

    A null text counts as empty, a picture of one row of fill. Equal texts give equal values, repeated rows too. An empty table
    gives an empty result.
    """
    return media_features(docs.sparkSession, write_media(docs, text=text, doc_id=doc_id), docs.schema[doc_id].dataType)
