"""Bloom filters of keys out of Spark's bitmap functions: rows whose key can't be among some keys go before they are parsed or sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bucket (those of Spark's bitmaps), bits that a key sets, bits for each key, and most buckets: the filter is 32 MB at most.
BUCKET, PLACES, BITS_A_KEY, MOST = 32_768, 4, 12, 8_192
#: Raw JSON values whose text may be written otherwise, or that are none: these can't be told by the raw value.
WRITTEN_OTHERWISE = r"(?s)^(|true|false|[\[{].*|-?\d+[.eE].*|-?\d{19,})$"


def _bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _places(key: Column) -> list[Column]:
    h = F.xxhash64(key, F.lit(7))
    return [F.shiftright(h, 15 * i).bitwiseAND(BUCKET - 1) for i in range(PLACES)]


def key_filter(keys: DataFrame, n: int) -> tuple[DataFrame, int] | None:
    """Buckets of bits, and their number, of the one column of keys, n rows; None if they are too many for a filter to tell much.

    A key's bits lie in one bucket, so a row meets the filter in one join. Of keys that aren't among them some 1 % pass.
    """
    buckets = max(1, -(-n * BITS_A_KEY // BUCKET))
    if buckets > 4 * MOST:
        return None
    buckets, key = min(buckets, MOST), F.col(keys.columns[0])
    each = keys.filter(key.isNotNull()).select(_bucket(key, buckets).alias("_bucket"), F.explode(F.array(*_places(key))).alias("_place"))
    return each.groupBy("_bucket").agg(F.bitmap_construct_agg("_place").alias("_bits")), buckets


def maybe(rows: DataFrame, among: tuple[DataFrame, int] | None, key: Column, unknown: Column | None = None) -> DataFrame:
    """rows whose key may be among those of the filter; all that are not sure to be absent, those that are ``unknown`` included."""
    if among is None:
        return rows
    buckets, n = among
    byte = lambda place: F.conv(F.hex(F.substr("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    held = F.lit(True)
    for place in _places(F.col("_key")):
        held = held & (byte(place).bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (place % 8 + 1).cast("int"))) != 0)
    passes = F.coalesce(held, F.lit(False)) if unknown is None else F.coalesce(F.col("_unknown"), F.lit(False)) | F.coalesce(held, F.lit(False))
    out = rows.withColumns({"_key": key, "_bucket": _bucket(key, n), "_unknown": F.lit(False) if unknown is None else unknown})
    met = out.join(F.broadcast(buckets), "_bucket", "left")  # MOST buckets of 4 KB
    return met.filter(passes).select(*rows.columns)
