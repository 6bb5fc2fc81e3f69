"""Order without one big sort: first and last rows of keys, running totals and global ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_of(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by an explicit order; Spark keeps only one row per task and key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def step(x: Column) -> Column:
    """A coarse value that never falls as x rises: sixteen steps for each doubling, some thousand at most."""
    return (F.signum(x) * F.floor(F.log2(F.abs(x) + 1) * 16)).cast("int")


def percentiles(df: DataFrame, key: str, values: list[str], first_seen: str | None = None) -> DataFrame:
    """key, metric and share: each value's percentile among all rows, for all metrics at once.

    Ties share the mean of their first and last place; with first_seen, a number or position that is unique, they stand in its order. Values are
    counted first, so places come from running sums over steps of distinct values and no task sorts all rows.
    """
    if first_seen:  # ranges of the order: of numbers, or the blocks of files of a reader's position
        seen = F.col(first_seen)
        part = F.floor(seen / 65_536) if not isinstance(df.schema[first_seen].dataType, T.StructType) else F.struct(seen["pos"]["file"], seen["pos"]["block"])
    long = df.select(
        key, *([F.col(first_seen).alias("_seen"), part.alias("_part")] if first_seen else []),
        F.explode(F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("_v")) for v in values])).alias("m")
    )
    long = long.select("*", "m.metric", F.col("m._v").alias("_v")).drop("m")
    cell = ["metric", "_v", "_part"] if first_seen else ["metric", "_v"]
    order = cell[1:]
    cells = long.groupBy(*cell).agg(F.count("*").alias("_n")).withColumn("_step", step(F.col("_v")))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    steps = cells.groupBy("metric", "_step").agg(F.sum("_n").alias("_sum"))
    every = Window.partitionBy("metric")
    steps = steps.select(
        "metric", "_step", F.coalesce(F.sum("_sum").over(upto(every.orderBy("_step"))), F.lit(0)).alias("_below"),
        F.sum("_sum").over(every).alias("_total")
    )
    inside = F.coalesce(F.sum("_n").over(upto(Window.partitionBy("metric", "_step").orderBy(*order))), F.lit(0))
    cells = cells.withColumn("_inside", inside).join(steps, ["metric", "_step"])
    place = F.col("_below") + F.col("_inside")
    if first_seen:
        placed = long.withColumn("_place", F.row_number().over(Window.partitionBy(*cell).orderBy("_seen")))
        share = (place + F.col("_place")) / F.col("_total")
    else:
        placed, share = long, (2 * place + F.col("_n") + 1) / F.lit(2.0) / F.col("_total")
    return placed.join(cells, cell).select(key, "metric", share.alias("share"))
