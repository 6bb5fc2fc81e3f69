"""Incremental ingest: new files go through the same filter and append, each item once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from talus.operators.order import first_of
from talus.operators.select import ingest_filter, with_shard
from talus.plans.specs import SourceSpec


def append_new(batch: DataFrame, target: str, spec: SourceSpec, clean: Callable[[DataFrame], DataFrame] = lambda x: x) -> None:
    """Appends items of a batch that the target lacks (by shard and item_id). Running a batch again adds nothing."""
    spark = batch.sparkSession
    items = first_of(
        with_shard(ingest_filter(clean(batch), spec), spec), ["shard", "item_id"],
        batch["source_index"] if "source_index" in batch.columns else batch["item_id"]
    )
    where = spark._jvm.org.apache.hadoop.fs.Path(target)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        shards = [r["shard"] for r in items.select("shard").distinct().collect()]  # spec.shards at most; only their folders are read
        held = spark.read.schema(items.schema).parquet(target).filter(F.col("shard").isin(shards)).select("shard", "item_id")
        items = items.join(held, ["shard", "item_id"], "left_anti")
    items.write.mode("append").partitionBy("shard").parquet(target)


def ingest_stream(
    spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, spec: SourceSpec,
    clean: Callable[[DataFrame], DataFrame] = lambda x: x
) -> StreamingQuery:
    """Takes all JSON-line files of source that the checkpoint doesn't know yet, then ends."""
    rows = spark.readStream.schema(schema).json(source)
    return rows.writeStream.foreachBatch(lambda batch, _: append_new(batch, target, spec, clean)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
