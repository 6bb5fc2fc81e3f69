"""Sinks: JSON lines, documents, shards, prompt logs and digests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talus.functions.text import shard


def write_json_lines(df: DataFrame, path: str, gzip: bool = False, append: bool = False) -> str:
    """JSON lines, nulls written, characters as they are."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).option("compression", "gzip" if gzip else "none").json(path)
    return path


#: Most rows of a shard's file, and most bytes of a file that is read as one row.
FILE_ROWS, WHOLE_FILE = 2_000_000, 1 << 30


def _by_shard(rows: DataFrame, path: str, most: int) -> str:
    """Small shards are one file each, and large ones as many as their size asks for: the rebalancing lets Spark split partitions at run time."""
    rows.hint("rebalance", "shard").write.mode("overwrite").option("maxRecordsPerFile", most).partitionBy("shard").parquet(path)
    return path


def write_shards(items: DataFrame, path: str, n: int, most: int = FILE_ROWS) -> str:
    """Parquet by shard of the user. A shard beyond Spark's advisory partition size, as a hot user's, is written by many tasks."""
    return _by_shard(items.withColumn("shard", shard(F.col("user_id"), n)), path, most)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_personas(personas: DataFrame, path: str) -> str:
    """Adds a batch of users; the commit of the write makes it durable as a whole, and ``not_done`` skips its users afterwards."""
    return write_json_lines(personas, path, append=True)


def write_json(spark: SparkSession, document: dict, path: str) -> str:
    """An indented JSON document, through Spark's file systems."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray((json.dumps(document, ensure_ascii=False, indent=2) + "\n").encode("utf-8")))
    finally:
        out.close()
    return path


def write_document(row: DataFrame, path: str) -> str:
    """One row as an indented JSON document."""
    text = row.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).first()["j"]
    return write_json(row.sparkSession, json.loads(text), path)


def write_prompt_log(prompts: DataFrame, path: str, shards: int = 64) -> str:
    """user_id, chunk and prompt in Parquet, in a folder for each shard of the user; a new log takes the old one's place. A text file for each prompt would be millions of them."""
    return _by_shard(prompts.select("user_id", "chunk", "prompt", shard(F.col("user_id"), shards).alias("shard")), path, FILE_ROWS)


def file_sha256(spark: SparkSession, path: str) -> DataFrame:
    """path and sha256 of each file that a path or pattern names. Files of up to a gigabyte are read by tasks; larger ones, which no row can hold, are streamed one by one."""
    jvm, where = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    fs, rows = where.getFileSystem(spark._jsc.hadoopConfiguration()), []
    large = [f.getPath() for f in fs.globStatus(where) or [] if f.getLen() > WHOLE_FILE]
    for one in large:
        data = fs.open(one)
        try:
            rows.append((one.toString(), jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(data)))
        finally:
            data.close()
    small = spark.read.format("binaryFile").load(path).filter(F.col("length") <= WHOLE_FILE).select("path", F.sha2("content", 256).alias("sha256"))
    return small.unionByName(spark.createDataFrame(rows, "path string, sha256 string")) if rows else small
