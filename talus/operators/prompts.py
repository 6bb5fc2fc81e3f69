"""Dimension schemas, their chunks, and prompts as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talus.functions.text import glob_match

DIMENSION = "id: string, label: string, group: string, subgroup: string, category: string, description: string, values: array<string>, index: int, defaultValue: string"
RULES = (
    "From the history below, fill in attributes of the person who wrote it.",
    'Answer with one JSON object and nothing else: {"fields": [{"field_id", "value", "confidence", "evidence", "description", "assignment_type"}]}.',
    "Give one object for each attribute listed, and no other.",
    "value: one of the attribute's allowed values, letter for letter, or null. confidence: a number from 0 to 1.",
    "evidence: words copied exactly from the history; without them the value is null.",
    "assignment_type: direct (the person says so), structured_claim (at least two separate remarks), summary_inference (a pattern that recurs) or unsupported.",
    "Age, gender, origin, belief, politics, health, income, family and work count only if the person states them.",
    "What concerns other people, gifts or general praise proves nothing about the person.",
    "Start from null and unsupported, with confidence 0 and empty evidence; most attributes stay so.",
)


def load_dimensions(spark: SparkSession, path: str) -> DataFrame:
    """A schema document's dimensions, a row each with pos from 0. It must hold some, each with an id of its own."""
    document = spark.read.schema(f"dimensions array<struct<{DIMENSION}>>").option("multiLine", True).json(path)
    out = document.select(F.posexplode("dimensions").alias("pos", "d")).select("pos", "d.*")
    n, ids, missing = out.agg(F.count("*"), F.count_distinct("id"), F.count_if(F.coalesce("id", F.lit("")) == "")).first()
    if not n or ids != n or missing:
        raise ValueError(f"{path}: dimensions must be there and have ids of their own")
    return out


def load_mapping(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Patterns of supported and of skipped categories of an evidence mapping."""
    schema = "evidence_categories array<struct<id string, schema_categories array<string>>>, skip_by_default_schema_categories array<string>"
    document = spark.read.schema(schema).option("multiLine", True).json(path)
    supported = document.select(F.explode("evidence_categories").alias("e")).select(F.explode("e.schema_categories").alias("pattern")).distinct()
    return supported, document.select(F.explode("skip_by_default_schema_categories").alias("pattern")).distinct()


def schema_subset(dims: DataFrame, supported: DataFrame, skipped: DataFrame) -> DataFrame:
    """Dimensions whose category fits a supported pattern and no skipped one."""
    fits = lambda p: glob_match(F.col("category"), p["pattern"])
    yes, no = supported.select(F.col("pattern")), skipped.select(F.col("pattern"))
    return dims.join(F.broadcast(yes), fits(yes), "left_semi").join(F.broadcast(no), fits(no), "left_anti")  # patterns come from one small document


def chunked(dims: DataFrame, size: int) -> DataFrame:
    """dims with chunk, numbered from 0: categories in the order of their first dimension, ``size`` dimensions each, and rank, the order of the output."""
    category = Window.partitionBy("category")
    out = dims.withColumn("_first", F.min("pos").over(category)).withColumn("_part", F.floor((F.row_number().over(category.orderBy("pos")) - 1) / size))
    every = Window.partitionBy(F.lit(0))  # a schema has few rows
    return out.withColumn(
        "chunk", F.dense_rank().over(every.orderBy("_first", "_part")) - 1
    ).withColumn("rank", F.row_number().over(every.orderBy("_first", "pos"))).drop("_first", "_part")


def dimension_line(id_: Column, label: Column, description: Column, values: Column) -> Column:
    allowed = F.coalesce(F.nullif(F.array_join(values, " | "), F.lit("")), F.lit("(free value)"))
    return F.concat_ws(" | ", F.concat(F.lit("- "), id_), F.coalesce(label, id_), F.coalesce(description, F.lit("")), F.concat(F.lit("["), allowed, F.lit("]")))


def prompts(profiles: DataFrame, chunks: DataFrame, rules: tuple[str, ...] = RULES) -> DataFrame:
    """user_id, chunk, prompt: every profile with every chunk, or with those of its array ``chunks``. Chunks are few rows of a schema, so they are broadcast.

    Prompts are put together behind the last shuffle of the profiles: nothing that is as large as profiles times chunks is ever sent.
    """
    lines = chunks.groupBy("chunk").agg(F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", dimension_line(F.col("id"), F.col("label"), F.col("description"), F.col("values")).alias("line")))),
            lambda x: x["line"]
        ),
        "\n"
    ).alias("dimension_lines"))
    text = F.concat_ws("\n", F.lit("\n".join(rules)), F.lit("\nATTRIBUTES:"), "dimension_lines", F.lit("\nHISTORY:"), "profile_text")
    if "chunks" in profiles.columns:
        each = profiles.withColumn("chunk", F.explode("chunks")).join(F.broadcast(lines), "chunk")
    else:
        each = profiles.crossJoin(F.broadcast(lines))
    return each.select("user_id", "chunk", text.alias("prompt"))
