"""A corpus in five stages: language ID, near-dedup, substring dedup, mixing and encoding.

Each stage takes what its predecessor kept and returns documents (doc_id, text, lang, source, n_chars); the last returns their
ids. Stages talk through Parquet only. Rules for odd rows:

* language: rows whose language can't be told (null text, or no letter in it) go; all others stay as they are.
* near: the SimHash operator with five-word shingles; texts link where the Jaccard similarity of these is 0.8 or more. One row of
  each component stays, the one with the least doc_id (null is last), then the least hash of its text. Rows are told apart by id
  and text: ids may be null or shared.
* repeats: words of repeated windows go; a document that keeps all its words keeps its text as it was, one that keeps none goes.
* mix: a document is there as often as the mix takes it, up to three times; those it doesn't take go.
* encode: ids of every row, and whether decoding gives the text again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talus.llm import language, mixing, pieces, simhash, substring
from talus.llm.common import new_path, scratch, staged, written
from talus.llm.queries import PIECES, vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    told = language.predict(docs, language.fit(docs), keep=COLUMNS)
    return told.filter(F.col("lang_pred") != language.UNKNOWN).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # keys are narrow: which rows stay is settled without texts, and each text is read once more, where its key stays
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    found = simhash.near_duplicates(docs.select("text", row.alias("_row")), doc_id="_row", shingle=5, similarity=0.8)
    key = lambda doc_id, text: F.concat_ws(":", text, doc_id.cast("string")).alias("_k")
    stay = found.filter("doc_id = component_id").select(key(F.col("doc_id.id"), F.col("doc_id.text"))).distinct()
    kept = docs.select(*COLUMNS, key(F.col("doc_id"), F.xxhash64("text"))).join(stay, "_k", "left_semi")
    one = Window.partitionBy("_k").orderBy("text")  # the join's partitioning serves the window too
    return kept.withColumn("_n", F.row_number().over(one)).filter("_n = 1").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = substring.dedup_substrings(docs, keep=COLUMNS)
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept_text"))
    out = kept.filter("n_removed = 0 or n_removed < n_words").withColumn("text", text)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs, keep=COLUMNS[1:])
    return mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str, model: str | None = None) -> DataFrame:
    out = pieces.encoded(docs, model or vocabulary(PIECES), keep=("doc_id", "lang", "source"), with_text=False)
    return out.withColumn("n_tokens", F.size("ids").cast("long")).select("doc_id", "lang", "source", "n_tokens", "ids", "exact")


STAGES = [
    ("language", tell_language),
    ("near", drop_near_copies),
    ("repeats", drop_repeats),
    ("mix", mix_sources),
    ("encode", encode),
]
#: Near copies, windows and piece encoding have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), path)
    return docs
