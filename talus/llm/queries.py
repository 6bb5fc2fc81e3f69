"""The registered queries of the operators, one for each, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talus.llm import cluster, fertility, fim, language, media, mixing, pieces, quality, simhash, substring, tokens, topk
from talus.llm.common import doc_crc

PIECES, WORDS, RANKS = "piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup_substrings(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; import and files are wanted only where a query runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_token_counts(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    return pieces.token_counts(_table(spark, sf_dir, "documents"), model or vocabulary(PIECES))


def op7_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    out = pieces.encoded(_table(spark, sf_dir, "documents"), model or vocabulary(PIECES))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_xxhash64"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "exact"
    )


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_column(_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return tokens.token_files(_table(spark, sf_dir, "documents"), tokenizer or vocabulary(WORDS))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = (doc_crc(F.col("doc_id")) % language.FOLDS == language.HELD_OUT).alias("held_out")
    return language.predict(docs, language.fit(docs)).select("doc_id", held_out, "lang_pred", "score")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(_table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output").alias("output_sha256"), digest("restored_text").alias("restored_sha256")
    )


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.cluster(_table(spark, sf_dir, "embeddings"))


def vocabularies() -> tuple[fertility.Vocabulary, ...]:
    import public_tokenizers

    return fertility.Vocabulary("piece", vocabulary(PIECES)), fertility.Vocabulary("rank", vocabulary(RANKS), public_tokenizers.PATTERN)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.rules(_table(spark, sf_dir, "documents"), vocabularies())


_ALL = (
    op1_substring_dedup, op2_simhash, op3_mixing, op4_exact_topk, op5_token_counts, op6_quality, op7_sentencepiece, op8_media, op9_token_files,
    op10_language_id, op11_fill_in_middle, op12_clustering, op13_quality_rules
)
QUERIES = {f.__name__: f for f in _ALL}

ORACLES: dict[str, str] = {
    "op3_mixing": mixing.ORACLE, "op4_exact_topk": topk.ORACLE, "op11_fill_in_middle": fim.ORACLE, "op12_clustering": cluster.ORACLE
}
