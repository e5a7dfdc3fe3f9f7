"""One query for each operator, over its whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, jaccard_join, language_id, oracle, quality, secrets, sentence_pieces, sharding, substring_dedup, token_counts, top_k
from tessera.llm.common import table
from tessera.llm.spm_model import SentencePieceModel

#: A public vocabulary, read on the driver; never copied into this repository.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def op1_sentence_pieces(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Encode every document, decode the ids again: ``doc_id, n_pieces, ids_xxh64, n_decoded, round_trip``."""
    both = sentence_pieces.round_trip(table(spark, sf_dir, "documents"), SentencePieceModel.load(vocabulary), memory=3)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), F.xxhash64("ids").alias("ids_xxh64"), "n_decoded", "round_trip")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other vectors of each query vector (ids divisible by 100), by integer inner product."""
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages that documents of smaller ids have."""
    return substring_dedup.parse(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 40, its slot there, and its shard of 41."""
    return sharding.assign(table(spark, sf_dir, "documents"), 40)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, told apart by how many sources hold them."""
    return secrets.digests(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Word-piece token counts of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), SentencePieceModel.load(vocabulary))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from two of three folds of the labels."""
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that windows of the benchmark cover, and the items they come from."""
    found = decontamination.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under exact links of 85 % of four-word shingles, and its number of links."""
    return jaccard_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four of five folds of ids."""
    found = language_id.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentence_pieces": op1_sentence_pieces,
    "op2_top_k": op2_top_k,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_sharding": op4_sharding,
    "op5_secrets": op5_secrets,
    "op6_token_counts": op6_token_counts,
    "op7_quality": op7_quality,
    "op8_decontamination": op8_decontamination,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_language_id": op10_language_id,
}

ORACLE_SQL: dict[str, str] = oracle.SQL
