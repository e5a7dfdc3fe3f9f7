"""The corpus pipeline: five stages, each on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs. All stages take texts of any length whole, keep columns of any name (the last returns its
own) and give an empty table for an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, jaccard_join, language_id, secrets, sentence_pieces
from tessera.llm.common import saved, table
from tessera.llm.queries import VOCABULARY
from tessera.llm.spm_model import SentencePieceModel

NEAR_LEAST = 80
NEAR_WIDTH = 5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose text no language model accepts, or that hold no letter: null and empty texts too.

    Null ids stay, and equal texts go or stay alike. Without any language to learn, every document goes.
    """
    return language_id.accepted(docs, language_id.fit(language_id.training_texts(docs, F.lit(True))))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id.

    Near duplicates share 80 % of their five-word shingles; the query op9 keeps its contract's values. Texts
    without words stay, null ones too. A null id stays only where its group has no other; rows that share id and text are
    one document, whose row of the lowest hash stays.
    """
    return jaccard_join.representatives(docs, NEAR_LEAST, NEAR_WIDTH)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that windows of test items cover go; documents go that are mostly such words.

    Null and empty texts, null ids and repeated rows stay; an empty benchmark changes nothing.
    """
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets that look live are masked; widely copied examples stay, and so does every row."""
    return secrets.masked(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether they give it back; null and empty texts have none, every row stays."""
    both = sentence_pieces.round_trip(docs, SentencePieceModel.load(VOCABULARY))
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", clean_of_benchmark),
    ("secret scans", without_secrets),
    ("SentencePiece encoding and decoding", encoded),
]

#: Language models, joins to a fixed point and piece lattices are no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from ``documents`` to the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
