"""Features of candidate pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.similarity import FEATURES, all_similarities

_KEPT = ("norm_name", "norm_address", "country")


def one_record_each(records: DataFrame) -> DataFrame:
    """One record for each id: the last source's, then the largest texts."""
    order = Window.partitionBy("entity_id").orderBy(F.desc("source"), *(F.desc(c) for c in _KEPT))
    return records.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def lookup(records: DataFrame, prefix: str, key: str) -> DataFrame:
    return records.select(F.col("entity_id").alias(key), *(F.col(c).alias(f"{prefix}_{c}") for c in _KEPT), F.lit(True).alias(f"{prefix}_there"))


def feature_table(pairs: DataFrame, s1: DataFrame, s23: DataFrame, use_country: bool = True, unique: bool = True) -> DataFrame:
    """``s1_id, cand_id``, twenty float features and ``missing``: a pair without both records stays, with zeros.

    ``unique`` says that ids are; without it one record of each id is taken. Pairs may bring the ``lookup`` of their S1 record.
    """
    if not unique:
        s1, s23 = one_record_each(s1), one_record_each(s23)
    rows = pairs if "a_there" in pairs.columns else pairs.select("s1_id", "cand_id").join(lookup(s1, "a", "s1_id"), "s1_id", "left")
    rows = rows.join(lookup(s23, "b", "cand_id"), "cand_id", "left")
    empty = rows.fillna("", [f"{p}_{c}" for p in "ab" for c in _KEPT])
    columns = all_similarities(*(F.col(f"{p}_{c}") for c in _KEPT for p in "ab"), use_country)
    there = F.col("a_there").isNotNull() & F.col("b_there").isNotNull()
    values = empty.select("s1_id", "cand_id", there.alias("there"), *(columns[f].alias(f) for f in FEATURES))
    return values.select("s1_id", "cand_id", *(F.when(F.col("there"), F.col(f)).otherwise(0.0).cast("float").alias(f) for f in FEATURES), (~F.col("there")).alias("missing"))


def missing_counts(pairs: DataFrame, s1: DataFrame, s23: DataFrame) -> DataFrame:
    """How many pairs lack their S1 record, and how many the other one."""
    a = s1.select(F.col("entity_id").alias("s1_id"), F.lit(1).alias("a")).distinct()
    b = s23.select(F.col("entity_id").alias("cand_id"), F.lit(1).alias("b")).distinct()
    rows = pairs.join(a, "s1_id", "left").join(b, "cand_id", "left")
    return rows.agg(F.count(F.when(F.col("a").isNull(), 1)).alias("missing_s1"), F.count(F.when(F.col("b").isNull(), 1)).alias("missing_candidates"))
