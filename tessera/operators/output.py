"""Result lists and the checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.delimited import to_lists


def clean(pairs: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """Pairs with ids of the other sources only, and with ``valid`` only known ones."""
    kept = pairs.where(F.col("cand_id").rlike("^S[23]-"))
    return kept if valid is None else kept.join(valid.select(F.col("entity_id").alias("cand_id")).distinct(), "cand_id", "left_semi")


def result(pairs: DataFrame, s1: DataFrame, name: str, valid: DataFrame | None = None) -> DataFrame:
    """One row for each S1 id with its cleaned, sorted, comma-joined ids."""
    return to_lists(clean(pairs, valid), s1, name=name)


def matching_results(predicted: DataFrame, s1: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    return result(predicted, s1, "matched_entity_ids", valid)


def candidate_pairs(pairs: DataFrame, s1: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    return result(pairs, s1, "candidate_entity_ids", valid)


def violations(predicted: DataFrame, pairs: DataFrame, on: tuple[str, ...] = ("s1_id", "cand_id")) -> DataFrame:
    """Predicted pairs that are no candidates, which may go by other columns of both than the ids (``on``)."""
    return predicted.join(pairs, list(on), "left_anti").select("s1_id", "cand_id")


def uncovered(s1: DataFrame, pairs: DataFrame) -> DataFrame:
    """S1 ids without any candidate row."""
    return s1.select("s1_id").join(pairs, "s1_id", "left_anti")


def match_rate(results: DataFrame) -> DataFrame:
    """Matched entities, singletons, and the share of matched ones in percent."""
    matched = F.count(F.when(F.col("matched_entity_ids") != "", 1))
    n = F.count(F.lit(1))
    return results.agg(n.alias("entities"), matched.alias("matched"), (n - matched).alias("singletons"), F.round(100.0 * matched / F.greatest(n, F.lit(1)), 2).alias("match_rate"))
