"""Quality of predicted pairs: each entity, macro and micro."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def f05(tp: Column, predicted: Column, real: Column) -> Column:
    """F0.5 from counts: 1.25 tp / (predicted + 0.25 real), 0 without a true positive."""
    return F.when(tp == 0, F.lit(0.0)).otherwise(1.25 * tp / (predicted + 0.25 * real))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def entity_counts(entities: DataFrame, truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """``s1_id, tp, pp, rp`` of every truth entity; predictions for others are ignored."""
    # Each entity's ids as a set, so that pairs are dealt by entity only; structs keep null ids.
    ids = lambda pairs, name: pairs.groupBy("s1_id").agg(F.collect_set(F.struct("cand_id")).alias(name))
    sets = entities.select("s1_id").distinct().join(ids(truth, "r"), "s1_id", "left").join(ids(predicted, "p"), "s1_id", "left")
    n = lambda found: F.when(found.isNull(), 0).otherwise(F.size(found)).cast("bigint")
    return sets.select("s1_id", n(F.array_intersect("p", "r")).alias("tp"), n(F.col("p")).alias("pp"), n(F.col("r")).alias("rp"))


def entity_metrics(counts: DataFrame) -> DataFrame:
    """Adds precision, recall and F0.5; nothing true and nothing said counts as 1 for F0.5 and 0 for the others."""
    tp, pp, rp = F.col("tp"), F.col("pp"), F.col("rp")
    return counts.withColumns({"precision": _share(tp, pp), "recall": _share(tp, rp), "f05": F.when((pp == 0) & (rp == 0), F.lit(1.0)).otherwise(f05(tp, pp, rp))})


def macro_f05(counts: DataFrame) -> DataFrame:
    return entity_metrics(counts).agg(F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"))


def report(counts: DataFrame) -> DataFrame:
    """One row: macro and micro precision, recall and F0.5, entities, and accuracy on those without a match."""
    each = entity_metrics(counts)
    single = F.col("rp") == 0
    sums = each.agg(
        *(F.coalesce(F.avg(c), F.lit(0.0)).alias(f"macro_{c}") for c in ("precision", "recall", "f05")),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "pp", "rp")),
        F.count(F.lit(1)).alias("entities"),
        F.count(F.when(single, 1)).alias("singletons"),
        F.count(F.when(~single, 1)).alias("matched"),
        F.count(F.when(single & (F.col("pp") == 0), 1)).alias("right"),
    )
    micro = {"micro_precision": _share(F.col("tp"), F.col("pp")), "micro_recall": _share(F.col("tp"), F.col("rp")), "micro_f05": f05(F.col("tp"), F.col("pp"), F.col("rp"))}
    accuracy = _share(F.col("right"), F.col("singletons"))
    rounded = {c: F.col(c) for c in ("macro_precision", "macro_recall", "macro_f05")} | micro | {"singleton_accuracy": accuracy}
    return sums.select(*(F.round(v, 6).alias(c) for c, v in rounded.items()), "entities", "singletons", "matched", "tp", "pp", "rp")


def f05_distribution(counts: DataFrame) -> DataFrame:
    """Mean, median, least and greatest F0.5 of the entities."""
    return entity_metrics(counts).agg(F.avg("f05").alias("mean"), F.median("f05").alias("median"), F.min("f05").alias("least"), F.max("f05").alias("greatest"))


def tuning_metrics(counts: DataFrame) -> DataFrame:
    """Macro precision, recall, their F1 and F0.5 as tuning has them: nothing true and nothing said counts as 1 throughout."""
    tp, pp, rp = F.col("tp"), F.col("pp"), F.col("rp")
    right = (pp == 0) & (rp == 0)
    keys = [c for c in counts.columns if c == "threshold"]
    means = counts.groupBy(*keys).agg(
        F.coalesce(F.avg(F.when(right, 1.0).otherwise(_share(tp, pp))), F.lit(0.0)).alias("precision"),
        F.coalesce(F.avg(F.when(right, 1.0).otherwise(_share(tp, rp))), F.lit(0.0)).alias("recall"),
        F.coalesce(F.avg(F.when(right, 1.0).otherwise(f05(tp, pp, rp))), F.lit(0.0)).alias("f05"),
    )
    both = F.col("precision") + F.col("recall")
    return means.withColumn("f1", F.when(both == 0, F.lit(0.0)).otherwise(2 * F.col("precision") * F.col("recall") / both))


def print_report(counts: DataFrame) -> None:
    """The report and the distribution of F0.5, one line for each figure."""
    for frame in (report(counts), f05_distribution(counts)):
        for name, value in frame.first().asDict().items():
            print(f"{name:>20} {value:.6f}" if isinstance(value, float) else f"{name:>20} {value}")
