"""Choice and use of a decision threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.config import Settings
from tessera.operators.evaluation import f05
from tessera.operators.labels import labelled

METRICS = ("f05", "f1", "precision", "recall")


def grid(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    """Thresholds: equal steps from the first one, in doubles (the last of 81 from 0.1 by 0.01 is 0.8999999999999996)."""
    first = settings.threshold_first
    step = (first + settings.threshold_step) - first
    return spark.range(settings.threshold_points).select(F.col("id").cast("int").alias("step"), (F.lit(first) + F.col("id") * F.lit(step)).alias("threshold"))


def curve(scores: DataFrame, truth: DataFrame, entities: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``threshold, precision, recall, f05, f1`` for each grid point, in one pass over the scores.

    Going down the grid, an entity's values change only at the steps that some of its pairs just reach. So
    each entity gives its value without any pair, and one change for each such step; changes are summed by
    step and added up over the grid's few rows. No pair and no entity is repeated for every step.
    """
    points = grid(scores.sparkSession, settings)
    known = truth.select("s1_id", "cand_id").distinct()
    real = entities.select("s1_id").distinct().join(known.groupBy("s1_id").agg(F.count(F.lit(1)).alias("rp")), "s1_id", "left").fillna(0, ["rp"])
    first = settings.threshold_first
    step = (first + settings.threshold_step) - first
    # The place on the grid by division, put right by one where rounding moved it; the score is computed once.
    value = lambda i: F.lit(first) + i * F.lit(step)
    placed = scores.select("s1_id", "cand_id", "proba", F.floor((F.col("proba") - first) / step).alias("at"))
    reached = F.when(value(F.col("at") + 1) <= F.col("proba"), F.col("at") + 1).when(value(F.col("at")) > F.col("proba"), F.col("at") - 1).otherwise(F.col("at"))
    reached = F.least(reached, F.lit(settings.threshold_points - 1)).cast("int")
    pairs = labelled(placed.select("s1_id", "cand_id", reached.alias("step")).where("step >= 0"), known)
    steps = pairs.groupBy("s1_id", "step").agg(F.count(F.lit(1)).alias("pp"), F.sum("label").alias("tp")).join(real, "s1_id")
    down = Window.partitionBy("s1_id").orderBy(F.desc("step"))
    held = steps.select("s1_id", "step", "rp", F.sum("pp").over(down).alias("pp"), F.sum("tp").over(down).alias("tp"), F.lead("step", 1, -1).over(down).alias("below"))
    none = F.when(F.col("rp") == 0, 1.0).otherwise(0.0)
    now = {"precision": F.col("tp") / F.col("pp"), "recall": F.when(F.col("rp") == 0, 0.0).otherwise(F.col("tp") / F.col("rp")), "f05": f05(F.col("tp"), F.col("pp"), F.col("rp"))}
    gains = [(v - none).alias(c) for c, v in now.items()]
    change = held.select("step", "below", *gains)
    ends = F.explode(F.array(*(F.struct(F.col(at).alias("step"), *((F.col(c) * sign).alias(c) for c in now)) for at, sign in (("step", 1), ("below", -1)))))
    sums = change.select(ends.alias("e")).select("e.*").where("step >= 0").groupBy("step").agg(*(F.sum(c).alias(c) for c in now))
    base = real.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("rp") == 0, 1)).alias("none"))
    whole = Window.orderBy(F.desc("step"))  # the grid's rows only
    table = points.join(sums, "step", "left").crossJoin(F.broadcast(base))
    mean = lambda c: F.when(F.col("n") == 0, F.lit(0.0)).otherwise((F.col("none") + F.sum(F.coalesce(c, F.lit(0.0))).over(whole)) / F.col("n"))
    table = table.select("threshold", *(mean(c).alias(c) for c in now))
    both = F.col("precision") + F.col("recall")
    return table.withColumn("f1", F.when(both == 0, F.lit(0.0)).otherwise(2 * F.col("precision") * F.col("recall") / both))


def best(curve_: DataFrame, metric: str = "f05") -> DataFrame:
    """The row of the highest value; ties of nine digits go to the smallest threshold."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {', '.join(METRICS)}")
    return curve_.orderBy(F.desc(F.round(metric, 9)), "threshold").limit(1)


def decided(scores: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose probability reaches the threshold."""
    return scores.where(F.col("proba") >= threshold)
