"""Connected components as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tessera.llm.common import dealt_anew, dropped, saved


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (bigint columns ``a, b``): the smallest node of its component.

    Rounds of large-star and small-star (Kiveris and others): every node points its larger neighbours, then
    all its neighbours, to the smallest one. Each round is a table of its own, which replaces the last one's;
    it ends when nothing changes. Components of any size stay spread over rows, and a hub's rows meet in
    joins that Spark can split. The result is a saved table.
    """
    at = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _state(at)
    while seen[0]:
        both = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = at.select(F.col("b").alias("u"), F.col("a").alias("v")).join(dealt_anew(least.withColumnRenamed("a", "u")), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pointed = saved(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
        state = _state(pointed)
        dropped(at)
        at, done, seen = pointed, state == seen, state
        if done:
            break
    labels = saved(at.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(at.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()))
    dropped(at)
    return labels


def _state(at: DataFrame) -> Row:
    return at.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a") % 1_000_033)).first()
