"""Sharding by jump consistent hashing: a stable key decides the shard, without a table of a ring.

With one more shard, a row either stays or goes to the new one, and only the needed share goes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import dropped, saved

LAW = "key"
BUCKET_ROWS = 65_536
COPIES = 10_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key (Lamping and Veach); at most ``shards`` steps, about ln(shards) on average."""
    keys = keys.astype(np.uint64)
    out, at = np.full(len(keys), -1, np.int64), np.arange(len(keys))
    place = np.zeros(len(keys), np.int64)
    while len(at):
        out[at] = place
        keys = keys * np.uint64(2862933555777941757) + np.uint64(1)
        place = np.floor((out[at] + 1) * (float(1 << 31) / ((keys >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        on = place < shards
        keys, place, at = keys[on], place[on], at[on]
    return out


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a bigint column; a null key counts as 0."""

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards).astype(np.int32))

    return shard(F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint")))


def assign(docs: DataFrame, shards: int) -> DataFrame:
    """Shard and slot of every row, under the law ``key``.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one row for each input row. Size is
    the UTF-8 bytes of the text plus 16, a null text has none and the checksum of an empty one. Within a
    shard, slots run from 0 without a gap, in the order of ids (null first), sizes and checksums, whatever
    the size of the table; repeated rows get slots of their own. A null id counts as key 0. ``grown_shard``
    is the shard with one more shard. Other columns are ignored.

    Equal digests are counted before the shuffle. Slots are numbered within ranges of that order that hold
    about ``BUCKET_ROWS`` digests at any input size, so no task sees a whole shard, and added up.
    """
    spark, order = docs.sparkSession, ["doc_id", "size", "text_crc32"]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    groups = saved(rows.groupBy(*order).agg(F.count(F.lit(1)).alias("copies")))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-groups.count() // BUCKET_ROWS))
    sharded = groups.withColumns({"shard": shard_of(F.col("doc_id"), shards), "grown_shard": shard_of(F.col("doc_id"), shards + 1)})
    placed = saved(sharded.repartitionByRange(parts, "shard", *order).withColumn("bucket", F.spark_partition_id()))
    dropped(groups)
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "bucket").agg(F.sum("copies").alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(offsets, ["shard", "bucket"])
    placed = placed.withColumn("first", F.col("offset") + F.col("inside"))
    # Copies come back in blocks, so no array is longer than a block.
    blocks = placed.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPIES).cast("bigint"))))
    last = F.least(F.col("copies") - 1, (F.col("block") + 1) * COPIES - 1)
    copies = blocks.withColumn("copy", F.explode(F.sequence(F.col("block") * COPIES, last)))
    return copies.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("first") + F.col("copy")).alias("slot"), "grown_shard")
