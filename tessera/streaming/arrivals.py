"""Arriving S2 and S3 records against a fixed S1 and vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.config import Settings
from tessera.functions.text import with_normalized
from tessera.operators import blocking, tfidf


def link_arrivals(arrivals: DataFrame, s1: DataFrame, vocabulary: DataFrame, path: str, checkpoint: str, settings: Settings = Settings()) -> StreamingQuery:
    """Score each micro-batch of records against S1 with frozen idf, and append its pairs to ``path``.

    Pairs are each query's best of the batch; ``blocking.top_by_field`` over all batches gives the same as one
    run over all records. A batch that is tried again overwrites its own folder.
    """
    fixed = with_normalized(s1)

    def link(batch: DataFrame, number: int) -> None:
        rows = fixed.unionByName(with_normalized(batch).select(*fixed.columns))
        vectors = tfidf.vectors(tfidf.weights(tfidf.grams(rows, settings.gram_sizes), vocabulary))
        pairs = blocking.top_by_field(blocking.scored(vectors, settings.top_k, settings.min_score), settings.top_k)
        pairs.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return arrivals.writeStream.foreachBatch(link).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
