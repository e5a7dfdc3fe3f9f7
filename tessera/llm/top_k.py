"""Exact top-k inner products by block-at-a-time pruning.

Rows are ordered into blocks of similar vectors. A block keeps the largest and smallest value of every
dimension (its terms' maxima) and its rows (its forward index). A query visits blocks from the highest
bound down and stops where the bound falls below its k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import saved

K = 10
BLOCK = 256
QUERIES = 32_768
SEEDS = 4_096
CENTRES = 64
SCHEMA = "query_id bigint, vec_id bigint, score bigint"
_EXACT = 2.0**52


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of rows whose id and components are all there and finite."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)


def quantised(rows: pa.ListArray, width: int) -> np.ndarray:
    """floor(1024 x) of every component; shorter vectors are filled up with zeros."""
    flat, offsets = rows.values.to_numpy(zero_copy_only=False), rows.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(rows), width))
    owner = np.repeat(np.arange(len(rows)), sizes)
    place = np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], sizes)
    out[owner, place] = np.floor(1024.0 * flat[offsets[0] : offsets[-1]])
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where every sum is exact there, else in whole numbers."""
    top = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in a], object).reshape(a.shape) @ np.array([[int(x) for x in r] for r in b], object).reshape(b.shape).T
    return np.clip(whole, _NONE + 1, 2**63 - 1).astype(np.int64)


def _merge(score: np.ndarray, ids: np.ndarray, new: np.ndarray, new_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k best of two sets of columns for each row; ties to the smaller id."""
    k = score.shape[1]
    score, ids = np.concatenate([score, new], axis=1), np.concatenate([ids, new_ids], axis=1)
    order = np.lexsort((ids, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


_NONE, _LAST = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max


class Search:
    """k best rows so far of each query of one batch."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray):
        self.ids, self.queries, self.k = ids, queries, k
        self.least = least  # what the k-th best row of each query scores at least
        self.score = np.full((len(ids), k), _NONE)
        self.found = np.full((len(ids), k), _LAST)

    def add(self, ids: np.ndarray, rows: np.ndarray, centres: np.ndarray) -> None:
        """Search one range of rows, in blocks of rows near the same centre."""
        order = np.argsort((rows @ centres.T - 0.5 * np.square(centres).sum(1)).argmax(1), kind="stable")
        blocks = [order[i : i + BLOCK] for i in range(0, len(order), BLOCK)]
        high, low = np.array([rows[b].max(0) for b in blocks]), np.array([rows[b].min(0) for b in blocks])
        # A bound of rounded doubles is lifted by more than its rounding error.
        bound = np.maximum(self.queries, 0) @ high.T + np.minimum(self.queries, 0) @ low.T
        bound += 1 + np.abs(bound) * 1e-9 if np.abs(bound).max(initial=0) >= _EXACT else 0
        bound = np.maximum(bound, float(_NONE))  # as low scores are clipped
        by_bound = np.argsort(-bound, axis=1)
        for step in range(len(blocks)):
            block = by_bound[:, step]
            going = np.flatnonzero(bound[np.arange(len(block)), block] >= np.maximum(self.least, self.score[:, -1]).astype(float))
            if not len(going):
                break
            for b in np.unique(block[going]):
                queries = going[block[going] == b]
                score = products(self.queries[queries], rows[blocks[b]])
                names = np.broadcast_to(ids[blocks[b]], score.shape)
                out = (names == self.ids[queries, None]) | (score < self.least[queries, None])
                self.score[queries], self.found[queries] = _merge(self.score[queries], self.found[queries], np.where(out, _NONE, score), np.where(out, _LAST, names))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        some = self.found != _LAST
        return np.broadcast_to(self.ids[:, None], some.shape)[some], self.found[some], self.score[some]


def _centres(rows: np.ndarray) -> np.ndarray:
    """A few rounds of k-means over the seeds; only the order of rows depends on it."""
    if not len(rows):
        return np.zeros((1, rows.shape[1]))
    centres = rows[:: max(1, len(rows) // CENTRES)][:CENTRES].copy()
    for _ in range(4):
        near = (rows @ centres.T - 0.5 * np.square(centres).sum(1)).argmax(1)
        for c in np.unique(near):
            centres[c] = rows[near == c].mean(0)
    return centres


def top_k(vectors: DataFrame, is_query: Column, k: int = K, batch: int = QUERIES) -> DataFrame:
    """The ``k`` rows of highest integer inner product for each query row, every other row taken into account.

    Returns ``query_id, rank, vec_id, score``; ties go to the smaller ``vec_id``, queries with fewer other
    rows get all of them. Rows whose id or vector is null, or whose vector holds a null or non-finite
    component, take no part. Vectors of different length are compared over the shorter one's dimensions.
    Rows with the query's own id never count; repeated rows count each, and a repeated query is one query
    (different vectors under one query id: the smallest). Scores beyond 64 bits are clipped to -(2^63 - 2) and 2^63 - 1. Other columns are
    ignored.

    Queries come in batches of bounded size, each broadcast to all rows, whose best rows are written before
    the next one comes: driver and executors hold one batch at any number of queries. A bounded sample of
    rows gives each query a k-th score to start from, which only prunes.
    """
    rows = usable(vectors)
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    batches = max(1, -(-queries.count() // batch))
    seeds = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEEDS).toArrow()
    seed_ids, seed_rows = seeds["vec_id"].to_numpy(), quantised(seeds["embedding"].combine_chunks(), width) if len(seeds) else np.zeros((0, width))
    centres = _centres(seed_rows)
    written = []
    for b in range(batches):
        part = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(batches)) == b).toArrow()
        ids, wanted = part["vec_id"].to_numpy(), quantised(part["embedding"].combine_chunks(), width) if len(part) else np.zeros((0, width))
        start = Search(ids, wanted, k, np.full(len(ids), _NONE))
        if len(seed_rows) and len(ids):
            start.add(seed_ids, seed_rows, centres)
        shared = vectors.sparkSession.sparkContext.broadcast((ids, wanted, start.score[:, -1], centres))  # one batch

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, wanted, least, centres = shared.value
            search = Search(ids, wanted, k, least)
            for rows in batches:
                if rows.num_rows and len(ids):
                    search.add(rows.column("vec_id").to_numpy(), quantised(rows.column("embedding"), wanted.shape[1]), centres)
            columns = search.rows()
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

        found = _ranked(rows.mapInArrow(run, SCHEMA), k)
        if batches == 1:
            return found
        written.append(saved(found).saved_at)
        shared.destroy()
    return vectors.sparkSession.read.schema(found.schema).parquet(*written)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query's rows, with their ranks."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
