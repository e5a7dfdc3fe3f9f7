"""Pairs of 64-bit numbers, dealt by the first of each to buckets and packed into few rows.

A row for each pair would cost three times its bytes in every shuffle. Here a task sorts the pairs that it
has, and each bucket gets one row of them; bytes of the same place stand together, so they compress well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

PAIRS = 2_000_000


def bucket_count(spark: SparkSession) -> int:
    """Buckets follow the session's shuffle partitions, which are sized with the data."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of keys: sorted keys are sorted by bucket."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def packed(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unpacked(column: pa.ChunkedArray, kind: type = np.uint64) -> np.ndarray:
    """All numbers of a column of packed values, row after row."""
    width = np.dtype(kind).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(width, -1).T).view(kind).ravel() for b in column.to_pylist() if b]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def dealt(buckets: int, *groups: tuple[np.ndarray, ...]) -> list[list]:
    """Columns ``bucket`` and one for each array: each group's arrays are cut where the bucket of its first, sorted, changes."""
    cuts = [np.searchsorted(bucket_of(g[0], buckets), np.arange(buckets + 1)) for g in groups]
    some = np.flatnonzero(sum(np.diff(c) for c in cuts))
    columns: list[list] = [some.tolist()]
    for c, group in zip(cuts, groups):
        for values in group:
            columns.append([packed(values[c[b] : c[b + 1]]) for b in some])
    return columns


def runs(*sorted_arrays: np.ndarray) -> np.ndarray:
    """Where runs of equal rows of sorted arrays begin."""
    n = len(sorted_arrays[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n - 1, bool)
    for values in sorted_arrays:
        new |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1])
