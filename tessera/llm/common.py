"""What several operators of this package share: row keys, batches, hashes and checkpoints."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.shared import dropped, saved, shared_folder  # noqa: F401

GOLDEN = 0x9E3779B97F4A7C15
BASE = 0xD6E8FEB86659FD93
BATCH_ROWS = 2_000
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; Spark opens the path, so any store that Spark reads will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt_anew(df: DataFrame) -> DataFrame:
    """``df`` over evenly dealt partitions.

    A join with an aggregate by the same key would keep the aggregate's partitions, and Spark then cannot split
    a key with many rows on the other side. This is for small aggregates in such joins.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def small(keys: DataFrame, weight: Column | None = None) -> DataFrame:
    """``keys`` as a table, marked for a broadcast join if its rows are few by count; else joins shuffle as usual.

    The rows are ids and numbers of fixed size, so ``BROADCAST_ROWS`` of them take some 20 MB. ``weight`` says how
    many such rows a row with an array stands for.
    """
    held = saved(keys)
    n = held.agg(F.coalesce(F.sum(F.lit(1) if weight is None else weight), F.lit(0))).first()[0]
    return F.broadcast(held) if n <= BROADCAST_ROWS else held


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id's decimal text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(modulus)


def trim() -> None:
    """Give freed memory back to the system: workers live on between tasks, and the driver after a fit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` with batches that suit whole texts: both sides hold several of them for each task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= BATCH_ROWS:
        df.sparkSession.conf.set(name, str(BATCH_ROWS))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return df.mapInArrow(task, schema)


def in_batches(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int = 1_000) -> DataFrame:
    """Apply ``step`` to the rows of ``df``, ``rows`` at a time; Spark itself ends an Arrow batch at 64 MB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, rows):
                if (out := step(batch.slice(begin, rows))) is not None and out.num_rows:
                    yield out

    return in_arrow(df, run, schema)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 byte strings."""
    return batch.column(name).cast(pa.binary()).to_pylist()


class Remembered(dict):
    """Values made from texts, kept while they are met: when full, what was met before the last time goes.

    Keys of over ``longest`` characters are made anew each time.
    """

    def __init__(self, make: Callable, most: int = 150_000, longest: int = 64):
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        if (value := self.old.get(key)) is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def _word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


_slots: dict[str, tuple[object, object]] = {}


def held(kind: str, key: object, make: Callable, beside: tuple[str, ...] = ()):
    """What a Python worker keeps from task to task under ``kind``, made anew when ``key`` changes.

    All kinds but this one and ``beside`` go, so a worker that serves several operators in turn holds one's.
    """
    slot = _slots.get(kind)
    if slot is None or slot[0] != key:
        for other in [k for k in _slots if k not in beside]:
            del _slots[other]
        slot = _slots[kind] = key, make()
    elif len(_slots) > 1:
        for other in [k for k in _slots if k != kind and k not in beside]:
            del _slots[other]
    return slot[1]


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, the same in every process."""
    known = held("words", None, lambda: Remembered(_word_hash), ("quality",))
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(codes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of all ``n`` consecutive codes (uint64, wrapping), not yet mixed.

    Built by doubling: a window of 2k codes is two windows of k.
    """
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    out, done, have, power = None, 0, codes.astype(np.uint64), BASE
    width = 1
    while True:
        if n & width:
            if out is None:
                out, done = have, width
            else:
                shift = np.uint64(pow(BASE, done, 1 << 64))
                size = len(codes) - done - width + 1
                out, done = out[:size] + shift * have[done : done + size], done + width
        if done == n:
            return out[: len(codes) - n + 1]
        size = len(have) - width
        have = have[:size] + np.uint64(power) * have[width : width + size]
        width *= 2
        power = power * power % (1 << 64)


def word_ngrams(words: list[str], lengths: range) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each n: (n, mixed 64-bit hashes of the n-grams of each padded word, index of the word).

    A word ``w`` is padded to STX w ETX; n-grams never cross words.
    """
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    for n in lengths:
        hashes = rolled(codes, n)
        within = owner[: len(hashes)] == owner[n - 1 :]
        yield n, mix(hashes[within] + np.uint64(n * GOLDEN % (1 << 64))), owner[: len(hashes)][within]
