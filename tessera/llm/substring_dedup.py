"""Substring deduplication against indexed blocks of reference passages.

The method dealt, a greedy relative Lempel-Ziv parse, needs the reference block that a stretch is parsed
against in one task; the block of a passage that a third of all documents hold would be most of the corpus.
Blocks are kept, but as rows of joins that Spark can split, and hashes are compared instead of a parse.

A window of ``WINDOW`` words is addressed by the least hashed ``GRAM``-word run inside it, its anchor. All
windows of a document that follow each other and share an anchor form a piece, which is the unit that a
reference block holds: the block of an anchor indexes the different pieces of all documents around it.
Equal windows have equal anchors, so a document's match can only lie in the blocks of its own anchors, and
every such block is looked at.

A piece that the block holds from an earlier document is one whole factor. Where a piece differs from the
block's others (the ends of a copied passage: factor boundaries), each of its windows is checked against the
windows of the other pieces. Factors become duplicate spans, and touching ones join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BASE, GOLDEN, hash_words, in_arrow, mix, rolled, saved, utf8

WINDOW = 50
GRAM = 12
STARTS = 200_000
_INVERSE = pow(BASE, -1, 1 << 64)
_LAST = 2**63 - 1


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def windows(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """64-bit hash of the window at each start."""
    return mix(rolled(hashes, window))


def pieces(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of starts, anchor and hash of each piece of a document's word hashes."""
    n = len(hashes) - window + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    least = mix(rolled(hashes, gram))
    width, span = 1, window - gram + 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: n], least[span - width : span - width + n])
    first = np.concatenate([[0], np.flatnonzero(least[1:n] != least[: n - 1]) + 1])
    size = np.diff(np.append(first, n))
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(len(hashes), BASE), out=total[1:])
    end = first + size + window - 1
    whole = (total[end] - total[first]) * _powers(len(hashes), _INVERSE)[first] + size.astype(np.uint64) * np.uint64(GOLDEN)
    return first, size, least[first], mix(whole)


def _ranges(n: int) -> Iterator[tuple[int, int]]:
    """Word ranges of a text, so that a giant one takes bounded memory; they overlap by all but one word of a window."""
    for begin in range(0, max(1, n - WINDOW + 1), STARTS):
        yield begin, min(n, begin + STARTS + WINDOW - 1)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _parsed(docs: DataFrame) -> DataFrame:
    """Pieces of every document, and one row for each document itself (``first`` is null there)."""
    schema = "doc_id bigint, row bigint, first int, size int, anchor bigint, piece bigint, digest string"
    names = ["doc_id", "row", "first", "size", "anchor", "piece", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("doc_id"), batch.column("row")
            at, columns, held = [], [[], [], [], []], 0
            sizes, digests = [], []

            def flush():
                take = pa.array(np.repeat(np.array([a for a, _ in at], np.int64), [n for _, n in at]))
                first, size, anchor, piece = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns)
                return pa.RecordBatch.from_arrays([ids.take(take), rows.take(take), pa.array(first, pa.int32()), pa.array(size, pa.int32()), pa.array(anchor.view(np.int64)), pa.array(piece.view(np.int64)), pa.nulls(len(take), pa.string())], names=names)

            for i, text in enumerate(utf8(batch, "text")):
                words = text.split() if text else []
                sizes.append(len(words))
                digests.append(_digest(words))
                for begin, end in _ranges(len(words)):
                    found = pieces(hash_words(words[begin:end]))
                    if len(found[0]):
                        at.append((i, len(found[0])))
                        for column, values in zip(columns, (found[0] + begin, *found[1:])):
                            column.append(values)
                        held += len(found[0])
                if held > 200_000:
                    yield flush()
                    at, columns, held = [], [[], [], [], []], 0
            if held:
                yield flush()
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([ids, rows, pa.nulls(n, pa.int32()), pa.array(sizes, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(digests, pa.string())], names=names)

    return in_arrow(docs, run, schema)


def _checked(docs: DataFrame) -> DataFrame:
    """Window hashes of the pieces listed in ``ranges``, whether each is to be looked up, and where it starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("doc_id"), batch.column("row")
            for i, (text, ranges) in enumerate(zip(utf8(batch, "text"), batch.column("ranges").to_pylist())):
                words = text.split()
                starts, hashes, asked = [], [], []
                for r in ranges:
                    first, size = r["first"], r["size"]
                    starts.append(np.arange(first, first + size))
                    hashes.append(windows(hash_words(words[first : first + size + WINDOW - 1])))
                    asked.append(np.full(size, r["asked"]))
                take = pa.array(np.full(sum(map(len, starts)), i))
                yield pa.RecordBatch.from_arrays([ids.take(take), rows.take(take), pa.array(np.concatenate(starts), pa.int32()), pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(asked))], names=["doc_id", "row", "first", "window", "asked"])

    return in_arrow(docs, run, "doc_id bigint, row bigint, first int, window bigint, asked boolean")


def _kept(docs: DataFrame, with_text: bool) -> DataFrame:
    schema = "doc_id bigint, row bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans array<struct<start:int,stop:int>>, kept string"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(utf8(batch, "text"), batch.column("ranges").to_pylist()):
                words, spans, kept, last = text.split(), [], [], 0
                for a, b in sorted((r["first"], r["first"] + r["size"] + WINDOW - 1) for r in ranges):
                    if spans and a <= spans[-1]["stop"]:
                        spans[-1]["stop"] = max(spans[-1]["stop"], b)
                    else:
                        spans.append({"start": a, "stop": b})
                for s in spans:
                    kept += words[last : s["start"]]
                    last = s["stop"]
                kept += words[last:]
                out.append((len(words), len(words) - len(kept), _digest(kept), spans, b" ".join(kept) if with_text else None))
            a, b, c, d, e = zip(*out)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string()), pa.array(d, kind), pa.array(e, pa.binary()).cast(pa.string())], names=[x.split()[0] for x in schema.split(", ")])

    return in_arrow(docs, run, schema)


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["row"] == b["row"])


def parse(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Duplicate spans of every document and what is left of it.

    Returns ``doc_id, row, n_words, n_removed, kept_sha256, spans, kept``, one row for each input row: words
    are runs without ASCII white space, ``spans`` are of words, end exclusive, ``kept`` is the text left
    (only ``with_text``, and null where nothing was removed). A word goes if a window over it also starts in
    a document with a smaller id; windows are those of the input. Null and empty texts have no words. A null
    id counts as larger than all others. Rows that share an id take nothing from each other; equal rows have
    equal results. Texts of any length are taken whole, in ranges of bounded size; an empty table gives none.
    Other columns are ignored, whatever their names.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    parsed = saved(_parsed(texts))
    owner = F.coalesce("doc_id", F.lit(_LAST))
    found = parsed.where("first is not null").select("doc_id", "row", "first", "size", "anchor", "piece", owner.alias("owner"))
    block = found.groupBy("anchor", "piece").agg(F.min("owner").alias("earliest"), F.max("owner").alias("latest"))
    shared = block.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("earliest").alias("low"), F.max("latest").alias("high")).where("low < high")
    # Tables of their own: the joins below then deal both sides by their own keys, and Spark can split frequent ones.
    index = saved(block.join(shared, "anchor").where("earliest < latest or n > 1").select("anchor", "piece", "earliest", "low", "n"))
    looked = saved(found.join(index, ["anchor", "piece"]).where("owner > earliest or n > 1").select("doc_id", "row", "first", "size", (F.col("owner") > F.col("earliest")).alias("whole"), (F.col("owner") > F.col("low")).alias("asked")))
    # Factor boundaries: one copy of each different piece of a block gives its windows.
    edges = looked.where("not whole").groupBy("doc_id", "row").agg(F.collect_set(F.struct("first", "size", "asked")).alias("ranges"))
    checked = saved(_checked(texts.join(edges, _same(texts, edges)).select(texts["doc_id"], texts["row"], "text", "ranges")).withColumn("owner", owner))
    first_of = saved(checked.groupBy("window").agg(F.min("owner").alias("earliest"), F.max("owner").alias("latest")).where("earliest < latest"))
    crossing = checked.where("asked").join(first_of, "window").where("owner > earliest").select("doc_id", "row", "first", F.lit(1).alias("size"))
    factors = looked.where("whole").select("doc_id", "row", "first", "size").unionByName(crossing)
    removed = saved(factors.groupBy("doc_id", "row").agg(F.collect_set(F.struct("first", "size")).alias("ranges")))
    cut = _kept(texts.join(removed, _same(texts, removed)).select(texts["doc_id"], texts["row"], "text", "ranges"), with_text)
    left = parsed.where("first is null").select("doc_id", "row", F.col("size").cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_removed"), F.col("digest").alias("kept_sha256"))
    gone = removed.select(F.col("doc_id"), F.col("row"))
    left = left.join(gone, _same(left, gone), "left_anti")
    return left.withColumns({"spans": F.array().cast("array<struct<start:int,stop:int>>"), "kept": F.lit(None).cast("string")}).unionByName(cut)
