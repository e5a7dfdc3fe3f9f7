"""TF-IDF of character n-grams as tables: postings, vocabulary and weights."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ngrams import char_ngrams
from tessera.functions.text import SPACE, country_key

FIELDS = {"name": "norm_name", "address": "norm_address"}


def each_text(fields: dict[str, str] = FIELDS) -> Column:
    """``of``: a row for each field of a record, as a struct of ``field`` and ``text``."""
    return F.explode(F.array(*(F.struct(F.lit(field).alias("field"), F.col(column).alias("text")) for field, column in fields.items()))).alias("of")


def grams(records: DataFrame, sizes: tuple[int, ...] = (2, 3), fields: dict[str, str] = FIELDS) -> DataFrame:
    """``entity_id, source, country, field, gram, tf`` of every normalised record and field."""
    rows = records.select("entity_id", "source", country_key(F.col("country")).alias("country"), each_text(fields))
    each = rows.select("entity_id", "source", "country", F.col("of.field").alias("field"), F.explode(char_ngrams(F.col("of.text"), sizes)).alias("gram"))
    return each.groupBy("entity_id", "source", "country", "field", "gram").agg(F.count(F.lit(1)).alias("tf"))


def fit(records: DataFrame, tf: DataFrame | None = None, sizes: tuple[int, ...] = (2, 3), cap: int = 300_000) -> DataFrame:
    """Vocabulary ``field, gram, df, total, idf`` over all records, each field apart; the ``cap`` most frequent grams stay.

    idf = ln((1 + N) / (1 + df)) + 1, with N the number of records, those with empty texts too. Rows of ``tf``
    count ``n`` times, where they have it.
    """
    n = records.agg(F.count(F.lit(1)).alias("n"))
    tf = grams(records, sizes) if tf is None else tf
    times = F.col("n") if "n" in tf.columns else F.lit(1)
    counts = tf.groupBy("field", "gram").agg(F.sum(times).alias("df"), F.sum(F.col("tf") * times).alias("total"))
    return _vocabulary(counts, n, cap)


def _vocabulary(counts: DataFrame, n: DataFrame, cap: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("total"), "gram"))
    kept = counts.withColumn("rank", rank).where(F.col("rank") <= cap).drop("rank")
    return kept.crossJoin(F.broadcast(n)).select("field", "gram", "df", "total", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def weights(tf: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Postings ``entity_id, source, country, field, gram, w``: sublinear tf times idf, each record's vector of length 1.

    Normalised texts have 37 symbols, so there are at most 54,871 grams a field (and never more than the
    vocabulary's cap): it is broadcast, and no frequent gram is a key of a shuffle.
    """
    raw = tf.join(F.broadcast(vocabulary.select("field", "gram", "idf")), ["field", "gram"]).withColumn("raw", (1 + F.log("tf")) * F.col("idf"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("entity_id", "source", "field")))
    return raw.select("entity_id", "source", "country", "field", "gram", (F.col("raw") / length).alias("w"))


def combined(postings: DataFrame, name_weight: float = 0.6, address_weight: float = 0.4) -> DataFrame:
    """One vector for each record from both fields, weighted and of length 1 again; grams of the fields stay apart."""
    weight = F.when(F.col("field") == "name", name_weight).otherwise(address_weight)
    scaled = postings.withColumn("w", F.col("w") * weight).withColumn("gram", F.concat_ws("\t", "field", "gram")).withColumn("field", F.lit("both"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("entity_id", "source")))
    return scaled.withColumn("w", F.col("w") / length)


def vectors(postings: DataFrame) -> DataFrame:
    """One row for each record and field: hashed grams and weights as arrays, by gram."""
    pairs = F.array_sort(F.collect_list(F.struct(F.xxhash64("gram").alias("g"), "w")))
    rows = postings.groupBy("entity_id", "source", "country", "field").agg(pairs.alias("p"))
    return rows.select("entity_id", "source", "country", "field", F.col("p.g").alias("grams"), F.col("p.w").alias("weights"))


def coded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the text, code and number of each different gram of ``char_ngrams``, by place and code.

    A gram's code holds its characters, 21 bits each, so codes have the order of grams.
    """
    spaced = [f" {' '.join(filter(None, re.split(SPACE, t, flags=re.ASCII)))} " if t else "" for t in texts]
    at = np.repeat(np.arange(len(spaced)), [len(t) for t in spaced])
    c = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    # Two spaces meet only between texts; a gram of three with a space in its middle would span two tokens.
    two, three = (c[:-1] != 32) | (c[1:] != 32), c[1:-1] != 32
    place = np.concatenate((at[:-1][two], at[: len(three)][three]))
    code = np.concatenate(((c[:-1] << 42 | c[1:] << 21)[two], (c[:-2] << 42 | c[1:-1] << 21 | c[2:] + 1)[three]))
    order = np.lexsort((code, place))
    place, code = place[order], code[order]
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (code[1:] != code[:-1])))) if len(code) else np.arange(0)
    return place[first], code[first], np.diff(np.append(first, len(code)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for field in batch["field"].unique().to_pylist():
            mine = batch.filter(pc.equal(batch["field"], field))
            place, code, tf = coded(mine["text"].to_pylist())
            times = mine["n"].to_numpy()[place]
            grams, of = np.unique(code, return_inverse=True)
            df, total = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
            np.add.at(df, of, times)
            np.add.at(total, of, tf * times)
            yield pa.RecordBatch.from_pydict({"field": pa.array([field] * len(grams)), "gram": grams, "df": df, "total": total})


class TextWeights:
    """Vectors of texts, as ``vectors`` has them for records, from texts and the numbers of records that have them.

    ``texts`` are ``field, text, n``, a text in any number of rows. The vocabulary (see ``weights`` for its size)
    comes to the driver and goes to tasks with their code; grams are made where they are needed and are never rows.
    """

    def __init__(self, texts: DataFrame, cap: int = 300_000):
        counts = texts.select("field", "text", "n").mapInArrow(_counted, "field string, gram bigint, df bigint, total bigint")
        counts = counts.groupBy("field", "gram").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
        n = texts.groupBy("field").agg(F.sum("n").alias("n")).agg(F.max("n").alias("n"))
        rows = _vocabulary(counts, n, cap).select("field", "gram", "idf").toArrow()
        self.of: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for field in pc.unique(rows["field"]).to_pylist():
            mine = rows.filter(pc.equal(rows["field"], field)).sort_by("gram")
            self.of[field] = mine["gram"].to_numpy(), mine["idf"].to_numpy()

    def add(self, table: pa.Table, field: str) -> pa.Table:
        """``table`` with ``grams`` and ``weights`` of its ``key``, without rows of texts that have none."""
        grams, idf = self.of.get(field, (np.zeros(0, np.int64), np.zeros(0)))
        place, code, tf = coded(table["key"].to_pylist())
        at = np.searchsorted(grams, code)
        known = np.flatnonzero(np.append(grams, -1)[at] == code)
        place, code, raw = place[known], code[known], (1 + np.log(tf[known])) * idf[at[known]]
        weight = raw / np.sqrt(np.bincount(place, raw * raw, table.num_rows))[place]
        ends = np.searchsorted(place, np.arange(table.num_rows + 1)).astype(np.int32)
        lists = {c: pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for c, v in (("grams", code), ("weights", weight))}
        for c, v in lists.items():
            table = table.append_column(c, v)
        return table.filter(pa.array(np.diff(ends) > 0))
