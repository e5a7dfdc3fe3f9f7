"""Quality classifier: supervised embeddings of hashed words, word pairs and character n-grams.

A word's vector is the mean of its own hashed vector and those of its character n-grams; a document's
is the mean over its words and its hashed word pairs; a softmax over two classes follows. Everything is
learned by stochastic gradient descent in numpy. As the softmax of two classes depends on the document's
vector through one direction only, each word is scored once as its vector's projection on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import GOLDEN, hash_words, held, id_remainder, in_batches, mix, rolled, trim, utf8, word_ngrams

BUCKETS = 1 << 18
DIMENSIONS = 12
EPOCHS = 6
RATE = 0.4
SAMPLE = 6_000
SAMPLE_CHARACTERS = 40_000_000
NGRAMS = range(3, 5)
REPEATED = 0
CACHED = 500_000
CACHED_BYTES = 32_000_000
SLICE = 65_536
SCHEMA = "doc_id bigint, score double, predicted int"


def _words(text: bytes) -> list[bytes]:
    return text.split()


def _buckets(hashes: np.ndarray) -> np.ndarray:
    """Buckets of hashed features; the one of repeated words is theirs alone."""
    return (hashes % np.uint64(BUCKETS - 1) + np.uint64(REPEATED + 1)).astype(np.int64)


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words' features, each one's word, and a 64-bit hash of each word."""
    texts = [w.decode("utf-8", "replace") for w in words]
    features, owners = [], []
    hashes = mix(hash_words(words))
    features.append(_buckets(hashes))
    owners.append(np.arange(len(words)))
    for _, grams, owner in word_ngrams(texts, NGRAMS):
        features.append(_buckets(grams))
        owners.append(owner)
    return np.concatenate(features), np.concatenate(owners), hashes


def sliced_ngrams(word: bytes) -> Iterator[np.ndarray]:
    """Buckets of a word's n-grams as ``subwords`` has them, of one slice at a time; an n-gram is of the slice where it starts."""
    padded = f"\x02{word.decode('utf-8', 'replace')}\x03"
    for begin in range(0, len(padded), SLICE):
        codes = np.frombuffer(padded[begin : begin + SLICE + max(NGRAMS) - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        for n in NGRAMS:
            grams = mix(rolled(codes[: SLICE + n - 1], n) + np.uint64(n * GOLDEN % (1 << 64)))
            yield _buckets(grams)


def pairs(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the pairs of neighbouring words; a word repeated is one feature, whatever the word."""
    either = _buckets(mix(hashes[:-1] * np.uint64(3) + hashes[1:]))
    return np.where(hashes[:-1] == hashes[1:], REPEATED, either)


@dataclass
class Classifier:
    """What scoring needs of the learned model: each bucket's projection on the softmax's direction, and a bias."""

    projected: np.ndarray
    bias: float
    digest: str

    def probability(self, mean: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(mean + self.bias, -60, 60)))


def _document(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and their weights in its mean."""
    words = _words(text)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    index: dict[bytes, int] = {}
    at = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    feature, owner, hashes = subwords(list(index))
    times = np.bincount(at, minlength=len(index))
    share = (times / np.bincount(owner, minlength=len(index)))[owner]
    pair = pairs(hashes[at])
    total = len(words) + len(pair)
    buckets, where = np.unique(np.concatenate([feature, pair]), return_inverse=True)
    return buckets, np.bincount(where, np.concatenate([share, np.ones(len(pair))])) / total


def fit(rows: list[tuple[bytes, int]], seed: int = 7) -> Classifier:
    """Learn from (text, label) rows; the rarer class weighs up to three times as much."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    documents = [(*_document(text), label) for text, label in rows]
    ones = sum(label for _, label in rows)
    weight = np.clip([len(rows) / max(1, 2 * (len(rows) - ones)), len(rows) / max(1, 2 * ones)], 1 / 3, 3).astype(np.float32)
    steps = EPOCHS * len(documents)
    step = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(documents)):
            buckets, share, label = documents[i]
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            share = share.astype(np.float32)
            hidden = share @ vectors[buckets] if len(buckets) else np.zeros(DIMENSIONS, np.float32)
            z = hidden @ softmax + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            p *= weight[label]
            back = softmax @ p
            softmax -= rate * np.outer(hidden, p)
            bias -= np.float32(0.1) * rate * p
            if len(buckets):
                # Features spread over a whole document get tiny shares; steps are scaled to their mean.
                vectors[buckets] -= rate * (share / np.float32(np.square(share).sum() + 1e-12))[:, None] * np.float32(0.1) * back
    del documents
    trim()
    projected = (vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64)
    return Classifier(projected, float(bias[1] - bias[0]), str(abs(hash(projected.tobytes()))))


def training_rows(docs: DataFrame, labels: DataFrame, keep, bound: int = SAMPLE, most: int = SAMPLE_CHARACTERS) -> list[tuple[bytes, int]]:
    """At most ``bound`` labelled documents that ``keep`` allows, chosen by their hashed ids (the same at every run).

    Texts are taken whole, whatever their length, and in the order of that hash; once they have ``most``
    characters together, no more are taken. Null labels, and ids whose labels contradict each other, teach
    nothing.
    """
    clean = labels.where(keep & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    clean = clean.where("low = high").select("doc_id", F.col("low").alias("label"), F.abs(F.xxhash64("doc_id", F.lit(5))).alias("place"))
    chosen = clean.orderBy("place", "doc_id").limit(bound)  # bounded, so it may be broadcast
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sizes = sorted((r["place"], r["size"]) for r in rows.groupBy("doc_id", "place").agg(F.max(F.length("text")).alias("size")).collect())
    before = [0, *accumulate(size for _, size in sizes)]
    last = max((place for (place, _), start in zip(sizes, before) if start < most), default=-1)
    out = {}
    for row in rows.where(F.col("place") <= last).select("place", "doc_id", "label", "text").toLocalIterator():
        text = row["text"].encode()
        key = row["place"], row["doc_id"]
        out[key] = min(out.get(key, (text, row["label"])), (text, row["label"]))  # of several texts under an id the smallest
    return [out[k] for k in sorted(out)]


class WordScores:
    """Projection and hash of each word met so far; emptied when full."""

    def __init__(self, model: Classifier):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.bytes = 0
        self.score, self.hash = np.zeros(1024), np.zeros(1024, np.uint64)

    def learn(self, words: set[bytes]) -> None:
        new = sorted(w for w in words if w not in self.index)
        begin, end = len(self.index), len(self.index) + len(new)
        if end > len(self.score):
            more = max(end, len(self.score))
            self.score, self.hash = np.concatenate([self.score, np.zeros(more)]), np.concatenate([self.hash, np.zeros(more, np.uint64)])
        short = [w for w in new if len(w) <= 64]
        for at in range(0, len(short), 20_000):
            part = short[at : at + 20_000]
            feature, owner, hashes = subwords(part)
            self.score[begin + at : begin + at + len(part)] = np.bincount(owner, self.model.projected[feature], len(part)) / np.bincount(owner, minlength=len(part))
            self.hash[begin + at : begin + at + len(part)] = hashes
        long = [w for w in new if len(w) > 64]
        if long:
            hashes = mix(hash_words(long))
            own = self.model.projected[_buckets(hashes)]
            for at, word in enumerate(long, begin + len(short)):
                total, n = own[at - begin - len(short)], 1
                for feature in sliced_ngrams(word):
                    total, n = total + self.model.projected[feature].sum(), n + len(feature)
                self.score[at] = total / n
            self.hash[begin + len(short) : end] = hashes
        self.bytes += sum(map(len, new))
        self.index.update(zip(short + long, range(begin, end)))

    def of(self, text: bytes) -> float:
        """Mean projection of a document's words and word pairs."""
        words, total, last, n = _words(text), 0.0, None, 0
        for begin in range(0, len(words), 200_000):
            part = words[begin : begin + 200_000]
            missing = set(part).difference(self.index)
            if missing and (len(self.index) + len(missing) > CACHED or self.bytes > CACHED_BYTES):
                self.clear()
                missing = set(part)
            if missing:
                self.learn(missing)
            at = np.fromiter(map(self.index.__getitem__, part), np.int64, len(part))
            hashes = self.hash[at] if last is None else np.concatenate([last, self.hash[at]])
            total += self.score[at].sum() + self.model.projected[pairs(hashes)].sum()
            n += len(part) + len(hashes) - 1
            last = hashes[-1:]
        return total / n if n else 0.0


def _scores(model: Classifier) -> WordScores:
    return held("quality", model.digest, lambda: WordScores(model), ("words",))


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text, from its text alone.

    ``score`` is the probability of label 1 and ``predicted`` whether it reaches 0.5. Null and empty texts
    get the score of a text without words. One row for each input row; null ids and repeated rows stay,
    other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB, whatever the input

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        cache = _scores(shared.value)
        means = np.array([cache.of(text) if text else 0.0 for text in utf8(batch, "text")])
        found = shared.value.probability(means)
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return in_batches(docs.select("doc_id", "text"), step, SCHEMA)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Learn from labelled rows outside the held-out fold of ids, and score every row; adds ``held_out``."""
    model = fit(training_rows(docs, labels, id_remainder("doc_id", folds) != held_out))
    return score(docs, model).withColumn("held_out", id_remainder("doc_id", folds) == held_out)
