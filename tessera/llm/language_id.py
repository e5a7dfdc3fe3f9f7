"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays.

Each language has a model of the characters of a word, given the characters before them. All languages
share one sorted array of n-gram hashes for each order; beside it stand each language's probability of
the n-gram's last character and, for contexts, its back-off weight. A text goes to the language with
the lowest cross-entropy per character. It is rejected if its words, each in the language that knows it
best, are far above what held-back training texts of its language have: so a text in several known
languages stays.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import held, id_remainder, in_batches, mix, trim, word_ngrams

ORDER = 5
SAMPLE_TEXTS = 300
SAMPLE_CHARACTERS = 4_000_000
UNKNOWN = "und"
CACHED = 150_000
MOST_WORDS = 50_000
LETTERS = re.compile(r"[^\W\d_]+")
SCHEMA = "doc_id bigint, lang_pred string, score double, cross_entropy double, rejected boolean"


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters (runs of number signs, which patterns count as letters, hold no letter)."""
    return LETTERS.findall(text.lower())


@dataclass
class Order:
    """One order's sorted n-gram hashes, with logs of probabilities (n-gram by language)."""

    keys: np.ndarray
    log_p: np.ndarray

    def __post_init__(self):
        # Where each value of the leading bits starts: a binary search narrowed to a few steps.
        self.bits = max(1, min(22, int(len(self.keys)).bit_length()))
        heads = self.keys >> np.uint64(64 - self.bits)
        self.start = np.searchsorted(heads, np.arange((1 << self.bits) + 1, dtype=np.uint64))
        self.steps = int(np.diff(self.start).max()) if len(self.keys) else 0

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each key, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        head = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        at, last = self.start[head], self.start[head + 1]
        for _ in range(self.steps):
            at += (at < last) & (self.keys[np.minimum(at, len(self.keys) - 1)] < keys)
        at = np.minimum(at, len(self.keys) - 1)
        return at, self.keys[at] == keys


@dataclass
class LanguageModels:
    """Models of all languages, with what rejection and scores need."""

    languages: list[str]
    floor: np.ndarray
    grams: list[Order]
    contexts: list[Order]
    expected: np.ndarray | None = None
    spread: np.ndarray | None = None
    wobble: np.ndarray | None = None
    temperature: float = 1.0
    digest: str = ""

    def log_probabilities(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log probabilities (word by language) and number of characters, end marks included."""
        out, size = np.zeros((len(words), len(self.languages))), np.zeros(len(words), np.int64)
        for begin in range(0, len(words), 20_000):
            part = words[begin : begin + 20_000]
            lengths = np.fromiter(map(len, part), np.int64, len(part)) + 2
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            owner = np.repeat(np.arange(len(part)), lengths)
            place = np.arange(lengths.sum()) - first[owner]
            log_p = np.repeat(self.floor[None, :], len(owner), axis=0)
            hashes = dict((n, h) for n, h, _ in word_ngrams(part, range(1, len(self.grams) + 1)))
            for n in range(1, len(self.grams) + 1):
                ends = np.flatnonzero(place >= n - 1)
                at, found = self.grams[n - 1].find(hashes[n])
                if n > 1:
                    # The context is the n-gram without its last character: same start, one shorter.
                    shorter = np.flatnonzero(place[np.flatnonzero(place >= n - 2)] < (lengths[owner] - 1)[np.flatnonzero(place >= n - 2)])
                    c_at, c_found = self.contexts[n - 1].find(hashes[n - 1][shorter])
                    missed = ~found & c_found
                    log_p[ends[missed]] += self.contexts[n - 1].log_p[c_at[missed]]
                log_p[ends[found]] = self.grams[n - 1].log_p[at[found]]
            log_p[place == 0] = 0.0
            out[begin : begin + len(part)] = np.add.reduceat(log_p, first)
            size[begin : begin + len(part)] = lengths - 1
        return out, size

    def threshold(self, language: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        """Cross-entropy of words in their best languages above which a text of so many different words is rejected."""
        return self.expected[language] + 6.0 * np.sqrt(self.wobble[language] ** 2 / np.maximum(n_words, 1) + self.spread[language] ** 2)


def _key(gram: str) -> int:
    n = len(gram)
    value, power = 0, 1
    for char in gram:
        value = (value + ord(char) * power) & (1 << 64) - 1
        power = power * 0xD6E8FEB86659FD93 & (1 << 64) - 1
    return (value + n * 0x9E3779B97F4A7C15) & (1 << 64) - 1


def _kneser_ney(words: Counter, order: int, n_chars: int) -> tuple[list[dict[str, float]], list[dict[str, float]]]:
    """Interpolated probabilities by order of n-gram, and the back-off weights of its contexts."""
    top = [Counter() for _ in range(order + 1)]
    for word, times in words.items():
        padded = f"\x02{word}\x03"
        for n in range(1, order + 1):
            grams = top[n]
            for i in range(len(padded) - n + 1):
                grams[padded[i : i + n]] += times
    counts = [None] * (order + 1)
    counts[order] = top[order]
    for n in range(order - 1, 0, -1):
        # Continuations; what stands at a word's start has nothing before it and keeps its own count.
        kept = Counter(g[1:] for g in top[n + 1])
        kept.update({g: c for g, c in top[n].items() if g[0] == "\x02" and n > 1})
        counts[n] = kept
    probability, weight = [{}], [{}]
    for n in range(1, order + 1):
        grams = {g: c for g, c in counts[n].items() if g != "\x02"}
        # Shorter words end before the full order, so their last n-grams are counted as they are.
        once, twice = (sum(c == k for c in grams.values()) for k in (1, 2))
        discount = once / (once + 2 * twice) if once and twice else 0.5
        total, kinds = defaultdict(float), defaultdict(int)
        for g, c in grams.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        weight.append({h: discount * kinds[h] / total[h] for h in total})
        lower = probability[n - 1]
        probability.append({g: max(c - discount, 0) / total[g[:-1]] + weight[n][g[:-1]] * (lower[g[1:]] if n > 1 else 1 / n_chars) for g, c in grams.items()})
    return probability, weight


def fit(texts: dict[str, list[str]], order: int = ORDER) -> LanguageModels:
    """Models from texts by language; every fifth text is held back to calibrate scores and rejection."""
    languages = sorted(texts)
    kept = {k: [t for i, t in enumerate(texts[k]) if i % 5 or len(texts[k]) < 5] for k in languages}
    counts = {k: Counter(w for t in kept[k] for w in words_of(t)) for k in languages}
    n_chars = len({c for x in counts.values() for w in x for c in w}) + 2
    learned = {k: _kneser_ney(counts[k], order, n_chars) for k in languages}
    # A character that no language knows: what the shortest context leaves, spread over all characters.
    floor = np.log(np.array([learned[k][1][1].get("", 1.0) for k in languages]) / n_chars)
    grams, contexts = [], []
    for n in range(1, order + 1):
        union = sorted({g for k in languages for g in learned[k][0][n]})
        table = np.empty((len(union), len(languages)))
        for j, k in enumerate(languages):
            probability, weight = learned[k]
            for i, g in enumerate(union):
                # The language's own n-gram, or its longest suffix under the weights of the contexts above it.
                factor, m = 1.0, n
                while m and (p := probability[m].get(g[n - m :])) is None:
                    factor *= weight[m].get(g[n - m : -1], 1.0)
                    m -= 1
                table[i, j] = factor * (p if m else 1 / n_chars)
        grams.append(_ordered(union, np.log(table)))
        heads = sorted({h for k in languages for h in learned[k][1][n]}) if n > 1 else []
        contexts.append(_ordered(heads, np.log(np.array([[learned[k][1][n].get(h, 1.0) for k in languages] for h in heads]).reshape(len(heads), len(languages)))))
    models = LanguageModels(languages, floor, grams, contexts)
    held = {k: [t for i, t in enumerate(texts[k]) if not i % 5] for k in languages}
    _calibrate(models, held)
    trim()
    models.digest = str(hash(tuple(o.keys.tobytes() + o.log_p.tobytes() for o in grams)))
    return models


def _ordered(grams: list[str], log_p: np.ndarray) -> Order:
    keys = mix(np.array([_key(g) for g in grams], np.uint64)) if grams else np.zeros(0, np.uint64)
    order = np.argsort(keys)
    return Order(keys[order], log_p[order])


def _calibrate(models: LanguageModels, held: dict[str, list[str]]) -> None:
    """What rejection needs of each language's held-back texts, and the scores' temperature.

    Rejection takes the usual cross-entropy of words in their best languages and its spread over words and
    texts. A spread of 0.3 counts as one more text, for languages with few of them.
    """
    n = len(models.languages)
    models.expected, models.spread, models.wobble = np.full(n, 3.0), np.full(n, 0.5), np.full(n, 1.0)
    rows, right = [], []
    for j, k in enumerate(models.languages):
        entropies, by_word = [], []
        for text in held[k]:
            if words := words_of(text):
                total, size = models.log_probabilities(words)
                rows.append(-total.sum(0) / size.sum())
                right.append(j)
                lowest = -total.max(axis=1)
                entropies.append(lowest.sum() / size.sum())
                by_word.append(lowest / size)
        if entropies:
            models.expected[j] = np.mean(entropies)
            models.wobble[j] = np.std(np.concatenate(by_word))
            models.spread[j] = np.sqrt((len(entropies) * np.var(entropies) + 0.3**2) / (len(entropies) + 1))
    if rows:
        entropy, right = np.array(rows), np.array(right)
        models.temperature = min((2.0**-t for t in range(8)), key=lambda t: -np.log(_posterior(entropy, t)[np.arange(len(right)), right] + 1e-12).mean())


def _posterior(entropy: np.ndarray, temperature: float) -> np.ndarray:
    x = -(entropy - entropy.min(axis=1, keepdims=True)) / temperature
    e = np.exp(x)
    return e / e.sum(axis=1, keepdims=True)


def training_texts(docs: DataFrame, keep, per_language: int = SAMPLE_TEXTS, most: int = SAMPLE_CHARACTERS) -> dict[str, list[str]]:
    """At most ``per_language`` different texts of each language, from the rows that ``keep`` allows.

    The sample is the rows whose hashed id falls under each language's share, so it is the same at every run.
    Texts are taken whole, whatever their length, and in the order of that hash; once those of a language
    have ``most`` characters together, no more of it are taken.
    """
    place = F.abs(F.xxhash64("doc_id", F.lit(11)) % 1_000_000)
    rows = docs.where(keep & (F.length("text") > 0) & F.col("lang").isNotNull()).select("doc_id", "text", "lang", place.alias("place"), F.length("text").alias("size"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = F.lit(False)
    for language, n in sorted(counts.items()):
        chosen = chosen | ((F.col("lang") == language) & (F.col("place") < min(1_000_000, int(1.5e6 * per_language / n) + 1)))
    sizes: dict[str, list[tuple[int, int]]] = {}
    for row in rows.where(chosen).select("lang", "place", "size").collect() if counts else []:
        sizes.setdefault(row["lang"], []).append((row["place"], row["size"]))
    taken = F.lit(False)
    for language, each in sorted(sizes.items()):
        each.sort()
        before = [0, *accumulate(size for _, size in each)]
        last = max(place for (place, _), start in zip(each, before) if start < most)
        taken = taken | ((F.col("lang") == language) & (F.col("place") <= last))
    texts: dict[str, list[str]] = {}
    for row in rows.where(chosen & taken).select("lang", "text", "place", "doc_id").collect() if sizes else []:
        texts.setdefault(row["lang"], []).append((row["place"], row["doc_id"] or 0, row["text"]))
    found = {k: list(dict.fromkeys(t for *_, t in sorted(v)))[:per_language] for k, v in texts.items()}
    return {k: v for k, v in found.items() if any(words_of(t) for t in v)}


class WordScores:
    """Log probabilities of the words met so far, by language and the best of them, and sizes; emptied when full."""

    def __init__(self, models: LanguageModels):
        self.models = models
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.models.languages) + 2), np.float32)

    def learn(self, words: set[str]) -> None:
        new = sorted(w for w in words if w not in self.index)
        if not new:
            return
        total, size = self.models.log_probabilities(new)
        size[[not any(map(str.isalpha, w)) for w in new]] = 0
        total[size == 0] = 0.0
        end = len(self.index) + len(new)
        if end > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(end, len(self.rows)), self.rows.shape[1]), np.float32)])
        self.rows[len(self.index) : end] = np.column_stack([total, total.max(axis=1), size])
        self.index.update(zip(new, range(len(self.index), end)))


def _scores(models: LanguageModels) -> WordScores:
    return held("languages", models.digest, lambda: WordScores(models))


def _judged(models: LanguageModels, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, cross-entropy (nan for none) and rejection of each text."""
    cache, n = _scores(models), len(texts)
    totals, counts = np.zeros((n, len(models.languages) + 2)), np.zeros(n, np.int64)
    parts: list[tuple[int, list[str]]] = []
    held_words = 0

    def add() -> None:
        """Sum what is known of the words of ``parts``, after learning all new ones at once."""
        different = [set(part) for _, part in parts]
        missing = set().union(*different).difference(cache.index)
        if len(cache.index) + len(missing) > CACHED:
            cache.clear()
            missing = set().union(*different)
        if missing:
            cache.learn(missing)
        sizes = np.fromiter((len(part) for _, part in parts), np.int64, len(parts))
        at = np.fromiter(map(cache.index.__getitem__, chain.from_iterable(part for _, part in parts)), np.int64, sizes.sum())
        sums = np.add.reduceat(cache.rows[at], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0, dtype=np.float64)
        for (i, _), total, words in zip(parts, sums, different):
            totals[i] += total
            counts[i] = max(counts[i], len(words))  # repeats tell nothing more
        parts.clear()

    for i, text in enumerate(texts if models.languages else []):
        words = words_of(text) if text else []
        for begin in range(0, len(words), MOST_WORDS):
            parts.append((i, words[begin : begin + MOST_WORDS]))
            held_words += len(parts[-1][1])
            if held_words >= MOST_WORDS:
                add()
                held_words = 0
    if parts:
        add()
    size = totals[:, -1]
    some = size > 0
    language, score = np.full(n, UNKNOWN, object), np.zeros(n)
    lowest, rejected = np.full(n, np.nan), np.ones(n, bool)
    if some.any():
        entropy = -totals[some, :-2] / size[some, None]
        best = entropy.argmin(axis=1)
        language[some] = np.array(models.languages, object)[best]
        lowest[some] = entropy[np.arange(len(best)), best]
        score[some] = _posterior(entropy, models.temperature)[np.arange(len(best)), best]
        rejected[some] = -totals[some, -2] / size[some] > models.threshold(best, counts[some])
    return language, score, lowest, rejected


def predict(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """``doc_id, lang_pred, score, cross_entropy, rejected`` of every whole text.

    Only the text decides. ``lang_pred`` is the language of the lowest cross-entropy per character, ties to
    the first in order of names; ``score`` is its calibrated share against the others. Without a letter
    (null and empty texts too), or where no language was learned, it is ``und`` with score 0, null
    cross-entropy and rejection. ``rejected`` also holds where the text is far from every language learned.
    One row for each input row; null ids and repeated rows stay, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)  # a few MB: the sample bounds the n-grams

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        language, score, lowest, rejected = _judged(shared.value, batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(language, pa.string()), pa.array(score), pa.array(lowest, mask=np.isnan(lowest)), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return in_batches(docs.select("doc_id", "text"), step, SCHEMA)


def accepted(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """``docs`` without the rows that ``predict`` rejects; all columns are kept as they are.

    So null and empty texts go, and texts without a letter; repeated rows and null ids go or stay by their
    text. Without a learned language every row goes; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    at = docs.columns.index("text")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(~_judged(shared.value, batch.column(at).to_pylist())[3]))

    return in_batches(docs, step, docs.schema)


def identify(docs: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Learn from the rows outside the held-out fold of ids, and predict every row; adds ``held_out``."""
    models = fit(training_texts(docs, id_remainder("doc_id", folds) != held_out))
    return predict(docs, models).withColumn("held_out", id_remainder("doc_id", folds) == held_out)
