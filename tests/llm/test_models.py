"""Language ID and quality: held-out accuracy, exact probabilities, awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_id, quality
from tests.llm.helpers import AWKWARD, frame

SYLLABLES = {"aa": ["ka", "lo", "mi", "tun"], "bb": ["she", "ord", "ing", "ka"], "cc": ["ñu", "ção", "rri", "lo"]}


def spoken(rng, language, n):
    return " ".join("".join(rng.choice(SYLLABLES[language]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n=240):
    rng = random.Random(6)
    return [(i, spoken(rng, lang, rng.randint(8, 60)), lang) for i in range(n) for lang in [rng.choice(sorted(SYLLABLES))]]


def test_languages_held_out(spark):
    rows = [*AWKWARD, *corpus(), (950, "ka lo", None), (951, "12 34", "aa"), (952, None, "bb")]
    found = language_id.identify(frame(spark, rows, extra=True)).collect()
    assert len(found) == len(rows)
    truth = {i: lang for i, _, lang in corpus()}
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 20 and np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97
    by_id = {r["doc_id"]: r for r in found}
    for i in (900, 901, 902, 906, 951, 952):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["rejected"]) == ("und", 0.0, True)
    assert not any(by_id[i]["rejected"] for i in truth) and all(0 <= r["score"] <= 1 for r in found)


def test_rejection_keeps_columns_and_clean_rows(spark):
    docs = frame(spark, [*corpus(), (950, " ".join("xqzjwv" * 3 for _ in range(60)))], extra=True)
    models = language_id.fit(language_id.training_texts(docs.where("doc_id < 900"), F.lit(True)))
    kept = language_id.accepted(docs, models)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, *_ in corpus()}
    nothing = language_id.fit({})
    assert language_id.accepted(docs, nothing).count() == 0
    assert language_id.identify(frame(spark, [])).count() == 0


def test_stored_probabilities_are_interpolated_kneser_ney():
    texts = {"a": ["abab abc", "cab bab"], "b": ["bbc cc", "acb a"]}
    models = language_id.fit(texts, order=3)
    kept = {k: [t for i, t in enumerate(v)] for k, v in texts.items()}
    learned = {k: language_id._kneser_ney(language_id.Counter(w for t in kept[k] for w in language_id.words_of(t)), 3, 5) for k in kept}

    def probability(language, gram):
        p, w = learned[language]
        n = len(gram)
        if n == 0:
            return 1 / 5
        if gram in p[n]:
            return p[n][gram]
        return w[n].get(gram[:-1], 1.0) * probability(language, gram[1:])

    words = ["abc", "bbb", "cazb", "x"]
    total, size = models.log_probabilities(words)
    for word, row, n in zip(words, total, size):
        padded = f"\x02{word}\x03"
        assert n == len(word) + 1
        for j, language in enumerate(models.languages):
            expected = sum(np.log(probability(language, padded[max(0, i - 2) : i + 1])) for i in range(1, len(padded)))
            assert row[j] == pytest.approx(expected)
    for language in texts:
        for context in ("a", "b", "\x02", "ab"):
            alphabet = [c for c in learned[language][0][1]]
            rest = 1 - sum(probability(language, context + c) for c in alphabet)
            assert -1e-9 < rest < 1


def test_models_equal_kneser_ney_written_anew():
    """Orders, discounts and continuations from their definitions: counts of lists, no back-off tables."""
    texts = {"a": ["abab abc", "cab bab", "abc aab ca"], "b": ["bbc cc", "acb a", "cab bcc"]}
    models = language_id.fit(texts, order=3)
    alphabet = {c for x in texts.values() for t in x for c in t if c != " "}

    def probability(words, context, char):
        """Of ``char`` after ``context``; unseen contexts leave all to the shorter one."""
        n = len(context) + 1
        grams = lambda m: [w[i : i + m] for w in words for i in range(len(w) - m + 1)]
        if n == 3:
            counted = grams(3)
        else:
            # A type of what comes before counts once; at a word's start nothing comes before.
            counted = [g[1:] for g in set(grams(n + 1))] + [g for g in grams(n) if n > 1 and g[0] == "\x02"]
        counted = [g for g in counted if g != "\x02"]
        times = {g: counted.count(g) for g in set(counted)}
        once, twice = (list(times.values()).count(c) for c in (1, 2))
        discount = once / (once + 2 * twice) if once and twice else 0.5
        lower = 1 / (len(alphabet) + 2) if n == 1 else probability(words, context[1:], char)
        after = {g: c for g, c in times.items() if g[:-1] == context}
        if not after:
            return lower
        return (max(after.get(context + char, 0) - discount, 0) + discount * len(after) * lower) / sum(after.values())

    tested = ["abc", "bbb", "cazb", "x", "a"]
    total, size = models.log_probabilities(tested)
    for j, language in enumerate(models.languages):
        words = [f"\x02{w}\x03" for t in texts[language] for w in t.split()]
        kept = [t for i, t in enumerate(texts[language]) if i % 5 or len(texts[language]) < 5]
        assert kept == texts[language]
        for word, row in zip(tested, total):
            padded = f"\x02{word}\x03"
            expected = sum(np.log(probability(words, padded[max(0, i - 2) : i], padded[i])) for i in range(1, len(padded)))
            assert row[j] == pytest.approx(expected)
        for context in ("", "a", "\x02", "ab", "ca"):
            rest = 1 - sum(probability(words, context, c) for c in [*sorted(alphabet), "\x03"])
            assert rest == pytest.approx(probability(words, context, "unseen"))


def test_quality_steps_follow_the_numerical_gradient(monkeypatch):
    """One step from known weights moves softmax and vectors against the loss's differences."""
    monkeypatch.setattr(quality, "EPOCHS", 1)
    monkeypatch.setattr(quality, "BUCKETS", 64)
    text, rng = b"ab cd ab efg", np.random.default_rng(7)
    start = rng.uniform(-1 / quality.DIMENSIONS, 1 / quality.DIMENSIONS, (64, quality.DIMENSIONS)).astype(np.float32).astype(float)
    buckets, share = quality._document(text)
    for label in (0, 1):
        # The first step has a softmax of zeros, so it moves the softmax alone; the second moves the vectors too.
        rows = [(text, label)] * 2
        weight = float(np.clip([len(rows) / max(1, 2 * sum(1 - r[1] for r in rows)), len(rows) / max(1, 2 * sum(r[1] for r in rows))], 1 / 3, 3)[label])

        def loss(vectors, softmax, bias):
            z = (share @ vectors[buckets]) @ softmax + bias
            return -weight * (z[label] - np.log(np.exp(z).sum()))

        def slope(f, at):
            out = np.zeros_like(at)
            for i in np.ndindex(at.shape):
                up, down = at.copy(), at.copy()
                up[i] += 1e-5
                down[i] -= 1e-5
                out[i] = (f(up) - f(down)) / 2e-5
            return out

        vectors, softmax, bias = start.copy(), np.zeros((quality.DIMENSIONS, 2)), np.zeros(2)
        for step in range(2):
            rate = quality.RATE * (1 - step / 2)
            by_softmax, by_bias, by_vectors = slope(lambda x: loss(vectors, x, bias), softmax), slope(lambda x: loss(vectors, softmax, x), bias), slope(lambda x: loss(x, softmax, bias), vectors)
            softmax, bias = softmax - rate * by_softmax, bias - 0.1 * rate * by_bias
            vectors = vectors - rate * 0.1 * by_vectors / (np.square(share).sum() + 1e-12)
        model = quality.fit(rows)
        assert model.projected == pytest.approx(vectors @ (softmax[:, 1] - softmax[:, 0]), abs=1e-5)
        assert model.bias == pytest.approx(bias[1] - bias[0], abs=1e-5)


def marked(n=400):
    rng = random.Random(8)
    out = []
    for i in range(n):
        good = rng.random() < 0.6
        words = [spoken(rng, "bb", 1) + ("" if good else rng.choice(["!!", "$$$", "@"])) for _ in range(rng.randint(5, 60))]
        out.append((i, " ".join(words), int(good)))
    return out


def test_quality_held_out(spark):
    rows = marked()
    docs = frame(spark, [*AWKWARD, *((i, t) for i, t, _ in rows), (7, "a second text under one id")], extra=True)
    labels = spark.createDataFrame([*((i, q, 0) for i, _, q in rows), (3, 1 - rows[3][2], 0), (4, None, 0), (None, 1, 0), (99999, 1, 0)], "doc_id bigint, quality int, toxic int")
    found = quality.classify(docs, labels).collect()
    assert len(found) == len(rows) + len(AWKWARD) + 1
    truth = {i: q for i, _, q in rows}
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([truth[r["doc_id"]] == r["predicted"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    assert quality.classify(frame(spark, []), labels.limit(0)).count() == 0


def test_word_scores_sum_to_the_document_s_score():
    rows = [(t.encode(), q) for _, t, q in marked(80)]
    model = quality.fit(rows)
    cache = quality.WordScores(model)
    for text, _ in rows[:10]:
        buckets, share = quality._document(text)
        assert cache.of(text) == pytest.approx(float(share @ model.projected[buckets]), rel=1e-6, abs=1e-9)
    assert cache.of(b"") == 0.0 and cache.of(b"one") != 0.0


def test_quality_reads_the_middle_of_long_words(monkeypatch):
    rng = random.Random(12)
    rows = [("".join(chr(rng.randrange(*((0x4E00, 0x4E06) if good else (0x5E00, 0x5E06)))) for _ in range(rng.randint(80, 300))), good) for _ in range(200) for good in [rng.randrange(2)]]
    ends = "".join(chr(0x6E00 + i) for i in range(32))
    rows = [((ends + text + ends).encode(), good) for text, good in rows]
    model = quality.fit(rows[:150])
    cache = quality.WordScores(model)
    assert np.mean([(model.probability(cache.of(text)) >= 0.5) == good for text, good in rows[150:]]) > 0.95
    for size in (7, 64, 65_536):
        monkeypatch.setattr(quality, "SLICE", size)
        cache = quality.WordScores(model)
        for text, _ in rows[:20]:
            buckets, share = quality._document(text + b" and more")
            assert cache.of(text + b" and more") == pytest.approx(float(share @ model.projected[buckets]), rel=1e-6, abs=1e-9)


def test_texts_of_a_language_left_out_are_rejected():
    rng = random.Random(21)
    near = {"aa": "ka lo mi tun re", "bb": "she ord ing ka ve", "cc": "ka lo mi tun er"}
    say = lambda k, n: " ".join("".join(rng.choice(near[k].split()) for _ in range(rng.randint(1, 4))) for _ in range(n))
    models = language_id.fit({k: [say(k, 60) for _ in range(100)] for k in ("aa", "bb")})
    rejected = lambda texts: language_id._judged(models, texts)[3].tolist()
    assert all(rejected([say("cc", 60) for _ in range(50)]))
    assert not any(rejected([say(k, 60) for k in ("aa", "bb") for _ in range(50)]))
    assert not any(rejected([f"{say('aa', 40)} {say('bb', 30)}" for _ in range(50)]))
    assert not any(rejected(["ka lo", "Tunmi " * 400]))


def test_languages_and_labels_of_long_texts_alone_are_learned(spark):
    rng = random.Random(12)
    a, b = sorted(SYLLABLES)[:2]
    rows = [(i, spoken(rng, a, 60), a) for i in range(30)] + [(100 + i, spoken(rng, b, 9_000), b) for i in range(8)] + [(200, spoken(rng, b, 40), None)]
    docs = frame(spark, rows)
    assert min(len(t) for _, t, lang in rows if lang == b) > 30_000
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, language_id.fit(language_id.training_texts(docs, F.lit(True)))).collect()}
    assert found[200] == b and found[3] == a
    assert len(language_id.training_texts(docs, F.lit(True), most=1)[b]) == 1
    labels = spark.createDataFrame([(r[0], int(r[0] >= 100)) for r in rows[:-1]], "doc_id bigint, quality int")
    taught = quality.training_rows(docs, labels, F.lit(True))
    assert len(taught) == 38 and sum(label for _, label in taught) == 8
