"""Similarities against definitions written out plainly."""

import random
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import similarity as s

WORDS = st.text(alphabet="abc d1", max_size=14)


def lcs(a, b):
    @cache
    def go(i, j):
        if i == len(a) or j == len(b):
            return 0
        return 1 + go(i + 1, j + 1) if a[i] == b[j] else max(go(i + 1, j), go(i, j + 1))

    return go(0, 0)


def plain_ratio(a, b):
    return 2 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0


def plain_partial(a, b):
    if not a or not b:
        return 0.0
    best = 0.0
    for x, y in ((a, b), (b, a)) if len(a) == len(b) else (sorted((a, b), key=len),):
        windows = {y[max(0, e - len(x)) : e] for e in range(1, len(y) + len(x))}
        best = max(best, *(plain_ratio(x, w) for w in windows if w))
    return best


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS)
def test_ratios(a, b):
    assert s.ratio(a, b) == pytest.approx(plain_ratio(a, b)) == s.ratio(b, a)
    assert s.partial_ratio(a, b) == pytest.approx(plain_partial(a, b))
    for f in (s.ratio, s.partial_ratio, s.token_sort, s.token_set_ratio, s.weighted_ratio, s.jaro_winkler):
        assert 0 <= f(a, b) <= 1 + 1e-12
        assert f(a, "") == 0 == f("", b)
    if a.strip():
        assert s.ratio(a, a) == s.partial_ratio(a, a) == s.jaro_winkler(a, a) == 1


def test_vectors():
    a, b = "davis family office", "davis family offie"
    assert s.ratio(a, b) == pytest.approx(0.972973, abs=1e-6)
    assert s.token_set_ratio(a, b) == pytest.approx(0.972973, abs=1e-6)
    assert s.token_sort(a, b) == pytest.approx(0.972973, abs=1e-6)
    assert s.jaro_winkler(a, b) == pytest.approx(0.989474, abs=1e-6)
    assert s.jaro_winkler("abcd", "abxyzqq") == pytest.approx(0.595238, abs=1e-6)
    assert s.token_set_ratio("acme tools", "tools acme inc") == 1.0
    assert s.weighted_ratio("acme", "acme holdings and partners of the world") == pytest.approx(0.9 if 39 / 4 <= 8 else 0.6)


def test_columns(spark):
    rows = [("davis family office", "davis family offie"), ("", ""), ("", "abc"), ("12 main", "12 elm"), ("12 a", "b"), ("x", "y"), ("", "5"), ("5b 7", "7")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    a, b = F.col("a"), F.col("b")
    names = {"j": s.token_jaccard, "o": s.token_overlap, "l": s.levenshtein_similarity, "d": s.length_difference, "n": s.common_numbers, "e": s.one_empty}
    found = df.select("i", *(f(a, b).alias(k) for k, f in names.items())).orderBy("i").collect()
    assert [round(v, 6) for v in found[0][1:]] == [0.5, 2, 0.947368, 0.052632, 1.0, 0.0]
    assert [r["d"] for r in found[1:3]] == [0, 1] and [r["e"] for r in found[1:3]] == [0, 1]
    assert [r["n"] for r in found] == [1, 0, 0, 1, 0, 1, 0, 1]
    pairs = spark.createDataFrame([("us", " US "), ("", ""), ("us", "de"), (None, "us")], "a string, b string")
    assert [r[0] for r in pairs.select(s.country_match(a, b)).collect()] == [1, 0, 0, 0]
    vectors = spark.createDataFrame([([0.6, 0.8], [0.6, 0.8]), ([1.0, 0.0], None)], "a array<float>, b array<float>")
    assert [round(r[0], 6) for r in vectors.select(s.vector_cosine(a, b)).collect()] == [1.0, 0.0]


def test_all_twenty_in_order(spark):
    rng = random.Random(1)
    text = lambda: " ".join(rng.choice(["acme", "tools", "12", "road", "inc", ""]) for _ in range(4)).strip()
    df = spark.createDataFrame([(text(), text(), text(), text(), "us", "US") for _ in range(30)], "na string, nb string, aa string, ab string, ca string, cb string")
    columns = s.all_similarities(*(F.col(c) for c in ("na", "nb", "aa", "ab", "ca", "cb")))
    assert tuple(columns) == s.FEATURES and len(s.FEATURES) == 20
    for r in df.select("*", *(v.alias(k) for k, v in columns.items())).collect():
        assert r["name_ratio"] == pytest.approx(plain_ratio(r["na"], r["nb"]))
        assert r["addr_partial_ratio"] == pytest.approx(plain_partial(r["aa"], r["ab"]))
        assert r["country_match"] == 1
    off = s.all_similarities(*(F.col(c) for c in ("na", "nb", "aa", "ab", "ca", "cb")), use_country=False)
    assert df.select(off["country_match"]).first()[0] == 0


def test_batched_alignments_equal_those_of_single_pairs():
    rng = random.Random(8)
    sizes = [0, 1, 3, 12, 40, 63, 64, 65, 80]
    texts = [" ".join("".join(rng.choices("abcde fg", k=rng.choice(sizes))).split()) for _ in range(400)]
    pairs = [*zip(texts[::2], texts[1::2]), *((t, t[: len(t) // 3]) for t in texts[:60])]
    single = {"ratio": s.ratio, "partial_ratio": s.partial_ratio, "token_sort": s.token_sort, "token_set": s.token_set_ratio, "wratio": s.weighted_ratio, "jaro_winkler": s.jaro_winkler}
    found = s._aligned(pairs, tuple(single))
    for kind, value in single.items():
        assert found[kind].tolist() == pytest.approx([value(a, b) for a, b in pairs], abs=1e-12)
