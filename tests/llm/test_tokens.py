"""Sentence pieces and token counts against the public libraries and by-hand paths."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import sentence_pieces, token_counts
from tessera.llm.queries import VOCABULARY
from tessera.llm.spm_model import BPE, NORMAL, UNIGRAM, UNKNOWN, SentencePieceModel
from tests.llm.helpers import AWKWARD, frame, prose

library = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def model():
    return SentencePieceModel.load(VOCABULARY)


@pytest.fixture(scope="module")
def texts(model):
    rng = random.Random(1)
    out = ["", " ", "  a  b ", "x" * 300, "Hello  world\n\tx é 漢字 ▁q", "aaaaabababababbbabab" * 20, "    if x:\n        return   y"]
    out += ["".join(rng.choice("abethnio ▁é\n,.") for _ in range(300)) for _ in range(20)]
    return out + ["".join(rng.choice(model.texts()) for _ in range(60)) for _ in range(40)]


def by_chunks(lattice, text, size):
    matrices, parts = [], []
    for k, p in enumerate(range(0, len(text), size)):
        q, left = min(len(text), p + size), max(0, p - lattice.longest)
        part = text[left : q + lattice.longest]
        whole = lattice.normal(part, k == 0)
        grown = len(whole) - len(part)
        parts.append((whole, p - left + grown * (k > 0), q - left + grown, k == 0))
        matrices.append(lattice.transfer(*parts[-1]))
    states = sentence_pieces.boundary_states(matrices)
    return [i for a, e, f in zip(parts, [0, *states[:-1]], states) for i in lattice.traced(*a, e, f)]


def test_whole_texts_and_chunks_give_the_library_s_ids(model, texts):
    lattice, other = sentence_pieces.Lattice(model), library.SentencePieceProcessor(model_file=VOCABULARY)
    assert model.kind == BPE
    for text in texts:
        expected = other.encode(text)
        assert lattice.encode(text) == expected
        for size in (40, 97):
            assert not text or by_chunks(lattice, text, size) == expected


def small_unigram(rng):
    pieces = {"▁": -2.0} | {c: -4.0 for c in "abc"}
    for _ in range(14):
        pieces["".join(rng.choice("▁abc" if i == 0 else "abc") for i in range(rng.randint(2, 4)))] = -rng.uniform(2, 6)
    return SentencePieceModel((("<unk>", 0.0, UNKNOWN), *((t, s, NORMAL) for t, s in pieces.items())), UNIGRAM, True)


def best_weight(lattice, text):
    """Brute force over all ends."""
    best = [0.0] + [float("-inf")] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(j):
            if text[i:j] in lattice.ids or j == i + 1:
                best[j] = max(best[j], best[i] + lattice.weight(text[i:j]))
    return best[-1]


def test_unigram_paths_are_the_best_ones_whole_and_in_chunks():
    rng = random.Random(5)
    for _ in range(20):
        lattice = sentence_pieces.Lattice(small_unigram(rng))
        scores = {i: s for t, i in lattice.ids.items() for s in [lattice.rank[t]]}
        for _ in range(10):
            text = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
            expected = best_weight(lattice, lattice.normal(text))
            for ids in (lattice.encode(text), by_chunks(lattice, text, 16)):
                assert sum(scores[i] for i in ids) == pytest.approx(expected)


def test_max_plus_products_are_associative():
    import numpy as np

    rng = np.random.default_rng(0)
    a, b, c = rng.normal(size=(2, 5)), rng.normal(size=(5, 4)), rng.normal(size=(4, 3))
    assert np.allclose(sentence_pieces.combined(sentence_pieces.combined(a, b), c), sentence_pieces.combined(a, sentence_pieces.combined(b, c)))


def test_round_trip_of_a_table_with_giant_and_awkward_texts(spark, model):
    rows = [*AWKWARD, (1, prose(1, 400)), (2, "ab" * 900), (2, "ab" * 900), (3, "no spaces at all " * 90)]
    docs = frame(spark, rows, extra=True)
    found = sentence_pieces.round_trip(docs, model, chunk=128, giant=500).collect()
    other = library.SentencePieceProcessor(model_file=VOCABULARY)
    assert sorted((r["doc_id"] or -1, list(r["ids"])) for r in found) == sorted((i or -1, other.encode(t or "")) for i, t in rows)
    assert all(r["round_trip"] for r in found)
    both = sentence_pieces.decode(sentence_pieces.encode(docs, model, 128, 500), model)
    assert both.where(F.coalesce("text", F.lit("")) != F.col("decoded")).count() == 0 and both.count() == len(rows)
    assert sentence_pieces.round_trip(frame(spark, []), model).count() == 0


def test_token_counts_are_those_of_greedy_matching(spark, model):
    tokenizers = pytest.importorskip("tokenizers")
    starts, rest = token_counts.word_piece_vocabulary(model)
    vocabulary = {"[UNK]": 0}
    for piece in [*starts, *("##" + p for p in rest)]:
        vocabulary.setdefault(piece, len(vocabulary))
    other = tokenizers.Tokenizer(tokenizers.models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10**9))
    other.pre_tokenizer = tokenizers.pre_tokenizers.BertPreTokenizer()
    rng = random.Random(3)
    rows = [*AWKWARD, (1, prose(2, 300)), (2, "a b　c—d’e unaffable"), (3, "a" * 5000), *((10 + i, "".join(rng.choice("abcdefghiknort##  ,.é") for _ in range(200))) for i in range(20))]
    found = {(r["doc_id"], r["n_words"], r["n_tokens"], r["n_unknown"]) for r in token_counts.count_tokens(frame(spark, rows, extra=True), model).collect()}
    expected = set()
    for i, text in rows:
        ids = other.encode(text or "", add_special_tokens=False)
        expected.add((i, len(set(ids.word_ids)) if not text else len(other.pre_tokenizer.pre_tokenize_str(text)), len(ids.ids), ids.ids.count(0)))
    assert found == expected
    assert token_counts.count_tokens(frame(spark, []), model).count() == 0
