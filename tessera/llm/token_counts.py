"""Word-piece token counts by a linear longest-match automaton.

The vocabulary's trie gets failure links, and each node knows how many pieces are popped when its
link is followed. A word's greedy longest-match length is then one pass over its characters, with
no piece ever built.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import Remembered, held, in_batches, utf8
from tessera.llm.spm_model import SentencePieceModel

SCHEMA = "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint"
_NONE = -1
_FOUR_BYTES = (b"\xf0", b"\xf1", b"\xf2", b"\xf3", b"\xf4")


def word_piece_vocabulary(model: SentencePieceModel) -> tuple[list[str], list[str]]:
    """Pieces that may start a word, and pieces that continue one, from a SentencePiece vocabulary."""
    starts, rest = [], []
    for piece in model.texts():
        if piece.startswith("▁"):
            if len(piece) > 1 and "▁" not in piece[1:]:
                starts.append(piece[1:])
        else:
            rest.append(piece)
    return starts, rest


class LongestMatch:
    """Counts the pieces of greedy longest-match word-piece tokenisation."""

    def __init__(self, starts: list[str], rest: list[str]):
        self.edges: dict[tuple[int, str], int] = {}
        self.root, self.inner = 0, 1
        ends = [False, False]
        order: list[tuple[int, str, int]] = []
        for top, pieces in ((self.root, starts), (self.inner, rest)):
            for piece in pieces:
                node = top
                for char in piece:
                    child = self.edges.get((node, char))
                    if child is None:
                        child = self.edges[node, char] = len(ends)
                        ends.append(False)
                        order.append((node, char, child))
                    node = child
                ends[node] = ends[node] or bool(piece)
        self.link = [_NONE] * len(ends)
        self.pops = [0] * len(ends)
        depth = [0] * len(ends)
        for node, _, child in order:  # a parent always comes before its children
            depth[child] = depth[node] + 1
        for node, char, child in sorted(order, key=lambda e: depth[e[2]]):
            if ends[child]:
                self.link[child], self.pops[child] = self.inner, 1
                continue
            at, popped = self.link[node], self.pops[node]
            while at != _NONE and (at, char) not in self.edges:
                popped += self.pops[at]
                at = self.link[at]
            if at != _NONE:
                self.link[child], self.pops[child] = self.edges[at, char], popped

    def count(self, word: str) -> int:
        """Number of pieces of a word, 0 where the vocabulary cannot spell it."""
        edges, link, pops, inner = self.edges, self.link, self.pops, self.inner
        node, total = self.root, 0
        for char in word:
            while (child := edges.get((node, char))) is None:
                if link[node] == _NONE:
                    return 0
                total += pops[node]
                node = link[node]
            node = child
        while node != inner:
            if link[node] == _NONE:
                return 0
            total += pops[node]
            node = link[node]
        return total


@cache
def word_pattern(last: int = sys.maxunicode) -> re.Pattern:
    """Runs without white space or punctuation, or single punctuation characters, of texts up to a code point.

    Patterns of all code points test the ones beyond 16 bits range by range, so shorter ones pay off.
    """
    chars = map(chr, range(last + 1))
    punctuation = [c for c in chars if 33 <= ord(c) <= 47 or 58 <= ord(c) <= 64 or 91 <= ord(c) <= 96 or 123 <= ord(c) <= 126 or unicodedata.category(c)[0] == "P"]
    inside = "".join(map(re.escape, punctuation))
    space = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000" if last > 127 else "\\t-\\r "
    return re.compile(f"[^{space}{inside}]+|[{inside}]")


def words_of(text: bytes | None) -> list[str]:
    """Words of a UTF-8 text: white space parts them, each punctuation character is one of its own."""
    if not text:
        return []
    last = 127 if text.isascii() else sys.maxunicode if any(b in text for b in _FOUR_BYTES) else 0xFFFF
    return word_pattern(last).findall(text.decode("utf-8", "replace"))


def _counts(digest: str, starts: list[str], rest: list[str]) -> Remembered:
    """Pieces of each word, and 1 << 32 more for one that cannot be spelled."""

    def make() -> Remembered:
        count = LongestMatch(starts, rest).count
        return Remembered(lambda word: count(word) or 1 + (1 << 32), 400_000)

    return held("counts", digest, make)


def count_tokens(docs: DataFrame, model: SentencePieceModel) -> DataFrame:
    """Token counts of every whole text.

    Returns ``doc_id, n_words, n_tokens, n_unknown``, one row for each input row. White space separates
    words and each punctuation character is a word of its own. A word that the vocabulary cannot spell
    counts as one token and as unknown. Null and empty texts have zeros, a null id stays null, repeated
    rows repeat; columns other than doc_id and text are ignored. A word of any length takes time linear
    in its length.
    """
    starts, rest = word_piece_vocabulary(model)
    digest = model.digest

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = _counts(digest, starts, rest)
        words, tokens, unknown = [], [], []
        for text in utf8(batch, "text"):
            found = words_of(text)
            packed = sum(map(counts.__getitem__, found))
            words.append(len(found))
            tokens.append(packed & 0xFFFFFFFF)
            unknown.append(packed >> 32)
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return in_batches(docs.select("doc_id", "text"), step, SCHEMA)
