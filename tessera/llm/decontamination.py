"""Benchmark decontamination with a generalised suffix automaton of normalised test items.

The automaton holds every run of consecutive words of the items. A document's words stream through it;
after each word it knows the longest run of item words that ends there. Where that run is at least a
window long (or is a whole short item), the window's words are hit.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StructField, StructType

from tessera.llm.common import dropped, held, in_batches, saved, utf8

WINDOW = 10
BLOCK_BYTES = 1_000_000
SCHEMA = "doc_id bigint, n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:int,stop:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_FOUND = pa.struct([("spans", _SPANS), ("items", pa.list_(pa.string()))])
_KEEP = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-case words of ASCII letters and digits and of all characters beyond ASCII."""
    return text.translate(_KEEP).split() if text else []


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the items that own each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for name, words in items:
            numbers = [self.numbers.setdefault(w, len(self.numbers)) for w in words]
            sequences.append((name, numbers))
            last = 0
            for number in numbers:
                last = self._extended(last, number)
        self.depth_first = self._ancestors()
        #: Items by the state of a window, and by length and state of short items.
        self.owners: dict[int, set[str]] = defaultdict(set)
        self.short: dict[int, list[tuple[int, set[str]]]] = {}
        whole: dict[tuple[int, int], set[str]] = defaultdict(set)
        for name, numbers in sequences:
            state = length = 0
            for number in numbers:
                state, length = self._step(state, length, number)
                if length >= window:
                    self.owners[self.depth_first[state]].add(name)
            if 0 < len(numbers) < window:
                whole[state, len(numbers)].add(name)
        exact: dict[int, list[tuple[int, set[str]]]] = defaultdict(list)
        for (state, size), names in whole.items():
            exact[state].append((size, names))
        if exact:
            for state in sorted(range(len(self.length)), key=self.length.__getitem__):
                above = self.short.get(self.link[state], []) if state else []
                if mine := [*above, *exact.get(state, ())]:
                    self.short[state] = mine

    def _extended(self, last: int, number: int) -> int:
        """Add one word after ``last``; states that other items made are reused."""
        if (known := self.next[last].get(number)) is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._cloned(last, number, known)
        state = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at != -1 and number not in self.next[at]:
            self.next[at][number] = state
            at = self.link[at]
        if at != -1:
            known = self.next[at][number]
            self.link[state] = known if self.length[known] == self.length[at] + 1 else self._cloned(at, number, known)
        return state

    def _cloned(self, at: int, number: int, known: int) -> int:
        clone = self._state(self.length[at] + 1, dict(self.next[known]), self.link[known])
        self.link[known] = clone
        while at != -1 and self.next[at].get(number) == known:
            self.next[at][number] = clone
            at = self.link[at]
        return clone

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _ancestors(self) -> list[int]:
        """For each state the state of its last ``window`` words (-1 where it is shorter)."""
        found = [-1] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            if self.length[state] >= self.window:
                above = self.link[state]
                found[state] = state if self.length[above] < self.window else found[above]
        return found

    def _step(self, state: int, length: int, number: int) -> tuple[int, int]:
        while state and number not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if (following := self.next[state].get(number)) is None:
            return 0, 0
        return following, length + 1

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint spans of hit words, in order, and the items with occurring windows."""
        spans: list[list[int]] = []
        items: set[str] = set()
        following, link, length_of, window = self.next, self.link, self.length, self.window
        owner, short, owners = self.depth_first, self.short, self.owners
        state = length = 0
        for i, number in enumerate(map(self.numbers.get, words)):
            edges = following[state]
            if number not in edges:
                if number is None:
                    state = length = 0
                    continue
                while state and number not in following[state]:
                    state = link[state]
                length = length_of[state]
                edges = following[state]
            state = edges.get(number, 0)
            length = length + 1 if state else 0
            size = 0
            if length >= window:
                size = window
                items |= owners[owner[state]]
            if state in short:
                for n, names in short[state]:
                    if n <= length:
                        size = max(size, n)
                        items |= names
            if size:
                start = i + 1 - size
                if spans and start <= spans[-1][1]:
                    # Short windows may begin before the last span does.
                    while spans and start <= spans[-1][0] and len(spans) > 1 and start <= spans[-2][1]:
                        spans.pop()
                    spans[-1] = [min(start, spans[-1][0]), i + 1]
                else:
                    spans.append([start, i + 1])
        return [(a, b) for a, b in spans], items


def _automaton(key: str, items: list[tuple[str, bytes]], window: int) -> ItemAutomaton:
    """Built once in each Python worker from the items' texts."""
    return held("items", key, lambda: ItemAutomaton([(name, words_of(text)) for name, text in items], window))


def _blocks(benchmark: DataFrame, most: int) -> Iterator[tuple[bool, list[tuple[str, bytes]]]]:
    """Whether it is the last, and items of about ``most`` bytes of text: one block after another, so the driver holds one."""
    items = benchmark.where(F.length("text") > 0).select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-size // most))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()
        yield k == n - 1, sorted((r["item"], r["text"].encode()) for r in rows)


def _merged(rows: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(rows):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _streamed(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int, result: Callable, schema) -> DataFrame:
    """The words of ``docs`` through the automaton of every block of items.

    A pass over the documents takes one block. Between passes the documents are a table with what was found
    so far, and the last block's broadcast is gone, so memory is that of one block at any size of the
    benchmark. ``result`` makes a batch of rows from a batch of ``docs``, its words, spans and items.
    """
    names = docs.columns
    state = "found"
    while state in map(str.lower, names):
        state += "_"
    frame, before = docs, None
    for last, block in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)  # block_bytes
        key = hashlib.sha256(repr(block).encode()).hexdigest() + f":{window}"

        def step(batch: pa.RecordBatch, shared=shared, key=key, last=last, first=before is None) -> pa.RecordBatch:
            words = [words_of(t) for t in utf8(batch, "text")]
            automaton = _automaton(key, shared.value, window)
            spans, items = map(list, zip(*map(automaton.hits, words)))
            if not first:
                for i, old in enumerate(batch.column(state).to_pylist()):
                    spans[i] = _merged(spans[i] + [(s["start"], s["stop"]) for s in old["spans"]])
                    items[i] |= set(old["items"])
            batch = batch.select(names)
            if last:
                return result(batch, words, spans, items)
            found = [{"spans": _structs(s), "items": sorted(x)} for s, x in zip(spans, items)]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _FOUND)], names=[*names, state])

        if last:
            return in_batches(frame, step, schema)
        frame = saved(in_batches(frame, step, StructType([*docs.schema.fields, StructField(state, from_arrow_type(_FOUND))])))
        shared.destroy()
        if before is not None:
            dropped(before)
        before = frame


def _structs(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": a, "stop": b} for a, b in spans]


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Words of every document that lie in a window of some test item.

    Returns ``doc_id, n_words, n_hit, items`` (sorted) and ``spans`` (of words, end exclusive), one row for
    each input row. A window is ``window`` consecutive words of an item, or all words of a shorter one.
    Null and empty texts have no words, null items none either; a null item id counts as ``null``, items
    that share an id as one. Repeated rows repeat, other columns are ignored. Test items come in blocks of
    bounded size, each a pass over the documents; a benchmark of one block takes one pass.
    """

    def result(batch: pa.RecordBatch, words: list, spans: list, items: list) -> pa.RecordBatch:
        columns = [batch.column("doc_id").cast(pa.int64()), pa.array(list(map(len, words)), pa.int64()), pa.array([sum(b - a for a, b in s) for s in spans], pa.int64())]
        columns += [pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(list(map(_structs, spans)), _SPANS)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_hit", "items", "spans"])

    return _streamed(docs.select("doc_id", "text"), benchmark, window, block_bytes, result, SCHEMA)


def _cut(text: bytes | None, words: list[bytes], spans: list[tuple[int, int]]) -> bytes | None:
    """``text`` without the spans of its words."""
    if not spans:
        return text
    flat, places, end = text.translate(_KEEP), [], 0
    for word in words:
        begin = flat.index(word, end)
        end = begin + len(word)
        places.append((begin, end))
    parts, last = [], 0
    for a, b in spans:
        parts.append(text[last : places[a][0]])
        last = places[b - 1][1]
    return b"".join([*parts, text[last:]])


def decontaminated(docs: DataFrame, benchmark: DataFrame, most_share: float = 0.5, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the hit words; documents hit over more than ``most_share`` of their words go.

    A span goes from the first byte of its first word to the last of its last; what remains is left as it
    was. Documents without a hit stay unchanged, null and empty texts and null ids too; repeated rows go or
    stay alike. Texts of any length are taken whole. All columns are kept, whatever their names; empty tables
    of documents or items change nothing.
    """
    at = docs.columns.index("text")

    def result(batch: pa.RecordBatch, words: list, spans: list, items: list) -> pa.RecordBatch:
        keep = [not s or sum(b - a for a, b in s) <= most_share * len(w) for w, s in zip(words, spans)]
        texts = [_cut(t, w, s) if k else t for t, w, s, k in zip(utf8(batch, "text"), words, spans, keep)]
        columns = list(batch.columns)
        columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(pa.array(keep))

    return _streamed(docs, benchmark, window, block_bytes, result, docs.schema)
