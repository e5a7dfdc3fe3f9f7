"""SentencePiece encoding as a max-plus parallel scan, and decoding.

A segmentation is a path in the lattice of pieces. Its weight is the sum of the pieces' scores for a
unigram model; for a BPE model it is 0 where every two neighbouring pieces are ones that BPE itself
leaves side by side, else minus infinity. (A sequence of pieces is BPE's own encoding exactly if each
neighbouring pair is, so the one path of weight 0 is that encoding.)

A giant text is cut into chunks at fixed places. The states at a boundary are the pieces that reach or
straddle it; each chunk yields the max-plus matrix between its boundary states, matrices combine
associatively in a tree, the tree then gives every boundary its state, and each chunk is traced back by
itself.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.llm.common import Remembered, held, in_arrow, in_batches, saved
from tessera.llm.spm_model import BPE, BYTE, CONTROL, NORMAL, SPACE, UNKNOWN, SentencePieceModel

CHUNK = 16_384
GIANT = 65_536
PAIRS = 250_000
_LOW = float("-inf")
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Lattice:
    """Paths of pieces through a text, with the caches that a worker keeps."""

    def __init__(self, model: SentencePieceModel, memory: int = 1):
        self.bpe = model.kind == BPE
        self.dummy = model.dummy_prefix
        self.ids = {t: i for i, (t, _, kind) in enumerate(model.pieces) if kind == NORMAL}
        self.rank = {t: s for t, s, kind in model.pieces if kind == NORMAL}
        self.longest = max(map(len, self.ids), default=1)
        self.starts = {t[:n] for t in self.ids for n in range(1, len(t) + 1)}
        #: Neighbouring characters inside some piece; between any others every path has a boundary.
        self.inside = {t[i : i + 2] for t in self.ids for i in range(len(t) - 1)}
        self.unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), 0)
        bytes_of = {int(t[3:5], 16): i for i, (t, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.bytes_of = bytes_of if len(bytes_of) == 256 else None
        self.unknown_score = min(self.rank.values(), default=0.0) - 10.0
        self.by_word = all(p[1] != SPACE or p[0] == SPACE for p in self.inside)
        #: Whether two pieces may stand side by side, by their numbers; see ``fits``.
        self.pairs: dict[int, bool] = {}
        #: Ids (as bytes of 32-bit numbers) and weight of the best path over a stretch without a cut inside; ids
        #: of a word with its space mark, and of one without (which is the shorter key). ``memory`` multiplies how many are kept.
        self.atoms = Remembered(self._atom, 60_000 * memory)
        self.words = Remembered(self._word, 30_000 * memory)
        self.plain = Remembered(lambda word: self._word(SPACE + word), 80_000 * memory)
        #: Pieces that merges reach at all; some BPE vocabularies hold others.
        self.good = {piece for piece in self.ids if not self.bpe or self._merged(piece) == [piece]}

    # Weights

    def weight(self, piece: str) -> float:
        """The piece's own weight; a single character that is no piece counts as unknown."""
        return 0.0 if self.bpe else self.rank.get(piece, self.unknown_score)

    def _merged(self, text: str) -> list[str]:
        """BPE by its definition: merge the best neighbours, the leftmost among equals, until none can be."""
        parts = list(text)
        while True:
            best = max(((self.rank[x], -i) for i in range(len(parts) - 1) if (x := parts[i] + parts[i + 1]) in self.rank), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def fits(self, left: str | None, right: str) -> bool:
        """Whether ``right`` may follow ``left``."""
        if not self.bpe or left is None or left[-1] + right[0] not in self.inside:
            return True
        key = self.ids[left] << 32 | self.ids[right] if left in self.ids and right in self.ids else -1
        if (known := self.pairs.get(key)) is None:
            known = left + right not in self.rank and self._merged(left + right) == [left, right]
            if key >= 0:
                if len(self.pairs) >= PAIRS:
                    self.pairs.clear()
                self.pairs[key] = known
        return known

    def _allowed(self, left: str | None, piece: str) -> bool:
        """Whether a vocabulary's piece may follow; for BPE it must be one that merges reach at all."""
        return not self.bpe or (piece in self.good and self.fits(left, piece))

    # Paths

    def best(self, text: str, start: int, stop: int, before: str | None = None) -> tuple[list[float], list[int]]:
        """Best weight of a path from ``start`` to each position up to ``stop``, and its last piece's start."""
        score, back = [_LOW] * (stop + 1), [-1] * (stop + 1)
        score[start] = 0.0
        ids, starts = self.ids, self.starts
        for i in range(start, stop):
            if score[i] == _LOW:
                continue
            left = before if i == start else text[back[i] : i]
            for j in range(i + 1, min(stop, i + self.longest) + 1):
                piece = text[i:j]
                if piece in ids:
                    if not self._allowed(left, piece):
                        continue
                elif j > i + 1:
                    if piece not in starts:
                        break
                    continue
                if (s := score[i] + self.weight(piece)) > score[j]:
                    score[j], back[j] = s, i
                if piece not in starts:
                    break
        return score, back

    def trace(self, text: str, back: list[int], start: int, end: int) -> list[str]:
        pieces = []
        while end > start:
            pieces.append(text[back[end] : end])
            end = back[end]
        return pieces[::-1]

    def number(self, pieces: list[str]) -> list[int]:
        """Ids of pieces; an unknown character becomes its bytes, or a run of them one unknown id."""
        out: list[int] = []
        fresh = True
        for piece in pieces:
            if (known := self.ids.get(piece)) is not None:
                out.append(known)
            elif self.bytes_of:
                out.extend(self.bytes_of[b] for b in piece.encode("utf-8", "replace"))
            elif fresh:
                out.append(self.unknown)
            fresh = known is not None
        return out

    def cuts(self, text: str) -> list[int]:
        """Positions that no piece straddles, with both ends."""
        inside = self.inside
        return [0, *(i for i in range(1, len(text)) if text[i - 1 : i + 1] not in inside), len(text)]

    def _only(self, text: str) -> list[str]:
        """The one path of weight 0 of a BPE model over a stretch without a cut: long pieces first, no state twice."""
        good, starts, fits, end = self.good, self.starts, self.fits, len(text)
        ids, pairs = self.ids, self.pairs
        path: list[str] = []
        waiting: list[list[str]] = []
        dead: set[tuple[int, str]] = set()
        at, left = 0, ""
        while at < end:
            options, stop = [text[at]], at + 2
            while stop <= end and (piece := text[at:stop]) in starts:
                if piece in good:
                    options.append(piece)
                stop += 1
            while True:
                first = ids.get(left, -1) << 32
                while options:
                    piece = options.pop()
                    allowed = not left or pairs.get(first | ids.get(piece, -1))
                    if allowed is None:
                        allowed = fits(left, piece)
                    if allowed and not (dead and (at + len(piece), piece) in dead):
                        break
                else:
                    # Nothing fits here: this state leads nowhere, so go back to the one before.
                    dead.add((at, left))
                    at -= len(path.pop())
                    left, options = path[-1] if path else "", waiting.pop()
                    continue
                break
            path.append(piece)
            waiting.append(options)
            at, left = at + len(piece), piece
        return path

    def _atom(self, text: str) -> tuple[bytes, float]:
        if self.bpe:
            return array("i", self.number(self._only(text))).tobytes(), 0.0
        score, back = self.best(text, 0, len(text))
        return array("i", self.number(self.trace(text, back, 0, len(text)))).tobytes(), score[-1]

    def _word(self, text: str) -> bytes:
        inside, atoms, out, begin = self.inside, self.atoms, b"", 0
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in inside:
                out += atoms[text[begin:i]][0]
                begin = i
        return out + atoms[text[begin:]][0]

    def normal(self, text: str, first: bool = True) -> str:
        return (SPACE if first and self.dummy and text else "") + text.replace(" ", SPACE)

    def encoded(self, text: str) -> bytes:
        """Ids of a text in one piece, as bytes of 32-bit numbers."""
        if not text:
            return b""
        if self.by_word and self.dummy and SPACE not in text and "" not in (words := text.split(" ")):
            return b"".join(map(self.plain.__getitem__, words))
        text = self.normal(text)
        return b"".join(map(self.words.__getitem__, _WORD.findall(text) if self.by_word else [text]))

    def encode(self, text: str) -> list[int]:
        """Ids of a text in one piece."""
        return np.frombuffer(self.encoded(text), np.int32).tolist()

    # Chunks

    def states(self, text: str, at: int, end: int) -> list[tuple[int, int]]:
        """Pieces (start, stop) with start < at <= stop; ``end`` is where the text at hand stops."""
        found = []
        for a in range(max(0, at - self.longest), at):
            found += [(a, b) for b in range(at, min(end, a + self.longest) + 1) if text[a:b] in self.ids or b == a + 1]
        return found

    def _border(self, text: str, p: int, q: int) -> tuple[int, int] | None:
        """First and last position from p to before q that no piece straddles, if there are any."""
        free = lambda i: i in (0, len(text)) or text[i - 1 : i + 1] not in self.inside
        first = next((i for i in range(p, q) if free(i)), None)
        return None if first is None else (first, next(i for i in range(q - 1, p - 1, -1) if free(i)))

    def _middle(self, text: str) -> tuple[list[int], float]:
        at = self.cuts(text)
        parts = [self.atoms[text[a:b]] for a, b in zip(at, at[1:]) if b > a]
        return np.frombuffer(b"".join(ids for ids, _ in parts), np.int32).tolist(), sum(w for _, w in parts)

    def _into(self, text: str, score: list[float], back: list[int], start: int, before: str | None, state: tuple[int, int]) -> float:
        """Weight of the best path that has reached ``state``'s start and then takes its piece."""
        c, d = state
        if c < start or c >= len(score) or score[c] == _LOW:
            return _LOW
        left = before if c == start else text[back[c] : c]
        piece = text[c:d]
        known = piece in self.ids
        if known and not self._allowed(left, piece):
            return _LOW
        return score[c] + self.weight(piece)

    def transfer(self, text: str, p: int, q: int, first: bool) -> np.ndarray:
        """Max-plus matrix from the states at ``p`` (a single one at a text's start) to those at ``q``."""
        entries = [None] if first else self.states(text, p, len(text))
        exits = self.states(text, q, len(text))
        out = np.full((len(entries), len(exits)), _LOW)
        border = self._border(text, p, q)
        if border:
            middle = self._middle(text[border[0] : border[1]])[1]
            score, back = self.best(text, border[1], q)
            tail = np.array([self._into(text, score, back, border[1], None, f) for f in exits])
        for n, e in enumerate(entries):
            at, before = (p, None) if e is None else (e[1], text[e[0] : e[1]])
            if border:
                if at <= border[0]:
                    head = self.best(text, at, border[0], before)[0][border[0]]
                    out[n] = head + middle + tail
                continue
            score, back = self.best(text, at, max(q, at), before)
            out[n] = [0.0 if e == f else self._into(text, score, back, at, before, f) for f in exits]
        return out

    def traced(self, text: str, p: int, q: int, first: bool, entry: int, leave: int) -> list[int]:
        """Ids of the chunk's pieces on the best path between two of its boundary states."""
        e = None if first else self.states(text, p, len(text))[entry]
        c, d = self.states(text, q, len(text))[leave]
        at, before = (p, None) if e is None else (e[1], text[e[0] : e[1]])
        border = self._border(text, p, q)
        if not border:
            if e == (c, d):
                return []
            _, back = self.best(text, at, c, before)
            return self.number([*self.trace(text, back, at, c), text[c:d]])
        _, back = self.best(text, at, border[0], before)
        head = self.number(self.trace(text, back, at, border[0]))
        _, back = self.best(text, border[1], c)
        return [*head, *self._middle(text[border[0] : border[1]])[0], *self.number([*self.trace(text, back, border[1], c), text[c:d]])]


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1) if a.shape[1] else np.full((a.shape[0], b.shape[1]), _LOW)


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """The best path's state after each chunk, from a tree of associative products."""
    levels = [matrices]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([combined(low[i], low[i + 1]) if i + 1 < len(low) else low[i] for i in range(0, len(low), 2)])
    states = {0: 0, len(matrices): int(levels[-1][0][0].argmax())}
    for level in range(len(levels) - 2, -1, -1):
        span = 1 << level
        for i in range(0, len(levels[level]) - 1, 2):
            a, b = levels[level][i], levels[level][i + 1]
            left, right = i * span, min((i + 2) * span, len(matrices))
            states[left + span] = int((a[states[left]] + b[:, states[right]]).argmax())
    return [states[k] for k in range(1, len(matrices) + 1)]


def lattice(model: SentencePieceModel, memory: int = 1) -> Lattice:
    return held("lattice", (model.digest or id(model), memory), lambda: Lattice(model, memory))


def _ids(rows: list[bytes]) -> pa.Array:
    """Lists of ids from bytes of 32-bit numbers."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def _is_long(giant: int):
    return F.coalesce(F.length("text"), F.lit(0)) > giant


def _whole(docs: DataFrame, model: SentencePieceModel, memory: int) -> DataFrame:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = lattice(model, memory).encoded
        ids = _ids([encode(t or "") for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), ids], names=["doc_id", "text", "ids"])

    return in_batches(docs, step, "doc_id bigint, text string, ids array<int>")


def _chunked(docs: DataFrame, model: SentencePieceModel, chunk: int, memory: int) -> DataFrame:
    reach = max(map(len, model.texts()), default=1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "k", "p", "q", "part"]
        for batch in batches:
            for row, doc, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                rows = []
                for k, p in enumerate(range(0, len(text), chunk)):
                    q, left = min(len(text), p + chunk), max(0, p - reach)
                    rows.append((row, doc, k, p - left, q - left, text[left : q + reach]))
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    chunks = saved(in_arrow(numbered, cut, "row bigint, doc_id bigint, k int, p int, q int, part string"))
    spread = chunks.repartition("row", "k")

    def prepared(part: str, k: int, p: int, q: int) -> tuple[Lattice, str, int, int, bool]:
        held = lattice(model, memory)
        text = held.normal(part, k == 0)
        grown = len(text) - len(part)
        return held, text, p + grown * (k > 0), q + grown, k == 0

    def transfer(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for k, p, q, part in zip(*(batch.column(c).to_pylist() for c in ("k", "p", "q", "part"))):
            held, text, p, q, first = prepared(part, k, p, q)
            found.append(held.transfer(text, p, q, first))
        shape = pa.array([m.shape[0] for m in found], pa.int32())
        flat = pa.array([m.ravel().tolist() for m in found], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column("row"), batch.column("k"), shape, flat], names=["row", "k", "entries", "matrix"])

    def scan(group):
        import pandas as pd  # not for the workers that only encode

        group = group.sort_values("k", ignore_index=True)
        states = boundary_states([np.asarray(m).reshape(n, -1) for n, m in zip(group.entries, group.matrix)])
        return pd.DataFrame({"row": group.row, "k": group.k, "entry": [0, *states[:-1]], "leave": states})

    def trace(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, core = [], []
        for k, p, q, part, entry, leave in zip(*(batch.column(c).to_pylist() for c in ("k", "p", "q", "part", "entry", "leave"))):
            core.append(part[p:q])
            held, text, p, q, first = prepared(part, k, p, q)
            found.append(array("i", held.traced(text, p, q, first, entry, leave)).tobytes())
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "doc_id", "k")), pa.array(core, pa.string()), _ids(found)], names=["row", "doc_id", "k", "part", "ids"])

    matrices = in_batches(spread.select("row", "k", "p", "q", "part"), transfer, "row bigint, k int, entries int, matrix array<double>")
    states = matrices.groupBy("row").applyInPandas(scan, "row bigint, k int, entry int, leave int")
    pieces = in_batches(chunks.join(states, ["row", "k"]), trace, "row bigint, doc_id bigint, k int, part string, ids array<int>")
    ordered = pieces.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("k", "part", "ids"))).alias("all"))
    return ordered.select("doc_id", F.array_join("all.part", "").alias("text"), F.flatten("all.ids").alias("ids"))


def encode(docs: DataFrame, model: SentencePieceModel, chunk: int = CHUNK, giant: int = GIANT, memory: int = 1) -> DataFrame:
    """Piece ids of every whole text: ``doc_id, text, ids``, one row for each input row.

    Texts of over ``giant`` characters go through the scan, others through one lattice; both give the ids of the
    model's own encoder. Null and empty texts get no ids, null ids and repeated rows stay as they are,
    columns other than doc_id and text are ignored. Characters that are no piece become byte pieces, or
    a run of them one unknown piece where the model has no byte pieces. ``memory`` is how much a worker keeps of
    what it has encoded, some 45 MB for each unit; results are the same at any.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _whole(docs.where(~_is_long(giant)), model, memory).unionByName(_chunked(docs.where(_is_long(giant)), model, chunk, memory))


class Decoder:
    """Texts of ids: pieces with spaces for their marks, runs of byte pieces as UTF-8."""

    def __init__(self, model: SentencePieceModel):
        values = {i: int(t[3:5], 16) for i, (t, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.texts = ["" if kind in (CONTROL, BYTE) else " ⁇ " if kind == UNKNOWN else text for text, _, kind in model.pieces]
        # A byte below 128 is a character by itself; only the others have to be put together.
        for i, value in values.items():
            if value < 128:
                self.texts[i] = chr(value)
        self.values = {i: value for i, value in values.items() if value >= 128}
        self.dummy = model.dummy_prefix

    def text(self, ids: list[int]) -> str:
        texts, values = self.texts, self.values
        if values.keys().isdisjoint(ids):
            out = "".join(map(texts.__getitem__, ids))
        else:
            parts, run = [], bytearray()
            for i in ids:
                if i in values:
                    run.append(values[i])
                    continue
                if run:
                    parts.append(run.decode("utf-8", "replace"))
                    run = bytearray()
                parts.append(texts[i])
            parts.append(run.decode("utf-8", "replace"))
            out = "".join(parts)
        out = out.replace(SPACE, " ")
        return out[1:] if self.dummy and out.startswith(" ") else out


def decode(encoded: DataFrame, model: SentencePieceModel) -> DataFrame:
    """Adds ``decoded``: the text of each row's ``ids`` (null where they are null).

    Space marks become spaces and the mark that encoding puts in front goes again; runs of byte pieces
    become characters, and the replacement character where they are no valid UTF-8. Empty ids give the empty
    text. A column ``decoded`` that is there already is replaced; the other columns, repeated rows and null ids stay, and
    an empty table gives an empty one.
    """
    encoded = encoded.drop("decoded")
    names = encoded.columns

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        text_of = Decoder(model).text
        column = batch.column(names.index("ids"))
        offsets = column.offsets.to_numpy()
        flat = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False).tolist()
        offsets = (offsets - offsets[0]).tolist()
        decoded = [None if null else text_of(flat[a:b]) for null, a, b in zip(column.is_null().to_pylist(), offsets, offsets[1:])]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], names=[*names, "decoded"])

    return in_batches(encoded, step, StructType([*encoded.schema.fields, StructField("decoded", StringType())]))


def round_trip(docs: DataFrame, model: SentencePieceModel, chunk: int = CHUNK, giant: int = GIANT, memory: int = 1) -> DataFrame:
    """``encode`` and ``decode`` of every whole text: ``doc_id, ids, n_decoded, round_trip``.

    ``n_decoded`` counts the characters of the decoded text, and ``round_trip`` holds where it equals the
    text (an empty one, if null). Texts that are not giant take both ways in one pass.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    names = ["doc_id", "ids", "n_decoded", "round_trip"]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode, text_of = lattice(model, memory).encoded, Decoder(model).text
        texts = [t or "" for t in batch.column("text").to_pylist()]
        ids = [encode(t) for t in texts]
        decoded = [text_of(np.frombuffer(x, np.int32).tolist()) for x in ids]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), _ids(ids), pa.array(list(map(len, decoded)), pa.int64()), pa.array([a == b for a, b in zip(texts, decoded)])], names=names)

    whole = in_batches(docs.where(~_is_long(giant)), step, "doc_id bigint, ids array<int>, n_decoded bigint, round_trip boolean", 500)
    long = decode(_chunked(docs.where(_is_long(giant)), model, chunk, memory), model)
    return whole.unionByName(long.select("doc_id", "ids", F.length("decoded").cast("bigint").alias("n_decoded"), (F.col("text") == F.col("decoded")).alias("round_trip")))
