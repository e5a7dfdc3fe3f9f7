"""Reader of SentencePiece model files: pieces, scores, kinds and the few settings that matter here."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffers message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {5: 4, 1: 8}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass(frozen=True)
class SentencePieceModel:
    """Pieces as (text, score, kind), in the order of their ids."""

    pieces: tuple[tuple[str, float, int], ...]
    kind: int = UNIGRAM
    dummy_prefix: bool = True
    digest: str = field(default="", compare=False)

    @classmethod
    def load(cls, path: str) -> SentencePieceModel:
        """Read on the driver; the pieces then travel with the tasks (a vocabulary's size bounds them)."""
        return cls.parse(Path(path).read_bytes())

    @classmethod
    def parse(cls, data: bytes) -> SentencePieceModel:
        pieces, kind, dummy, extra, charsmap = [], UNIGRAM, True, True, b""
        for number, value in _fields(data):
            if number == 1:
                text, score, what = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        text = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        what = v
                pieces.append((text, score, what))
            elif number == 2:
                kind = next((v for n, v in _fields(value) if n == 3), UNIGRAM)
            elif number == 3:
                for n, v in _fields(value):
                    if n == 2:
                        charsmap = v
                    elif n == 3:
                        dummy = bool(v)
                    elif n == 4:
                        extra = bool(v)
        if charsmap or extra:
            raise ValueError("only models with the identity normaliser and kept white space are supported")
        if kind not in (UNIGRAM, BPE) or any(p[2] == USER for p in pieces):
            raise ValueError("only unigram and BPE models without user-defined symbols are supported")
        return cls(tuple(pieces), kind, dummy, hashlib.sha256(data).hexdigest())

    def texts(self) -> list[str]:
        """Texts of the ordinary pieces."""
        return [text for text, _, kind in self.pieces if kind == NORMAL]
