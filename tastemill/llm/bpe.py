"""Byte-level BPE ids of whole texts through the tokenizers library, one lookup per repeated piece.

The pre-tokenizer of such a vocabulary never joins what stands on the two sides of a space that
follows a non-space, and its pattern does not look back. So a text may be cut at those places and
each piece encoded alone; equal pieces are encoded once per worker while the cache holds them. A cut between
another white-space character and a space is as good where no token of the vocabulary holds the two side by side; texts
with a character for which one does are not cut there.
A piece that is a space and letters is one pre-token and goes to the BPE model directly.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable

import numpy as np

from tastemill.llm.common import worker_cache

#: Pieces in one of the two generations of a worker's cache.
CACHE_PIECES = 600_000
_CUT = re.compile(r"(?<=\S)(?= )")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Pieces(dict):
    """Ids of pieces (without the space before them), encoded when first met."""

    def __init__(self, encoder: PieceEncoder) -> None:
        self.encoder = encoder
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encoder.fresh(piece)
        self[piece] = ids
        return ids


class PieceEncoder:
    """Encodes texts to ids; the file must be a byte-level BPE without a normalizer."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.kind = np.dtype("<u2") if small else np.dtype("<u4")
        self.code = "H" if small else "I"
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.space = self.letters[32]
        joined = {t[k - 1] for t in self.tokenizer.get_vocab(False) for k in range(1, len(t)) if t[k] == self.space}
        white = (chr(c) for c in range(33, 0x3001) if chr(c).isspace())
        white = [*map(chr, range(9, 14)), *map(chr, range(28, 32)), *white]
        #: White space that some token joins with a space behind it.
        self.mixed = [w for w in white if self.letters[w.encode()[-1]] in joined]
        self.pieces = _Pieces(self)

    @classmethod
    def of_worker(cls, path: str) -> PieceEncoder:
        held = worker_cache("piece encoders")
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def direct(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def fresh(self, piece: str) -> bytes:
        if piece.isalpha():
            mapped = self.space + piece.encode().decode("latin-1").translate(self.letters)
            return array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()
        if piece[-1:] in (".", ",", ":", ";", "!", "?") and piece[:-1].isalpha():
            # The pattern parts letters from a sign after them.
            return self.pieces[piece[:-1]] + self._sign(piece[-1])
        return self.direct(" " + piece)

    def _sign(self, sign: str) -> bytes:
        signs = worker_cache(f"signs {id(self)}")
        if sign not in signs:
            signs[sign] = self.direct(sign)
        return signs[sign]

    def _one(self, text: str) -> bytes:
        if "  " not in text and not any(w in text for w in self.mixed):
            head, *rest = text.split(" ")
            return (self.direct(head) if head else b"") + b"".join(map(self.pieces.__getitem__, rest))
        return b"".join(
            self.pieces[p[1:]] if p[:1] == " " and p[1:2].strip() else self.direct(p) for p in _CUT.split(text)
        )

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian numbers of ``self.kind``."""
        if len(self.pieces) > CACHE_PIECES:
            kept = dict(self.pieces)
            self.pieces = _Pieces(self)
            self.pieces.old = kept
        return [self._one(t) for t in texts]
