"""Ids by the tokenizers library, each chunk between white space encoded once while it is remembered."""

from __future__ import annotations

import re

import numpy as np

from loadwitness.llm.bpe_automaton import byte_symbols
from loadwitness.llm.common import chunks_of

# Chunks up to this length are remembered, so many at a time (a bound on a worker's memory, not on its work).
KEPT_LENGTH, KEPT = 64, 600_000

# Composed Latin letters and marks after them: a word of its own, then one of marks. The long s and dotted capital I are
# left out, as they change into other letters.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e]+)([.,;:!?]*)")

_WORKERS: dict[str, ChunkIds] = {}


class ChunkIds(dict):
    """Ids of a chunk as little-endian unsigned 32-bit integers.

    The tokenizer's pattern never crosses white space, and neither do its normalisers, so the ids of a text are those of
    its chunks in order.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.symbols = dict(enumerate(byte_symbols()))

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self._chunk(chunk)
        if len(chunk) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk)
        if plain:
            return self._word(plain[1].lower()) + (self[plain[2]] if plain[2] else b"")
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of letters in lower case by the tokenizer's model alone, as its normalisers leave them as they are."""
        ids = self.words.get(word)
        if ids is None:
            symbols = word if word.isascii() else word.encode().decode("latin-1").translate(self.symbols)
            ids = np.array([t.id for t in self.model.tokenize(symbols)], "<u4").tobytes()
            if len(word) <= KEPT_LENGTH:
                if len(self.words) >= KEPT:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, chunks_of(text))) if text else b""


def worker_encoder(path: str) -> ChunkIds:
    """The encoder of this Python worker; it lives as long as the worker."""
    if path not in _WORKERS:
        _WORKERS[path] = ChunkIds(path)
    return _WORKERS[path]
