"""Sets of word shingles of whole texts, computed over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

U = np.uint64
_STEP, _FINAL1, _FINAL2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

# Rows and bytes of text that are hashed at a time.
SLICE_ROWS, SLICE_BYTES = 512, 1 << 21


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> U(30))
    x = x * _FINAL1
    x = x ^ (x >> U(27))
    x = x * _FINAL2
    return x ^ (x >> U(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP | U(1), U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts, words: int) -> list[np.ndarray]:
    """The sorted distinct shingles (64-bit hashes) of each text of an Arrow string array.

    A-Z are lower-cased; words are runs of bytes other than blanks, tabs and line ends; with fewer words than ``words`` the
    whole sequence is the one shingle; null and blank texts have none.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if str(texts.type) == "string" else np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    n_texts = len(texts)
    data = texts.buffers()[2]
    if not n_texts or data is None or offsets[-1] == offsets[0]:
        return [np.array([], U)] * n_texts
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    upper = (raw >= 65) & (raw <= 90)
    raw = raw + upper.astype(np.uint8) * np.uint8(32)
    solid = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    begins = np.zeros(len(raw) + 1, bool)
    begins[offsets] = True
    first = solid & (begins[:-1] | np.append(True, ~solid[:-1]))
    starts = np.flatnonzero(first)
    if not len(starts):
        return [np.array([], U)] * n_texts
    word = np.cumsum(first) - 1
    place = np.arange(len(raw)) - starts[np.maximum(word, 0)]
    power = _powers(int(place[solid].max()) + 1)
    value = np.where(solid, (raw.astype(U) + U(1)) * power[np.where(solid, place, 0)], U(0))
    hashes = mixed(np.add.reduceat(value, starts))
    cuts = np.searchsorted(starts, offsets)
    count = np.diff(cuts)
    owner_end = np.repeat(cuts[1:], count)
    at = np.arange(len(starts))
    total = np.zeros(len(starts), U)
    for k in range(words):
        scale = U(pow(int(_STEP) | 1, 2 * k, 1 << 64))
        inside = at + k < owner_end
        total += np.where(inside, hashes[np.minimum(at + k, len(starts) - 1)], U(0)) * scale
    total = mixed(total)
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        n = b - a
        own = np.sort(total[a : a + max(n - words + 1, min(n, 1))])
        out.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
    return out


def slices(batches: Iterable, column: int) -> Iterator:
    """Record batches cut so that the texts in ``column`` stay small."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        total, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            done = int(total[at - 1]) if at else 0
            n = int(np.searchsorted(total, done + SLICE_BYTES, "right")) - at
            n = max(1, min(n, SLICE_ROWS, batch.num_rows - at))
            yield batch.slice(at, n)
            at += n
