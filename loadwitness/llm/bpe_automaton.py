"""BPE by a tokenization automaton: compile the merges once, encode by table look-ups, decode by emitting arc labels.

The automaton reads tokens. It starts with one state per base symbol in which every symbol may follow, and takes the
merges in order of priority. The gadget of a merge ``u v -> w`` (a) copies the state reached by ``v`` for ``w``, (b) lets
``w`` follow wherever ``u`` could, (c) removes the arc ``v`` from the state reached by ``u``, and for ``u = v`` the arc
``w`` too. What is left accepts exactly the token sequences that the merges produce, one per word. The state that a token
leads to depends on the token alone, so a state is a bit row over the tokens that may follow; equal rows are one state.

A word is a run of byte symbols whose last one carries the word end. Encoding walks the spellings of the tokens from each
position and follows the arc where the state allows it; exactly one token leads to each position.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from struct import pack

import numpy as np
from pyspark.sql import DataFrame

from loadwitness.llm.common import WHITE, chunks_of, in_slices

WORD_END = "</w>"

# Letters and numbers (first, last) and lower-case forms (first, last, distance) of the Unicode versions that
# the tokenizers library follows and Python's tables may not have yet.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
]
NEW_LOWER = [
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20),
    (0x16EA0, 0x16EB8, 0x1B),
]
_LOWER = {c: c + by for first, last, by in NEW_LOWER for c in range(first, last + 1)}


@lru_cache(maxsize=1)
def words_pattern() -> re.Pattern:
    """The pattern that splits words, as the tokenizer file states it, with its classes spelled out."""

    def inside(kind: str, new: list[tuple[int, int]]) -> str:
        codes = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] == kind]
        codes = np.array(sorted({*codes, *(c for a, b in new for c in range(a, b + 1))}))
        cut = np.flatnonzero(np.diff(codes) > 1)
        pairs = zip(codes[np.append(0, cut + 1)], codes[np.append(cut, len(codes) - 1)], strict=True)
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in pairs)

    letters, numbers = inside("L", NEW_LETTERS), inside("N", NEW_NUMBERS)
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{WHITE}{letters}{numbers}]+")


# A spelling is kept for the next texts up to this length; so many chunks and words are kept at a time (a bound on memory,
# not on work).
KEPT_LENGTH, KEPT, KEPT_WORDS = 64, 200_000, 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    shown = set(printable)
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def lowered(text: str) -> str:
    """Lower case character by character; str.lower() would look at the neighbours of a capital sigma."""
    if text.isascii():
        return text.lower()
    lower = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
    return lower.translate(_LOWER)


class Automaton:
    """States as rows of bits (``rows``), the state each token leads to (``state``), spellings (``arcs``), labels."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], added: list[tuple[str, int]]):
        symbols = byte_symbols()
        back = {s: b for b, s in enumerate(symbols)}
        size = max(vocab.values()) + 1
        self.labels: dict[int, str] = {i: t for t, i in vocab.items()} | {i: t for t, i in added}
        self.added = dict(added)
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if added else None

        birth = np.full(size, -1, np.int64)
        left = np.full(size, -1, np.int64)
        depth = np.zeros(size, np.int64)
        base = [vocab[s + e] for s in symbols for e in ("", WORD_END)]
        steps = []
        for rank, (a, b) in enumerate(merges, 1):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if birth[w] < 0 and w not in base:
                birth[w], left[w], depth[w] = rank, u, depth[u] + 1
            steps.append((rank, u, v, w))
        birth[base] = 0
        levels = [np.flatnonzero((depth == d) & (birth > 0)) for d in range(1, int(depth.max(initial=0)) + 1)]

        # granted[t]: the tokens that could follow t when they came to be; cut[t]: when an arc was removed again.
        never = np.iinfo(np.int64).max
        inner = [t for t, i in vocab.items() if birth[i] >= 0 and not t.endswith(WORD_END)]
        order = sorted((vocab[t] for t in inner), key=lambda i: birth[i])
        cuts: dict[int, dict[int, int]] = {}
        doubled: dict[int, list[int]] = {}
        for rank, u, v, w in steps:
            cuts.setdefault(u, {}).setdefault(v, rank)
            if u == v:
                doubled.setdefault(u, []).append(w)
        right = {w: v for _, u, v, w in reversed(steps)}
        granted: dict[int, np.ndarray] = {}
        alive = birth >= 0
        known = np.where(alive, birth, never)
        packed = np.zeros((len(order), (size + 7) // 8), np.uint8)
        when = np.full(size, never, np.int64)
        for row, t in enumerate(order):
            if birth[t] == 0:
                now = birth == 0
            else:
                v = right[t]
                now = np.unpackbits(granted[v], count=size, bitorder="little").astype(bool) & (known < birth[t])
                for s, rank in cuts.get(v, {}).items():
                    if rank < birth[t]:
                        now[s] = False
            own = cuts.get(t, {})
            for s, rank in own.items():
                when[s] = rank
            for level in levels:
                later = level[birth[level] >= max(birth[t], 1)]
                now[later] = now[left[later]] & (when[left[later]] >= birth[later])
                for w in doubled.get(t, ()):
                    now[w] = False
            for s in own:
                when[s] = never
            granted[t] = np.packbits(now, bitorder="little")
            for s in own:
                now[s] = False
            packed[row] = np.packbits(now, bitorder="little")
        states, which = np.unique(packed, axis=0, return_inverse=True)
        start = np.packbits(alive, bitorder="little")
        self.rows = [start.tobytes()] + [r.tobytes() for r in states]
        self.state = {t: int(c) + 1 for t, c in zip(order, which)}
        self.arcs = self._spellings(vocab, alive, back)
        self.root = self._linked(self.arcs)

    @staticmethod
    def _spellings(vocab: dict[str, int], alive: np.ndarray, back: dict[str, int]) -> list[list]:
        """A table of nodes ``[next node by byte, token inside a word, token at its end]``."""
        nodes: list[list] = [[{}, None, None]]
        for text, token in vocab.items():
            if not alive[token]:
                continue
            ends = text.endswith(WORD_END) and len(text) > len(WORD_END)
            at = 0
            for c in text.removesuffix(WORD_END) if ends else text:
                nxt = nodes[at][0].get(back[c])
                if nxt is None:
                    nxt = nodes[at][0][back[c]] = len(nodes)
                    nodes.append([{}, None, None])
                at = nxt
            nodes[at][2 if ends else 1] = token
        return nodes

    def __getstate__(self) -> dict:
        # Linked nodes would be pickled as deep as the longest token.
        return {k: v for k, v in vars(self).items() if k != "root"}

    def __setstate__(self, state: dict) -> None:
        vars(self).update(state)
        self.root = self._linked(self.arcs)

    @staticmethod
    def _linked(arcs: list[list]) -> tuple:
        """The first node; nodes hold the next ones themselves."""
        nodes = [({}, inner, last) for _, inner, last in arcs]
        for node, (after, _, _) in zip(nodes, arcs, strict=True):
            node[0].update((byte, nodes[at]) for byte, at in after.items())
        return nodes[0]

    def encode_word(self, word: bytes) -> list[int]:
        n, root, rows, state = len(word), self.root, self.rows, self.state
        last = n - 1
        reached: list = [0] * (n + 1)
        came = [0] * (n + 1)
        row = rows[0]
        for i in range(n):
            if i:
                row = rows[state[reached[i]]]
            node, j = root, i
            for byte in word[i:last]:
                node = node[0].get(byte)
                if node is None:
                    break
                j += 1
                token = node[1]
                if token is not None and row[token >> 3] >> (token & 7) & 1:
                    reached[j], came[j] = token, i
            else:
                node = node[0].get(word[last])
                if node is not None:
                    token = node[2]
                    if token is not None and row[token >> 3] >> (token & 7) & 1:
                        # No other token leads to the end.
                        reached[n], came[n] = token, i
                        break
        out = []
        while n:
            out.append(reached[n])
            n = came[n]
        return out[::-1]

    def words_of(self, chunk: str) -> list[str | int]:
        """Words in lower case of a text without white space inside, and the ids of added tokens between them."""
        found: list[str | int] = []
        parts = self.added_pattern.split(chunk) if self.added_pattern else [chunk]
        for part in parts:
            if part in self.added:
                found.append(self.added[part])
            else:
                found += words_pattern().findall(lowered(unicodedata.normalize("NFC", part)))
        return found

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a text without white space inside."""
        ids: list[int] = []
        for word in self.words_of(chunk):
            ids += [word] if isinstance(word, int) else self.encode_word(word.encode())
        return ids

    def encode(self, text: str) -> list[int]:
        return [i for chunk in chunks_of(text) for i in self.encode_chunk(chunk)]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.labels[i] for i in ids)


@lru_cache(maxsize=4)
def compile_automaton(path: str) -> Automaton:
    """The automaton of a tokenizer file: byte-level BPE with word ends, lower case, white space dropped."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") != WORD_END or model.get("dropout"):
        raise ValueError(f"{path} is no BPE with the word end {WORD_END}")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return Automaton(model["vocab"], merges, [(a["content"], a["id"]) for a in spec["added_tokens"]])


class _Words(dict):
    """Ids (little-endian unsigned 32-bit) and labels of words met before, and of added tokens by their id."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str | int) -> tuple[bytes, str]:
        ids = [word] if isinstance(word, int) else self.automaton.encode_word(word.encode())
        made = pack(f"<{len(ids)}I", *ids), self.automaton.decode(ids)
        if isinstance(word, int) or len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = made
        return made


class _Spelled(dict):
    """As ``_Words``, of chunks. The same words stand in many chunks, with other punctuation and capitals."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.split, self.words = automaton.words_of, _Words(automaton)

    def __missing__(self, chunk: str) -> tuple[bytes, str]:
        parts = [self.words[word] for word in self.split(chunk)]
        made = parts[0] if len(parts) == 1 else (b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts]))
        if len(chunk) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.clear()
            self[chunk] = made
        return made


_WORKERS: dict[str, _Spelled] = {}


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` of every row's whole text.

    A null text is empty; an empty text has no ids and decodes to the empty text. Repeated rows and null ids give a row
    each; an empty table gives none; other columns are not read. ``path`` names the tokenizer file, which is read on the
    driver; the compiled automaton (its size is that of the vocabulary, not of the data) is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(compile_automaton(path))

    def run(batches):
        import pyarrow as pa

        if path not in _WORKERS:
            _WORKERS[path] = _Spelled(sent.value)
        known = _WORKERS[path].__getitem__
        for ids, texts in in_slices(batches):
            made = [list(map(known, chunks_of(t or ""))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([b"".join([m[0] for m in row]) for row in made], pa.binary()),
                    pa.array([" ".join([m[1] for m in row if m[1]]) for row in made], pa.string()),
                ],
                names=["doc_id", "ids", "decoded"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def encoding_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, and the SHA-256 of its ids and of the text they decode to.

    Digests are made where the ids are, so that neither ids nor decoded texts leave the Python worker. Nulls, empty
    texts and repeated rows as in ``encode_documents``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(compile_automaton(path))

    def run(batches):
        from hashlib import sha256

        import pyarrow as pa

        if path not in _WORKERS:
            _WORKERS[path] = _Spelled(sent.value)
        known = _WORKERS[path].__getitem__
        for ids, texts in in_slices(batches):
            counts, id_digests, text_digests = [], [], []
            for text in texts:
                made = list(map(known, chunks_of(text or "")))
                raw = b"".join([m[0] for m in made])
                counts.append(len(raw) // 4)
                id_digests.append(sha256(raw).hexdigest())
                text_digests.append(sha256(" ".join([m[1] for m in made if m[1]]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(text_digests)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
