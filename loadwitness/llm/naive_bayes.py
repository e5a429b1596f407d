"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning counts n-grams (one to three characters, lower case) of all texts by language. Every task adds up its texts in
one vector of counts per language and hands it on in blocks; blocks are summed in two steps, so that no task meets the
blocks of all others. The matrix of log probabilities (languages x buckets) does not grow with the data and is broadcast;
texts are scored in batches: the sparse counts of their n-grams are multiplied by its rows and added up per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwitness.llm.common import BLOCKS, VECTOR, in_slices, summed_vectors, vector_blocks

BUCKET_BITS, ORDERS, SMOOTHING = 16, (1, 2, 3), 0.5
UNDETERMINED = "und"
# Characters whose n-grams are held at a time.
PIECE = 1 << 19

_LETTER = regex.compile(r"\p{L}")
# Odd multipliers, one per place in an n-gram and one per order (multiplicative hashing).
_PLACES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_SEEDS = {1: np.uint32(0x27D4EB2F), 2: np.uint32(0x165667B1), 3: np.uint32(0x2545F491)}


@dataclass
class LanguageModel:
    """``weights[bucket, language]``: log probabilities; ``priors``: those of the languages."""

    languages: list[str]
    priors: np.ndarray
    weights: np.ndarray


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def buckets(texts: list[str], starts: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts (in lower case), and the text of each. N-grams do not cross texts; with
    ``starts`` only those that begin at one of so many first characters of all."""
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(c) for c in codes], np.int64)
    chars = np.concatenate(codes) if codes else np.array([], np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    found, owners = [], []
    shift = np.uint32(32 - BUCKET_BITS)
    for n in ORDERS:
        if len(chars) < n:
            continue
        last = min(len(chars) - n + 1, len(chars) if starts is None else starts)
        mixed = np.full(last, _SEEDS[n], np.uint32)
        for place in range(n):
            mixed ^= chars[place : place + last]
            mixed *= _PLACES[place]
            mixed ^= mixed >> np.uint32(15)
        mixed *= _PLACES[0]
        inside = owner[:last] == owner[n - 1 : n - 1 + last]
        found.append((mixed >> shift)[inside])
        owners.append(owner[:last][inside])
    if not found:
        return np.array([], np.uint32), np.array([], np.int64)
    return np.concatenate(found), np.concatenate(owners)


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all n-grams of all texts and the text of each, from about ``PIECE`` characters at a time.

    A longer text is cut into pieces that overlap by what an n-gram reaches beyond its first character, each n-gram being
    found in the piece where it begins; so memory beyond the text itself does not grow with its length.
    """
    some: list[int] = []
    held = 0

    def together():
        found, owner = buckets([texts[i].lower() for i in some])
        return found, np.array(some, np.int64)[owner]

    for i, text in enumerate(texts):
        if len(text) <= PIECE:
            some.append(i)
            held += len(text)
            if held < PIECE:
                continue
        if some:
            yield together()
            some, held = [], 0
        if len(text) > PIECE:
            text = text.lower()
            for at in range(0, len(text), PIECE):
                found, owner = buckets([text[at : at + PIECE + max(ORDERS) - 1]], PIECE)
                yield found, owner + i
    if some:
        yield together()


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from every row that is not held out and has both a text and a language. Without any, no language is known."""
    size = 1 << BUCKET_BITS

    def count(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        totals: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for langs, texts in in_slices(batches):
            langs = langs.to_pylist()
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])
            counts = np.zeros((len(names), size), np.int64)
            for found, owner in grams(texts):
                counts += np.bincount(code[owner] * size + found, minlength=counts.size).reshape(counts.shape)
            for i, name in enumerate(names):
                totals[name] = totals.get(name, 0) + counts[i]
                docs_of[name] = docs_of.get(name, 0) + int((code == i).sum())
        for name, counts in totals.items():
            # The number of texts goes along behind the counts.
            vector = np.append(counts, np.zeros(BLOCKS, np.int64))
            vector[size] = docs_of[name]
            rows = [(name, *row) for row in vector_blocks(vector, part)]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "block", "part", "counts"])

    rows = docs.where(~held_out(id_col)).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    parts = rows.where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(count, f"lang string, {VECTOR}")
    # The model: languages x buckets counts.
    found = summed_vectors(parts, "lang string").orderBy("lang", "block").collect()
    languages = sorted({r["lang"] for r in found})
    vectors = np.array(
        [np.concatenate([np.frombuffer(r["counts"], "<i8") for r in found if r["lang"] == x]) for x in languages],
        np.float64,
    ).reshape(-1, size + BLOCKS)
    counts, n = vectors[:, :size], vectors[:, size]
    weights = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=1, keepdims=True) + SMOOTHING * size)
    return LanguageModel(languages, np.log(n / n.sum()) if len(n) else n, weights.T.astype(np.float32).copy())


def score_texts(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its probability."""
    known = [t if t and model.languages and _LETTER.search(t) else "" for t in texts]
    if not model.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    total = np.tile(model.priors, (len(texts), 1))
    for found, owner in grams(known):
        # Sparse counts: how often a text holds each bucket that it holds at all.
        cells = np.sort(owner.astype(np.uint32 if len(texts) <= 1 << 32 - BUCKET_BITS else np.uint64) << BUCKET_BITS | found)
        first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])) if len(cells) else cells
        counts, cells = np.diff(np.append(first, len(cells))), cells[first]
        texts_of = (cells >> BUCKET_BITS).astype(np.int64)
        begins = np.flatnonzero(np.append(True, texts_of[1:] != texts_of[:-1])) if len(cells) else cells
        if len(begins):
            terms = model.weights[cells & ((1 << BUCKET_BITS) - 1)] * counts[:, None].astype(np.float64)
            total[texts_of[begins]] += np.add.reduceat(terms, begins, axis=0)
    best = total.argmax(axis=1)
    odds = np.exp(total - total.max(axis=1, keepdims=True))
    probability = 1 / odds.sum(axis=1)
    named = [model.languages[b] if t else UNDETERMINED for b, t in zip(best, known, strict=True)]
    return named, np.where([bool(t) for t in known], probability, 0.0)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (probability of that language) of every row's whole text.

    ``und`` with score 0 for texts that are null or hold no letter, and for all if no language was learned. Among equal
    languages the first by name. Repeated rows and null ids give a row each; other columns are not read. Long texts are read
    piece by piece.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for ids, texts in in_slices(batches):
            named, probability = score_texts(sent.value, texts)
            yield pa.RecordBatch.from_arrays(
                [ids.field(0), ids.field(1), pa.array(named, pa.string()), pa.array(probability, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    ids = F.struct(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"))
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    return docs.select(ids.alias("ids"), F.col(text_col).alias("text")).mapInArrow(run, schema)
