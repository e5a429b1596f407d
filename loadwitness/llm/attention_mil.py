"""Quality classifier: a document is a bag of passages, weighed by gated attention learned from document labels.

Every passage of ``PASSAGE_WORDS`` words becomes a vector: shares of character classes, statistics of its words, hashed
character pairs. One layer encodes it, gated attention weighs it against the other passages of its document, and a
logistic unit scores the weighted sum. Only labels of documents are used; which passage made a document bad is learned.

The model is fitted on the driver from at most ``SAMPLE`` labelled rows (those whose ids have the smallest hashes), of each
at most ``BAG`` passages, evenly spread over the whole text; passages are encoded where the texts are. Scoring covers every
passage of every row. A score depends on the text alone: its sums run in one order, whatever lies beside it in a batch.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwitness.llm.common import in_slices
from loadwitness.llm.naive_bayes import held_out

#: Labelled rows that the model is fitted on at most, and passages of each.
SAMPLE, BAG = 6000, 64
PASSAGE_WORDS, HIDDEN, GATE = 64, 24, 12
EPOCHS, BATCH, RATE, DECAY, SEED = 12, 64, 0.01, 1e-4, 7
THRESHOLD = 0.7

# Single characters that get a class of their own, then classes by Unicode category.
_MARKS = ".,;:!?|#$%&*-_/\\<>=+()[]{}\"'@~^`"
_CATEGORIES = ["Lu", "Ll", "Lt", "Lm", "Lo", "N", "M", "P", "S", "Z", "C"]
_PAIRS = 64
# A text of more characters is cut into pieces of so many passages, so that a task's memory does not follow its length.
LONG_CHARS, PIECE_PASSAGES = 1 << 19, 256
_PIECE = re.compile(rf"(?:[^\x09-\x0d ]++[\x09-\x0d ]*+){{1,{PIECE_PASSAGES * PASSAGE_WORDS}}}+")
_CLASSES = 1 + len(_MARKS) + 1 + len(_CATEGORIES)
FEATURES = _CLASSES + _PAIRS + 8


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """Class of each code point of the basic plane; 0 for the rest."""
    table = np.zeros((1 << 16) + 1, np.int64)
    for code in range(1 << 16):
        c = chr(code)
        kind = unicodedata.category(c)
        if c in _MARKS:
            table[code] = 1 + _MARKS.index(c)
        elif c == "\n":
            table[code] = 1 + len(_MARKS)
        else:
            known = kind if kind in _CATEGORIES else kind[0]
            table[code] = 2 + len(_MARKS) + _CATEGORIES.index(known)
    return table


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage (rows) and the text each belongs to. A text without words is one passage of zeros."""
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(c) for c in codes], np.int64)
    chars = np.concatenate(codes) if codes else np.array([], np.uint32)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    kinds = _class_table()[np.minimum(chars, 1 << 16)]
    space = (chars == 32) | ((chars >= 9) & (chars <= 13))
    edge = np.append(True, text_of[1:] != text_of[:-1]) if len(chars) else np.array([], bool)
    starts = np.flatnonzero(~space & (edge | np.append(True, space[:-1])[: len(space)]))
    word_text = text_of[starts]
    words_of = np.bincount(word_text, minlength=len(texts))
    nth = np.arange(len(starts)) - np.repeat(np.cumsum(words_of) - words_of, words_of)
    passages_of = np.maximum(1, -(-words_of // PASSAGE_WORDS))
    first = np.cumsum(passages_of) - passages_of
    word_passage = first[word_text] + nth // PASSAGE_WORDS
    owner = np.repeat(np.arange(len(texts)), passages_of)
    n = len(owner)
    out = np.zeros((n, FEATURES), np.float32)
    if not len(starts):
        return out, owner
    # Characters before the first word of a text belong to no passage.
    word_at = np.zeros(len(chars), np.int64)
    word_at[starts] = 1
    word_at = np.cumsum(word_at) - 1
    mine = np.maximum(word_at, 0)
    inside = (word_at >= 0) & (word_text[mine] == text_of)
    passage_at = word_passage[mine]
    length = np.bincount(passage_at[inside], minlength=n).astype(np.float64)
    safe = np.maximum(length, 1)[:, None]
    shares = np.bincount((passage_at * _CLASSES + kinds)[inside], minlength=n * _CLASSES).reshape(n, _CLASSES)
    out[:, :_CLASSES] = shares / safe
    pair = (kinds[:-1] * 131 + kinds[1:] * 31 + (chars[:-1] & 31) * 7 + (chars[1:] & 31)) % _PAIRS
    within = inside[:-1] & (text_of[:-1] == text_of[1:])
    pairs = np.bincount((passage_at[:-1] * _PAIRS + pair)[within], minlength=n * _PAIRS).reshape(n, _PAIRS)
    out[:, _CLASSES : _CLASSES + _PAIRS] = pairs / safe
    # Words: a hash per word from its characters and their places.
    solid = ~space
    place = np.arange(len(chars)) - starts[mine]
    power = (np.uint64(0x9E3779B97F4A7C15) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1))) | np.uint64(1)
    mixed = np.where(solid, (chars.astype(np.uint64) + np.uint64(1)) * power, np.uint64(0))
    words = np.add.reduceat(mixed, starts)
    letters = np.add.reduceat(solid.astype(np.int64), starts)
    count = np.bincount(word_passage, minlength=n).astype(np.float64)
    per = np.maximum(count, 1)

    def share(values: np.ndarray) -> np.ndarray:
        return np.bincount(word_passage, values, n) / per

    same = np.append(False, (words[1:] == words[:-1]) & (word_passage[1:] == word_passage[:-1]))
    order = np.lexsort((words, word_passage))
    again = (words[order][1:] == words[order][:-1]) & (word_passage[order][1:] == word_passage[order][:-1])
    distinct = (count - np.bincount(word_passage[order][1:], again, n)) / per
    mean = share(letters)
    spread = np.sqrt(np.maximum(share(letters * letters) - mean * mean, 0))
    at = out[:, _CLASSES + _PAIRS :]
    at[:, 0], at[:, 1], at[:, 2], at[:, 3] = mean / 10, spread / 10, share(same), distinct
    at[:, 4], at[:, 5], at[:, 6] = share(letters == 1), share(letters > 20), np.minimum(count / PASSAGE_WORDS, 1)
    at[:, 7] = np.log1p(length) / 10
    return out, owner


def bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``passages`` of texts of any length: long ones go piece by piece, cut between passages."""
    held, owners, some, mine = [], [], [], []

    def flush():
        if some:
            x, owner = passages(some)
            held.append(x)
            owners.append(np.array(mine, np.int64)[owner])
            some.clear()
            mine.clear()

    for i, text in enumerate(texts):
        if len(text or "") <= LONG_CHARS:
            some.append(text or "")
            mine.append(i)
            continue
        any_ = False
        for piece in _PIECE.finditer(text):
            flush()
            any_ = True
            some.append(piece.group())
            mine.append(i)
        if not any_:
            some.append("")
            mine.append(i)
    flush()
    if not held:
        return np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64)
    return np.concatenate(held), np.concatenate(owners)


@dataclass
class AttentionModel:
    """Weights; ``shift`` and ``scale`` standardise the features. Without weights every score is ``prior``."""

    prior: float
    shift: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]


def in_order(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``rows @ weights``, every row summed from its first column to its last. A library's product rounds a row differently
    by the number of rows and its place among them."""
    out = np.zeros((len(rows), *weights.shape[1:]))
    for i, weight in enumerate(weights):
        out += rows[:, i : i + 1] * weight if weights.ndim > 1 else rows[:, i] * weight
    return out


def _forward(
    w: dict[str, np.ndarray], x: np.ndarray, begins: np.ndarray, owner: np.ndarray, product=np.matmul
) -> dict[str, np.ndarray]:
    h = np.tanh(product(x, w["encode"]) + w["encode_b"])
    t, g = np.tanh(product(h, w["tanh"]) + w["tanh_b"]), 1 / (1 + np.exp(-(product(h, w["gate"]) + w["gate_b"])))
    e = product(t * g, w["attend"])
    e = np.exp(e - np.maximum.reduceat(e, begins)[owner])
    a = e / np.add.reduceat(e, begins)[owner]
    z = np.add.reduceat(a[:, None] * h, begins, axis=0)
    s = 1 / (1 + np.exp(-np.clip(product(z, w["out"]) + w["out_b"], -30, 30)))
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "s": s}


def train(x: np.ndarray, owner: np.ndarray, label: np.ndarray) -> AttentionModel:
    """Adam on the log loss of the documents. ``x``: passages; ``owner``: ascending document of each; ``label``: 0 or 1."""
    if not len(label) or label.min() == label.max():
        return AttentionModel(float(label.mean()) if len(label) else 0.5, np.zeros(0), np.zeros(0), {})
    rng = np.random.default_rng(SEED)
    shift, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - shift) / scale
    w = {
        "encode": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), "encode_b": np.zeros(HIDDEN),
        "tanh": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "tanh_b": np.zeros(GATE),
        "gate": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "gate_b": np.zeros(GATE),
        "attend": rng.normal(0, GATE**-0.5, GATE), "out": rng.normal(0, HIDDEN**-0.5, HIDDEN), "out_b": np.zeros(1),
    }
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    sizes = np.bincount(owner, minlength=len(label))
    begin = np.cumsum(sizes) - sizes
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(label))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            rows = np.concatenate([np.arange(begin[d], begin[d] + sizes[d]) for d in some])
            n = sizes[some]
            begins, mine = np.cumsum(n) - n, np.repeat(np.arange(len(some)), n)
            xb = x[rows]
            f = _forward(w, xb, begins, mine)
            ds = (f["s"] - label[some]) / len(some)
            dz = ds[:, None] * w["out"]
            da = (dz[mine] * f["h"]).sum(axis=1)
            de = f["a"] * (da - np.add.reduceat(f["a"] * da, begins)[mine])
            dgt = de[:, None] * w["attend"]
            dt, dg = dgt * f["g"] * (1 - f["t"] ** 2), dgt * f["t"] * f["g"] * (1 - f["g"])
            dh = dz[mine] * f["a"][:, None] + dt @ w["tanh"].T + dg @ w["gate"].T
            dp = dh * (1 - f["h"] ** 2)
            slope = {
                "encode": xb.T @ dp, "encode_b": dp.sum(axis=0), "tanh": f["h"].T @ dt, "tanh_b": dt.sum(axis=0),
                "gate": f["h"].T @ dg, "gate_b": dg.sum(axis=0), "attend": (f["t"] * f["g"]).T @ de,
                "out": f["z"].T @ ds, "out_b": ds.sum(keepdims=True),
            }
            step += 1
            for k, v in slope.items():
                v = v + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                w[k] -= rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return AttentionModel(float(label.mean()), shift, scale, {k: v.astype(np.float64) for k, v in w.items()})


def score_texts(model: AttentionModel, texts: list[str | None]) -> np.ndarray:
    if not model.weights:
        return np.full(len(texts), model.prior)
    x, owner = bags(texts)
    begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner
    return _forward(model.weights, (x - model.shift) / model.scale, begins, owner, in_order)["s"]


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample: int = SAMPLE,
) -> AttentionModel:
    """Fit on at most ``sample`` labelled rows that are not held out, of each at most ``BAG`` passages.

    Null ids and labels are no examples; a row is an example once per label it has; rows that repeat an id count each. Without examples, or with one label
    only, the model gives every text the mean label (0.5 without any).
    """
    chosen = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
        .where("doc_id IS NOT NULL AND label IS NOT NULL")
        .where(~held_out("doc_id"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample)
    )

    def run(batches):
        import pyarrow as pa

        for ids, texts in in_slices(batches):
            x, owner = bags(texts)
            sizes = np.bincount(owner, minlength=len(texts))
            ends = np.cumsum(sizes)
            chosen = [e - n + np.unique(np.arange(min(n, BAG)) * n // min(n, BAG)) for n, e in zip(sizes, ends, strict=True)]
            made = [x[rows].astype("<f4").tobytes() for rows in chosen]
            yield pa.RecordBatch.from_arrays(
                [ids.field(0), ids.field(1), pa.array(made, pa.binary())], names=["doc_id", "label", "features"]
            )

    # At most ``sample`` rows, so the side that is sent out has a fixed bound.
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
    kind = docs.schema[id_col].dataType.simpleString()
    examples = rows.select(F.struct("doc_id", "label").alias("ids"), "text").mapInArrow(
        run, f"doc_id {kind}, label double, features binary"
    )
    # Ids that many rows repeat give more rows than labels: the bound holds for what comes back.
    order = [F.xxhash64("doc_id"), "doc_id", "label", F.xxhash64("features")]
    found = sorted(examples.orderBy(*order).limit(sample).collect(), key=lambda r: (r["doc_id"], r["label"], r["features"]))
    x = [np.frombuffer(r["features"], "<f4").reshape(-1, FEATURES) for r in found]
    owner = np.repeat(np.arange(len(x)), [len(b) for b in x])
    flat = np.concatenate(x).astype(np.float64) if x else np.zeros((0, FEATURES))
    return train(flat, owner, np.array([min(max(r["label"], 0.0), 1.0) for r in found]))


def score(docs: DataFrame, model: AttentionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on) of every row's whole text.

    A null or empty text is scored as one empty passage; a text of any length is scored whole, long ones piece by piece. Repeated rows and null ids give a row each; an empty table gives
    none; labels, languages and sources are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for ids, texts in in_slices(batches):
            found = score_texts(sent.value, texts)
            yield pa.RecordBatch.from_arrays(
                [ids.field(0), ids.field(1), pa.array(found, pa.float64()), pa.array(found >= THRESHOLD).cast(pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    ids = F.struct(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"))
    schema = f"doc_id {kind}, held_out boolean, score double, predicted int"
    return docs.select(ids.alias("ids"), F.col(text_col).alias("text")).mapInArrow(run, schema)
