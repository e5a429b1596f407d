"""Encoding, packing and token files against the tokenizers library and exact round trips."""

import io
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadwitness.llm import bestfit_packing as P
from loadwitness.llm import bpe_automaton as A
from loadwitness.llm import token_files as T
from loadwitness.llm.queries import tokenizer_file
from loadwitness.llm.token_ids import ChunkIds
from loadwitness.scratch import fresh_path
from tests.llm.conftest import TEXTS

LIBRARY = Tokenizer.from_file(tokenizer_file())
CHARACTERS = st.text(
    st.one_of(st.characters(codec="utf-8"), st.sampled_from("aehinorst AEIO.,!?'\n\t\x1c\x85 ́ΣİſK12³"))
)


def wanted(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(CHARACTERS)
def test_both_encoders_agree_with_the_library(text):
    automaton = A.compile_automaton(tokenizer_file())
    ids = wanted(text)
    assert automaton.encode(text) == ids
    assert automaton.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)
    assert ChunkIds(tokenizer_file()).encode(text) == as_bytes(ids)


@settings(max_examples=300, deadline=None)
@given(st.text("abehinorstuz", min_size=1, max_size=40))
def test_words(text):
    assert A.compile_automaton(tokenizer_file()).encode(text) == wanted(text)


def test_a_word_is_encoded_once_whatever_stands_around_it(monkeypatch):
    """Chunks with other capitals and punctuation hold the same words."""
    automaton = A.compile_automaton(tokenizer_file())
    chunks, seen, plain = ["harbour", "Harbour,", "(harbour)", "HARBOUR's", "harbour-harbour."], [], A.Automaton.encode_word
    monkeypatch.setattr(A.Automaton, "encode_word", lambda self, word: seen.append(word) or plain(self, word))
    spelled = A._Spelled(automaton)
    for chunk in chunks:
        ids = wanted(chunk)
        assert spelled[chunk] == (as_bytes(ids), LIBRARY.decode(ids, skip_special_tokens=False))
    assert seen.count(b"harbour") == 1 and len(seen) == len(set(seen))


def test_encoding_of_odd_rows(odd, none, tokenizer):
    found = A.encoding_digest(odd, tokenizer).collect()
    ids = [(d, wanted(t)) for d, t in TEXTS]
    digests = [
        (d, len(i), sha256(as_bytes(i)).hexdigest(), sha256(LIBRARY.decode(i, skip_special_tokens=False).encode()).hexdigest())
        for d, i in ids
    ]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, digests))
    made = A.encode_documents(odd, tokenizer).collect()
    assert sorted(bytes(r["ids"]) for r in made) == sorted(as_bytes(i) for _, i in ids)
    assert A.encoding_digest(none, tokenizer).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
def test_bin_completion(lengths):
    counts = np.bincount(lengths, minlength=41)
    patterns = P.bin_completion(counts, 40)
    used = np.zeros(41, int)
    for times, pattern in patterns:
        assert sum(length * n for length, n in pattern) <= 40
        for length, n in pattern:
            used[length] += times * n
    assert (used == counts).all()
    made = sum(times for times, _ in patterns)
    assert P.lower_bound(counts, 40) <= made <= sum(times for times, _ in P.best_fit(counts, 40))


def fewest(lengths, capacity):
    """By trying every sequence for every piece."""
    best = len(lengths)

    def search(at, free):
        nonlocal best
        if len(free) >= best:
            return
        if at == len(lengths):
            best = len(free)
            return
        for i in {f: i for i, f in enumerate(free) if f >= lengths[at]}.values():
            search(at + 1, [*free[:i], free[i] - lengths[at], *free[i + 1 :]])
        search(at + 1, [*free, capacity - lengths[at]])

    search(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_fewest_sequences(lengths):
    made = sum(n for n, _ in P.bin_completion(np.bincount(lengths, minlength=21), 20))
    assert made <= fewest(sorted(lengths, reverse=True), 20) + (len(lengths) > 8)


def test_packing(odd, none, tokenizer):
    rows = P.pack(odd, tokenizer, capacity=64, end_id=0).collect()
    pieces = []
    for d, t in TEXTS:
        ids = [*wanted(t), 0]
        pieces += [(d, k // 64, k, len(ids[k : k + 64]), zlib.crc32(as_bytes(ids[k : k + 64]))) for k in range(0, len(ids), 64)]
    assert sorted(map(repr, (tuple(r)[:5] for r in rows))) == sorted(map(repr, pieces))
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= -(-sum(p[3] for p in pieces) // 64) + 1
    assert P.pack(none, tokenizer).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=400).map(lambda b: b[: len(b) // 4 * 4]), max_size=12))
def test_frames_round_trip(documents):
    out = io.BytesIO()
    n, tokens, size = T.write_frames(out, enumerate(documents))
    assert (n, tokens, size) == (len(documents), sum(map(len, documents)) // 4, len(out.getvalue()))
    reader = T.FrameReader(out, size)
    for i in reversed(range(n)):
        assert reader.read(i) == documents[i]


def test_a_changed_byte_is_noticed():
    out = io.BytesIO()
    _, _, size = T.write_frames(out, [(1, bytes(range(200)))])
    data = bytearray(out.getvalue())
    data[20] ^= 1
    with pytest.raises(Exception, match="checksum|decompress"):
        T.FrameReader(io.BytesIO(bytes(data)), size).read(0)


def test_files_are_plain_zstandard(spark, odd, tokenizer):
    import zstandard

    manifest = T.write_token_files(odd, tokenizer, fresh_path(spark, "plain"), 1).orderBy("part").collect()
    raw = b""
    for file in manifest:
        with open(file["path"].removeprefix("file://").removeprefix("file:"), "rb") as f:
            raw += zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    ids = sorted((as_bytes([*wanted(t), 1]) for _, t in TEXTS))
    assert len(raw) == sum(map(len, ids))


def test_token_files(spark, odd, none, tokenizer):
    found = T.round_trip(odd, tokenizer, end_id=1).orderBy("start").collect()
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert keys == sorted(keys)
    start = 0
    for r in found:
        assert r["start"] == start
        start += r["n_tokens"]
    made = sorted(repr((d, len(i), zlib.crc32(as_bytes(i)))) for d, i in ((d, [*wanted(t), 1]) for d, t in TEXTS))
    assert sorted(repr((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in found) == made
    manifest = T.write_token_files(odd, tokenizer, fresh_path(spark, "some"), 1)
    some = T.read_token_files(manifest, [3, 7]).orderBy("doc_id").collect()
    assert [(r["doc_id"], bytes(r["ids"])) for r in some] == [(d, as_bytes([*wanted(t), 1])) for d, t in TEXTS if d in (3, 7)]
    assert T.round_trip(none, tokenizer, end_id=1).collect() == []
    assert odd.select(F.count("*")).first()[0] == len(TEXTS)


def test_every_file_is_read_by_a_task_of_its_own(spark, tokenizer):
    docs = spark.createDataFrame([(i, f"some text {i} " * (i % 7)) for i in range(400)], "doc_id bigint, text string")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    manifest = T.write_token_files(docs, tokenizer, fresh_path(spark, "many"), 1)
    spark.conf.set(coalesce, "true")
    files = manifest.count()
    found = T.file_digest(manifest)
    assert files > 1 and found.rdd.getNumPartitions() == files
    held = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(held) == files and sum(r["count"] for r in held) == 400
    ranges = [(r["first_id"], r["last_id"]) for r in manifest.orderBy("part").collect()]
    assert ranges[0][0] == 0 and ranges[-1][1] == 399
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    # Files that hold none of the ids are not opened.
    first, last = ranges[1]
    gone = manifest.withColumn("path", F.when(F.col("first_id") == first, F.col("path")).otherwise("/nowhere/x"))
    assert {r["doc_id"] for r in T.read_token_files(gone, [first, last]).collect()} == {first, last}
