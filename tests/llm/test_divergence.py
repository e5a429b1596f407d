"""Source divergence against a plain version of the rule, on random and odd documents."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from loadwitness.llm import source_divergence as S

SCHEMA = "doc_id bigint, text string, lang string, source string, prefix string, term int"


def plain(rows, least, ranks):
    """[(text, lang, source)] -> rows of the result."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        held[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    out = []
    for lang, documents in held.items():
        kept = [t for t, n in documents.items() if n >= least]
        sources = [s for g, s in counts if g == lang]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // total for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}

        def apart(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(-sum(apart(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(-apart(p[s][t], whole[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs, key=_bytes)), ("term", sorted(terms, key=_bytes)[:ranks])):
                out += [(lang, s, part, item, -value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def _bytes(pair):
    return pair[0], pair[1].encode()


def check(spark, rows, least, ranks):
    docs = spark.createDataFrame([(i, *r, "x", i) for i, r in enumerate(rows)], SCHEMA)
    found = S.divergence(docs, least=least, ranks=ranks)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, least, ranks)


def test_random_documents(spark):
    rng = random.Random(11)
    stems = ["a", "Ab", "abcdef", "abcdefg", "abcdefgh", "ÉÉ", "é", "文字文字文字", "x" * 70, "x" * 71, "İ", "don't", "z9z", "😀k"]
    rows = []
    for _ in range(150):
        words = [rng.choice(stems) + rng.choice(["", "", "s", "ING"]) for _ in range(rng.randint(0, 30))]
        # One source holds a third of all rows.
        source = rng.choice(["s1", "s1", "s2", "s3", None, "é"])
        rows.append((" ".join(words), rng.choice(["en", "de"]), source))
    check(spark, rows, 10, 10)
    check(spark, rows, 3, 4)


def test_odd_documents(spark):
    rows = [
        (None, None, None), ("", "", ""), ("a b c", "en", "s"), ("a b c", "en", "s"), ("A\0B", "en", "t"), ("a", "en", None),
        ("12 ?!", "fr", "s"), ("only here", "fr", "t"), ("alone", "xx", "s"), ("a" * 200_000 + " a " * 100_000, "en", "u"),
    ]
    check(spark, rows, 2, 10)
    check(spark, rows, 3, 1)
    check(spark, rows, 100, 10)
    empty = spark.createDataFrame([], SCHEMA)
    assert S.divergence(empty).collect() == []


def test_many_sources_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_SOURCES", 3)
    monkeypatch.setattr(S, "BUCKET_TERMS", 5)
    rng = random.Random(2)
    words = [a + b for a in "abcdef" for b in "uvwxyz"]
    rows = [(" ".join(rng.choices(words, k=6)), "en", f"s{rng.randint(0, 10)}") for _ in range(80)]
    check(spark, rows, 4, 5)


def test_prefixes_go_level_by_level(spark, monkeypatch):
    """Long terms of a prefix that is rare are not counted, and a full table changes nothing but work."""
    rows = [("common commonly", "en", "s")] * 10 + [(f"rareprefix{i}", "en", "s") for i in range(9)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    docs = docs.selectExpr("lang", "source", "CAST(text AS BINARY) AS text")
    seen = []
    counted = S._prefix_counts

    def watch(docs, length, before, table):
        out = counted(docs, length, before, table)
        seen.append({bytes(r["prefix"]): r["documents"] for r in out.collect()})
        return out

    monkeypatch.setattr(S, "_prefix_counts", watch)
    kept = {bytes(r["prefix"]) for r in S.kept_terms(docs, 10).collect()}
    assert kept == {b"common\0", b"commonly\0"}
    assert seen[0] == {b"common": 10, b"rarepr": 9}
    assert seen[1] == {b"common\0": 10, b"commonly\0": 10}
    monkeypatch.setattr(S, "MOST_TABLE", 8)
    monkeypatch.setattr(S, "LEAST_TABLE", 8)
    assert {bytes(r["prefix"]) for r in S.kept_terms(docs, 10).collect()} == kept


@pytest.mark.parametrize("some", [[""], [" "], ["a"], [" a b", "", "B  é "], ["x" * 50, "ab " * 50, "\x85a\xa0"], []])
def test_terms_of_slices(some):
    texts = pa.array(["left out", *some], pa.binary())[1:] if some else pa.array([], pa.binary())
    terms, place, text = S.terms_of(texts)
    found = [(int(t), terms[int(p)].as_py().decode()) for p, t in zip(place, text, strict=True)]
    assert found == [(i, t) for i, x in enumerate(some) for t in x.lower().split(" ") if t]


def test_slices_hold_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 7)
    batch = pa.record_batch([["en", "de", "en", "en"], ["s"] * 4, [b"abc", b"abcdefghijk", b"", b"abcd"]], names=["l", "s", "t"])
    found = [(lang, rows.column(2).to_pylist()) for lang, rows in S._by_lang([batch, batch.slice(0, 0)])]
    assert sorted((lang, t) for lang, texts in found for t in texts) == sorted(
        zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)
    )
