"""Benchmark decontamination against a plain version of the rule, on random and odd texts."""

import random
import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from loadwitness.llm import winnowing as W

DOCS = "doc_id bigint, text string, words string, row int, item string, starts int"
ITEMS = "item_id bigint, text string, words string"


def words_of(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))


def plain(docs, items):
    windows = {}
    for item, text in items:
        words = words_of(text)
        for i in range(max(len(words) - 9, 1) if words else 0):
            windows.setdefault(tuple(words[i : i + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(words[i : i + n])]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(words), len(hit), len(ids), ids, sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def check(spark, docs, items):
    a = spark.createDataFrame([(*d, "x", 1, "y", 2) for d in docs], DOCS)
    b = spark.createDataFrame([(*i, "z") for i in items], ITEMS)
    found = W.decontaminate(a, b)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(docs, items)


@pytest.mark.parametrize("small", [False, True])
def test_random_texts(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(W, "SLICE", 7)
        monkeypatch.setattr(W, "PIECE", 5)
        # A table so full that nearly everything passes costs work only.
        monkeypatch.setattr(W, "LEAST_PLACES", 8)
        monkeypatch.setattr(W, "MOST_PLACES", 8)
    rng = random.Random(12)
    stock = ["a", "B", "é", "É", "12", "don't", "文", "İ", "x", "😀", "q9"]
    items = [(i % 50, " ".join(rng.choices(stock, k=rng.choice([1, 2, 4, 9, 10, 11, 30])))) for i in range(60)]
    items = [x for x in items if len(words_of(x[1])) > 3] + [(61, "İ q9 x")]
    docs = []
    for i in range(80):
        text = rng.choices(stock, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(items)[1].split()
            at, start = rng.randint(0, len(text)), rng.randint(0, max(len(part) - 10, 0))
            text[at:at] = part[start : start + rng.randint(1, 20)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(text)))
    check(spark, docs, items)


def test_every_shared_span_is_found(spark):
    """Ten words of an item at any place of a long text, also across slices, and eleven that differ in the middle."""
    rng = random.Random(1)
    item = [f"w{i}" for i in range(40)]
    docs = []
    for i in range(31):
        text = [f"v{rng.randint(0, 9)}" for _ in range(9000)]
        at = rng.choice([0, 4085, 4090, 4096, 4100, 8990])
        text[at : at + 10] = item[i : i + 10]
        docs.append((i, " ".join(text)))
        text[at + 5] = "other"
        docs.append((100 + i, " ".join(text)))
    check(spark, docs, [(7, " ".join(item)), (8, " ".join(item)), (None, " ".join(item[:20]))])


def test_odd_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = [
        (1, None), (2, ""), (3, " \n!?"), (4, passage), (4, passage), (None, passage), (None, passage.upper()), (5, "Two"),
        (6, "a " * 200_000 + passage), (7, "x" * 300_000), (8, passage[:40]), (9, "one two. THREE"),
    ]
    items = [(1, passage), (1, passage), (2, None), (3, ""), (4, "?!"), (5, "two"), (None, "three"), (12, "One, two!"), (100, passage)]
    check(spark, docs, items)
    check(spark, docs, items[2:5])
    a, b = spark.createDataFrame([(*d, "x", 1, "y", 2) for d in docs], DOCS), spark.createDataFrame([(*i, "z") for i in items], ITEMS)
    assert W.decontaminate(a.where("false"), b).collect() == []
    assert not any(r["contaminated"] for r in W.decontaminate(a, b.where("false")).collect())


def test_no_python_and_one_scan_of_the_texts(spark, monkeypatch):
    plans = []

    def watch(df, name, stored=W.stored):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(W, "stored", watch)
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    found = W.decontaminate(docs, items.withColumn("item_id", F.col("item_id").cast("string")))
    plans.append(("result", found._jdf.queryExecution().executedPlan().toString()))
    for name, plan in plans:
        assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan), name
        assert ("documents.parquet" in plan) == (name == "windows-read")
    read = dict(plans)["windows-read"]
    assert read.count("regexp_extract_all") == 3
