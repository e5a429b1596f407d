"""Operators over whole texts against brute-force versions, on odd rows and on the small tables."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadwitness.llm import attention_mil as M
from loadwitness.llm import cross_polytope as C
from loadwitness.llm import exact_dedup as E
from loadwitness.llm import graph
from loadwitness.llm import jaccard_join as J
from loadwitness.llm import label_propagation as L
from loadwitness.llm import line_dedup as D
from loadwitness.llm import naive_bayes as N
from loadwitness.llm.common import table
from loadwitness.llm.shingles import U, shingle_sets
from tests.llm.conftest import TEXTS

SMALL = "/root/testdata/sf0.001"


def rows_of(df, *columns):
    return sorted(repr(tuple(r)) for r in df.select(*columns).collect())


# Exact dedup


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 2**60 - 1), st.integers(1, 1000), max_size=200), st.sampled_from([60, 61]))
def test_quotient_filter_round_trip(held, bits):
    values = np.array(sorted(held), U)
    counts = np.array([held[int(v)] for v in values], np.int64)
    made = E.CountingQuotientFilter.from_bytes(E.CountingQuotientFilter.build(values, counts, bits).to_bytes())
    found, n = made.entries()
    assert found.tolist() == values.tolist() and n.tolist() == counts.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=60), max_size=6))
def test_merge_loses_nothing(parts):
    filters = [E.CountingQuotientFilter.build(*np.unique(np.array(p, U), return_counts=True), 9) for p in parts]
    wanted = Counter(x for p in parts for x in p)
    if filters:
        values, counts = E.merged(filters)
        assert dict(zip(values.tolist(), counts.tolist(), strict=True)) == wanted


def test_exact_dedup_of_odd_rows(odd, none):
    def plain(t):
        return re.sub(r"[\x20\x09-\x0D]", "", t or "")

    groups = defaultdict(list)
    for d, t in TEXTS:
        groups[plain(t)].append((-len(t or ""), d is None, d or 0, d))
    found = E.exact_dedup(odd).collect()
    assert len(found) == len(TEXTS)
    by_digest = {sha256(p.encode()).hexdigest(): sorted(g) for p, g in groups.items()}
    kept = Counter()
    for r in found:
        group = by_digest[r["text_sha256"]]
        assert r["keep_id"] == group[0][3] and r["group_size"] == len(group)
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1}
    assert E.exact_dedup(none).collect() == []


# Line dedup


def without_lines(rows):
    """[(id, text)] with distinct ids: the rule, window by window."""
    seen, gone = {}, defaultdict(set)
    for d, t in sorted(rows):
        lines = t.split("\n")
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if window == ("", "", ""):
                continue
            if window in seen:
                gone[d] |= {i, i + 1, i + 2}
            seen.setdefault(window, (d, i))
    return {d: ("\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]), len(gone[d])) for d, t in rows}


def test_line_dedup_against_the_rule(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(rng.choice(["a", "b", "", "c d", "é"]) for _ in range(rng.randint(0, 9)))) for i in range(120)]
    found = D.line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: (r["text"], r["lines_removed"]) for r in found} == without_lines(rows)


def test_line_dedup_of_odd_rows(odd, none):
    found = D.line_dedup(odd)
    assert found.columns == [*odd.columns, "lines_removed"]
    texts = defaultdict(list)
    for r in found.collect():
        texts[r["doc_id"]].append(r["text"])
    # A null id comes first, so its three lines stay and those of 1 and 2 go.
    assert texts[None] == [t for d, t in TEXTS if d is None] or sorted(texts[None]) == sorted(t for d, t in TEXTS if d is None)
    assert texts[1] == texts[2] == [""] and texts[5] == [None] and texts[9] == [TEXTS[8][1]] * 2
    assert D.line_dedup(none).collect() == []


def test_line_dedup_beside_any_names(spark):
    rows = [(i, "a\nb\nc\nd", 1, 2, 3, 4, 5, 6) for i in range(3)]
    names = ["_id", "_version", "_gone", "_lines", "__ID", "pos"]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"`{n}` int" for n in names))
    found = D.line_dedup(docs)
    assert found.columns == ["doc_id", "text", *names, "lines_removed"]
    assert sorted(tuple(r) for r in found.collect()) == [(i, *([r[1], *r[2:], 0] if not i else ["", *r[2:], 4])) for i, r in enumerate(rows)]


# Sharding


def check_shards(found, texts, tolerance):
    sizes, slots = Counter(), defaultdict(list)
    for r in found:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 8
    wanted = sorted((repr(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == wanted
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if tolerance:
        assert max(sizes.values()) <= (1 + tolerance) * sum(sizes.values()) / 8


def test_sharding_of_odd_rows(odd, none):
    check_shards(L.shard_by_text(odd).collect(), TEXTS, None)
    assert L.shard_by_text(none).collect() == []


def test_sharding_keeps_groups_together_and_splits_a_hot_one(spark):
    texts = [(i, f"text {i} " * (5 + i % 40)) for i in range(600)]
    texts += [(1000 + i, f"pair {i // 2} " * 30) for i in range(200)]
    found = L.shard_by_text(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    check_shards(found, texts, 0.02)
    where = {r["doc_id"]: r["shard"] for r in found}
    assert all(where[1000 + i] == where[1001 + i] for i in range(0, 200, 2))
    hot = [(i, "the same text") for i in range(400)] + [(1000 + i, f"own text {i}") for i in range(800)]
    check_shards(L.shard_by_text(spark.createDataFrame(hot, "doc_id bigint, text string")).collect(), hot, 0.03)


def cut_groups(found, texts):
    """Texts that stand on more than one shard, and how many shards the first text takes."""
    where, text_of = defaultdict(set), dict(texts)
    for r in found:
        where[text_of[r["doc_id"]]].add(r["shard"])
    return sum(len(s) > 1 for s in where.values()), len(where[texts[0][1]])


def test_sharding_cuts_only_what_no_shard_holds(spark):
    def sharded(texts):
        found = L.shard_by_text(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
        check_shards(found, texts, 0.02)
        return cut_groups(found, texts)

    pairs = [(10000 + i, f"pair {i // 2:05} " * (3 + i // 2 % 30)) for i in range(1500)]
    rest = sum(len(t) + 1 for _, t in pairs)
    # One text with a third of all bytes, beside pairs only.
    hot = "hot " * 25
    assert sharded([(i, hot) for i in range(rest // 2 // (len(hot) + 1))] + pairs) == (1, 3)
    # Mostly grouped rows, some groups of a sixth of a shard.
    groups = [(20000 + i, f"group {i // 100} " * 25) for i in range(1000)]
    assert sharded(pairs + groups + [(30000 + i, f"own {i}") for i in range(50)]) == (0, 1)
    # Nothing but one text.
    assert sharded([(i, hot) for i in range(801)]) == (1, 8)


def test_dealing_units_too_large_for_a_share():
    units = [(900, 9), (610, 61), (600, 60), (600, 2), (90, 9)]
    pieces, held = L.deal(units, 4, 700)
    assert sum(held) == pytest.approx(sum(b for b, _ in units)) and max(held) <= 707 + 100
    assert [len(p) for p in pieces][1:] == [1, 1, 2, 1] and all(p[0][0] == 0 for p in pieces)
    assert L.deal([(10**12, 10**9)], 8, 1.25e11)[1] == pytest.approx([1.25e11] * 8)


def test_links_through_several_hubs_bring_units_together(spark):
    # Ten families of eight rows: hubs of two rows, and hubs of all eight.
    links = [(r, f"{r // 8}-{r // 2}") for r in range(80)] + [(r, f"all-{r // 8}") for r in range(80)]
    linked = spark.createDataFrame([(r, 100) for r in range(80)], "row bigint, size bigint")
    found = L.propagate(linked, spark.createDataFrame(links, "row bigint, hub string"), 4, 1e6).collect()
    shard = {r["row"]: r["shard"] for r in found}
    assert len(found) == len(shard) == 80 and all(shard[r] == shard[r + 1] for r in range(0, 80, 2))
    assert sum(len({shard[r] for r in range(f, f + 8)}) > 1 for f in range(0, 80, 8)) <= 1



def test_rounds_bring_the_copies_of_the_documents_together(spark, monkeypatch):
    """On the given table rounds run, move bytes, and links keep more together from round to round."""
    runs = []

    def watch(state, fixed, links, shards, capacity, real=L._rounds):
        state = L.stored(state, "before")
        after, kept = real(state, fixed, links, shards, capacity)
        moved = state.join(after.select("row", F.col("shard").alias("to")), "row").where("`to` <> shard").count()
        cut = [df.groupBy("unit.unit").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() for df in (state, after)]
        runs.append((kept, moved, cut))
        return after, kept

    monkeypatch.setattr(L, "_rounds", watch)
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = L.shard_by_text(docs).collect()
    check_shards(found, texts, 0.01)
    (kept, moved, (before, after)), = runs
    best = list(np.maximum.accumulate(kept))
    assert len(kept) > L.VAIN and best[0] < best[1] < best[-1] and moved > 0
    assert after < before / 4
    assert cut_groups(found, texts)[0] == 0


# Jaccard join


def shingles_of(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def by_brute_force(rows, k, percent):
    sets = [shingles_of(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least[i] = min(ids) if ids else None
    return sorted(repr((d, len(s), least[i] if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_linked_sets_share_a_key(k, percent):
    rng, threshold = np.random.default_rng(k), J.Threshold(percent)
    for n in rng.integers(threshold.least, 250, 800).tolist():
        a = np.unique(rng.integers(0, 1 << 63, n).astype(U))
        gone, more = rng.integers(0, n // 8 + 2, 2)
        b = np.unique(np.append(rng.permutation(a)[gone:], rng.integers(0, 1 << 63, more).astype(U)))
        common = len(np.intersect1d(a, b))
        if 100 * common >= percent * (len(a) + len(b) - common) and common < max(len(a), len(b)):
            keys = [threshold.keys(x, x % U(5) < U(2), {}) for x in (a, b)]
            assert len(np.intersect1d(*keys))


def test_shingles_are_those_of_the_words():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab AB\n\té ") for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None, "", " "]
    sets = shingle_sets(pa.array(texts), 3)
    for t, s in zip(texts, sets, strict=True):
        assert len(s) == len(shingles_of(t, 3))
    for i in range(0, 200, 9):
        for j in range(0, 200, 7):
            assert len(np.intersect1d(sets[i], sets[j])) == len(shingles_of(texts[i], 3) & shingles_of(texts[j], 3))


def test_join_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(words) for _ in range(rng.choice([8, 14, 25, 60, 120]))] for _ in range(12)]
    rows = []
    for i in range(220):
        own = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    # Blocks of a few sets, so that clusters are cut.
    monkeypatch.setattr(J, "BLOCK_SETS", 7)
    for k, percent in ((3, 90), (2, 80)):
        assert rows_of(J.jaccard_join(docs, k, percent), "doc_id", "n_shingles", "component_id") == by_brute_force(rows, k, percent)


@pytest.mark.parametrize("shingles", [0, 1, 10**6, 10**9, 10**14])
def test_packed_keys_come_back(shingles):
    rng, packing = np.random.default_rng(4), J.Packing(shingles)
    key = np.sort(packing.cut(rng.integers(0, 1 << 64, 3000, U)))
    key[:2], key[-2:] = 0, (1 << packing.bits) - 1
    node = rng.integers(0, 1 << 8 * J.NODE_BYTES, len(key), U)
    batch = packing.rows(key, node)
    found = {}
    for i, (bucket, width) in enumerate(zip(batch["bucket"].to_pylist(), batch["width"].to_pylist(), strict=True)):
        found[bucket] = J.Packing.keys(batch["packed"].slice(i, 1), width)
    assert sorted(found) == list(found) and max(found) < packing.buckets
    for bucket, (steps, _) in found.items():
        least = -(-(bucket << 32) // packing.buckets) << (packing.bits - 32)
        steps += U(least)
    assert np.array_equal(np.concatenate([k for k, _ in found.values()]), key)
    assert np.array_equal(np.concatenate([n for _, n in found.values()]), node)
    # Several rows of a bucket at once, as a task reads them.
    twice = pa.concat_arrays([batch["packed"].slice(0, 1)] * 2)
    steps, nodes = J.Packing.keys(twice, batch["width"][0].as_py())
    assert steps[: len(steps) // 2].tolist() == steps[len(steps) // 2 :].tolist()
    assert nodes[: len(nodes) // 2].tolist() == nodes[len(nodes) // 2 :].tolist()


def test_join_of_sets_with_one_node(spark, monkeypatch):
    monkeypatch.setattr(J, "NODE_BYTES", 0)  # every set has the node of every other
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    rows = [(i, " ".join([*base[: 59 - i], *[f"v{i}{k}" for k in range(i)]])) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert rows_of(J.jaccard_join(docs, 2, 80), "doc_id", "n_shingles", "component_id") == by_brute_force(rows, 2, 80)


def test_join_of_odd_rows(odd, none):
    found = J.jaccard_join(odd, 3, 90)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == by_brute_force(TEXTS, 3, 90)
    assert J.jaccard_join(none, 3, 90).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, 5), (7, 7), (300, 200)]
    found = graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    wanted = {i: i // 20 * 20 for i in range(60)} | {100: 0, 200: 200, 300: 200}
    assert {r["node"]: r["root"] for r in found} == {**wanted, 60: 40} if 60 in {r["node"] for r in found} else wanted


# Nearest neighbours


def test_hadamard():
    x = np.random.default_rng(1).normal(size=(3, 16))
    turned = C.hadamard(x)
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(C.hadamard(turned), x)


@pytest.mark.parametrize("unit", [True, False])
def test_neighbours_recall_order_and_odd_vectors(spark, unit):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True) if unit else 1
    x = x.astype(np.float32)
    x[50:90] = x[50]
    rows = [(i, v.tolist(), "kept") for i, v in enumerate(x)]
    rows += [(10, x[10].tolist(), "again"), (None, x[3].tolist(), "no id"), (9001, None, ""), (9002, [0.0] * 24, "")]
    rows += [(9003, [float("nan")] * 24, ""), (9004, [None] + [1.0] * 23, ""), (9005, [1.0] * 5, ""), (9006, [], "")]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank string")
    found = C.nearest(vectors, F.col("vec_id") % 10 == 0, k=12).collect()
    by_query = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by_query[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    assert sorted(by_query) == list(range(0, 700, 10))
    y, hits = x.astype(np.float64), 0
    for q, near in by_query.items():
        score = y @ y[q]
        score[q] = -np.inf
        assert [r for *_, r in near] == list(range(1, 13)) and q not in [v for v, *_ in near]
        assert np.allclose([s for _, s, _ in near], [score[v] for v, *_ in near])
        assert near == sorted(near, key=lambda n: (-n[1], n[0]))
        hits += len({v for v, *_ in near} & set(np.lexsort((np.arange(700), -score))[:12].tolist()))
    assert hits / (12 * len(by_query)) >= 0.9
    few = C.nearest(vectors.where("vec_id < 3"), F.lit(True), k=12).collect()
    assert len(few) == 6
    assert C.nearest(vectors.where("false"), F.lit(True)).collect() == []


def test_recall_does_not_depend_on_the_size_of_the_table(spark, monkeypatch):
    # Once, buckets were cut by more axes from so many vectors a bucket on, and the number of probes stayed.
    monkeypatch.setattr(C, "CROWDED", 1, raising=False)
    x = np.random.default_rng(5).normal(size=(1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    found = defaultdict(set)
    for r in C.nearest(vectors, F.col("vec_id") % 50 == 0, k=12).collect():
        found[r["query_id"]].add(r["vec_id"])
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    assert sum(len(found[q] & set(np.argsort(-score[q])[:12].tolist())) for q in range(0, 1500, 50)) >= 0.9 * 12 * 30


def test_vectors_of_each_length_are_searched_among_their_own(spark):
    rng = np.random.default_rng(9)
    sizes = {24: range(0, 300), 7: range(300, 340), 1: range(340, 344)}
    x = {i: rng.normal(size=d).astype(np.float32).astype(np.float64) for d, ids in sizes.items() for i in ids}
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in x.items()], "vec_id bigint, embedding array<float>")
    found = defaultdict(list)
    for r in C.nearest(vectors, F.col("vec_id") % 10 == 0, k=12).orderBy("rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    assert sorted(found) == list(range(0, 344, 10))
    for ids in sizes.values():
        hits, wanted = 0, 0
        for q in [i for i in ids if i % 10 == 0]:
            best = sorted((i for i in ids if i != q), key=lambda i: (-(x[i] * x[q]).sum(), i))[:12]
            assert set(found[q]) <= set(ids) and len(found[q]) == len(best)
            hits, wanted = hits + len(set(best) & set(found[q])), wanted + len(best)
        assert hits >= 0.9 * wanted


@pytest.mark.parametrize("products", [1, 1 << 22])
def test_a_shard_gives_the_best_of_the_probed_buckets(monkeypatch, products):
    monkeypatch.setattr(C, "PRODUCTS", products)
    x, asks = np.random.default_rng(6).normal(size=(400, 12)), np.random.default_rng(7).normal(size=(15, 12))
    tables = C.Tables(12, float(np.linalg.norm(x, axis=1).max()))
    q, m, score = C.best_of_shard(asks, x, tables, 9)
    buckets = [tables.buckets(x, t) for t in range(C.TABLES)]
    probes = [tables.probes(asks, t) for t in range(C.TABLES)]
    for i, ask in enumerate(asks):
        seen = [j for j in range(400) if any(buckets[t][j] in probes[t][i] for t in range(C.TABLES))]
        best = sorted(seen, key=lambda j: (-(x[j] * ask).sum(), j))[:9]
        assert m[q == i].tolist() == best and np.allclose(score[q == i], x[best] @ ask)
    # Fewer members than places: all of them, whatever the buckets.
    few = C.best_of_shard(asks, x[:5], tables, 9)
    assert np.bincount(few[0]).tolist() == [5] * 15


# Classifiers


def test_language_is_learned(spark, odd, none):
    docs = table(spark, SMALL, "documents")
    model = N.fit(docs)
    found = N.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    named = {(r["doc_id"], r["lang_pred"], r["score"] > 0) for r in N.identify(odd, model).collect()}
    assert {(4, "und", False), (5, "und", False), (6, "und", False), (10, "und", False)} <= named
    assert len(N.identify(odd, model).collect()) == len(TEXTS)
    nothing = N.fit(none)
    assert {r["lang_pred"] for r in N.identify(odd, nothing).collect()} == {"und"}
    assert N.identify(none, model).collect() == []


def _bucket(gram):
    """The bucket of an n-gram in whole numbers of 32 bits."""
    mixed = int(N._SEEDS[len(gram)])
    for place, char in enumerate(gram):
        mixed = ((mixed ^ ord(char)) * int(N._PLACES[place])) % 2**32
        mixed ^= mixed >> 15
    return (mixed * int(N._PLACES[0])) % 2**32 >> 32 - N.BUCKET_BITS


def _grams(text):
    text = text.lower()
    return [_bucket(text[i : i + n]) for n in N.ORDERS for i in range(len(text) - n + 1)]


def test_language_model_by_counting(spark, odd):
    docs = table(spark, SMALL, "documents").select("doc_id", "text", "lang")
    rows = docs.where("doc_id % 3 = 0").collect()
    learned = [r for r in rows if r["text"] and r["lang"] and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    counts, number = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for r in learned:
        number[r["lang"]] += 1
        for b in _grams(r["text"]):
            counts[r["lang"]][b] += 1
    size = 1 << N.BUCKET_BITS
    totals = {x: sum(c.values()) + N.SMOOTHING * size for x, c in counts.items()}
    model = N.fit(docs.where("doc_id % 3 = 0"))
    assert model.languages == sorted(counts)
    tested = [(r["doc_id"], r["text"]) for r in rows[:60]] + [(10**6 + i, t) for i, (_, t) in enumerate(TEXTS)]
    frame = spark.createDataFrame(tested, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in N.identify(frame, model).collect()}
    for i, text in tested:
        if not text or not any(c.isalpha() for c in text):
            assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0)
            continue
        odds = {x: math.log(number[x] / len(learned)) for x in counts}
        for b in _grams(text):
            for x in odds:
                odds[x] += math.log((counts[x].get(b, 0) + N.SMOOTHING) / totals[x])
        best = max(sorted(odds), key=odds.get)
        share = 1 / sum(math.exp(o - odds[best]) for o in odds.values())
        assert share < 0.51 or found[i]["lang_pred"] == best
        assert abs(found[i]["score"] - share) < 1e-3


def test_language_of_long_texts_is_read_in_pieces(monkeypatch):
    """The n-grams of a text are the same however it is cut, and a text of 20 million characters takes little memory."""
    texts = ["", "ab", "Ärger " * 30, "abcdefghij", "x", "ΟΔΟΣ " * 25, "word " * 7, "abc", "İstanbul " * 20]
    whole = sorted((i, b) for i, t in enumerate(texts) for b in _grams(t))
    rng = np.random.default_rng(3)
    weights = rng.normal(size=(1 << N.BUCKET_BITS, 3)).astype(np.float32)
    model = N.LanguageModel(["a", "b", "c"], np.log([0.2, 0.3, 0.5]), weights)
    named, score = N.score_texts(model, texts)
    for piece in (1, 2, 3, 10, 40, 1000):
        monkeypatch.setattr(N, "PIECE", piece)
        found = [(int(i), int(b)) for buckets, owner in N.grams(texts) for i, b in zip(owner, buckets, strict=True)]
        assert sorted(found) == whole
        again, near = N.score_texts(model, texts)
        assert again == named and np.allclose(near, score, atol=1e-9)
    monkeypatch.undo()
    monster = "many words of a very long text " * 650_000
    tracemalloc.start()
    N.score_texts(model, [monster, None, "short"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300 << 20


def test_values_are_counted_whatever_the_batches():
    rng = np.random.default_rng(8)
    values = rng.integers(0, 3000, 20_000).astype(U)
    for cuts in ([], [1, 2, 3], list(range(50, 20_000, 50)), [19_000], [0, 0, 20_000]):
        seen, held = E.counted(np.split(values, cuts))
        wanted, n = np.unique(values, return_counts=True)
        assert (seen == wanted).all() and (held == n).all()
    assert [len(x) for x in E.counted([])] == [0, 0]


def test_scores_do_not_depend_on_neighbours():
    texts = [t for _, t in TEXTS]
    rng = np.random.default_rng(1)
    model = N.LanguageModel(["a", "b"], np.log([0.5, 0.5]), rng.normal(size=(1 << N.BUCKET_BITS, 2)).astype(np.float32))
    names, odds = N.score_texts(model, texts)
    x, owner = M.passages([t or "" for t in texts])
    for i, t in enumerate(texts):
        name, p = N.score_texts(model, [t])
        assert name[0] == names[i] and np.isclose(p[0], odds[i])
        assert np.allclose(M.passages([t or ""])[0], x[owner == i])


def attention_by_loops(model, text):
    """One text's score, number by number."""
    w = {k: np.asarray(v).tolist() for k, v in model.weights.items()}

    def layer(values, weights, bias):
        return [sum((v * row[j] for v, row in zip(values, weights, strict=True)), 0.0) + bias[j] for j in range(len(bias))]

    x = (M.bags([text])[0] - model.shift) / model.scale
    hidden = [[math.tanh(v) for v in layer(p, w["encode"], w["encode_b"])] for p in x.tolist()]
    logits = []
    for h in hidden:
        t, g = layer(h, w["tanh"], w["tanh_b"]), layer(h, w["gate"], w["gate_b"])
        logits.append(sum(math.tanh(a) / (1 + math.exp(-b)) * c for a, b, c in zip(t, g, w["attend"], strict=True)))
    weights = [math.exp(e - max(logits)) for e in logits]
    z = [sum(a * h[j] for a, h in zip(weights, hidden, strict=True)) / sum(weights) for j in range(M.HIDDEN)]
    s = sum(a * b for a, b in zip(z, w["out"], strict=True)) + w["out_b"][0]
    return 1 / (1 + math.exp(-min(max(s, -30), 30)))


@pytest.fixture(scope="module")
def attention():
    rng = np.random.default_rng(8)
    x, owner = rng.normal(0, 1, (900, M.FEATURES)), np.arange(900) // 3
    return M.train(x, owner, (x.reshape(300, 3, -1)[:, :, 4].max(1) > 0.8).astype(float))


def test_scores_are_equal_for_any_cut_into_batches(attention):
    texts = [t for _, t in TEXTS] + ["a b. " * n for n in range(1, 60)] + ["", None]
    whole = M.score_texts(attention, texts)
    rng = random.Random(3)
    for _ in range(20):
        order = rng.sample(range(len(texts)), len(texts))
        while order:
            n = rng.randint(1, 30)
            some, order = order[:n], order[n:]
            assert (M.score_texts(attention, [texts[i] for i in some]) == whole[some]).all()


def test_scores_against_loops(attention):
    texts = [t for _, t in TEXTS]
    for text, found in zip(texts, M.score_texts(attention, texts), strict=True):
        assert found == pytest.approx(attention_by_loops(attention, text), abs=1e-12)


def test_long_texts_go_piece_by_piece(attention, monkeypatch):
    text = "  Some words of a text, \n and more. " * 20_000
    whole = M.passages([text])[0]
    cut, owner = M.bags(["a", text, "b", " " * (M.LONG_CHARS + 1)])
    assert len(cut) == len(whole) + 3 and np.bincount(owner).tolist() == [1, len(whole), 1, 1]
    # Only the blank before a piece's first word may count elsewhere.
    assert np.abs(cut[1:-2] - whole).max() < 0.02
    most = []
    monkeypatch.setattr(M, "passages", lambda texts, real=M.passages: most.append(sum(map(len, texts))) or real(texts))
    M.score_texts(attention, [text])
    assert max(most) <= M.PIECE_PASSAGES * M.PASSAGE_WORDS * 12


def test_what_the_model_learns_from_is_bounded(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(M, "train", lambda x, owner, label, real=M.train: sent.append((len(label), len(x))) or real(x, owner, label))
    rows = [(7, f"word{i} " * 10) for i in range(500)] + [(8, "word " * 64 * 200)]
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id bigint, quality int")
    M.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), labels, sample=50)
    assert sent[0][0] <= 50 and sent[0][1] <= 50 * M.BAG


def test_slopes_of_the_attention_model():
    """A step of training lowers the loss, and a bag is found by its one odd passage."""
    rng = np.random.default_rng(5)
    x, owner, label = [], [], []
    for bag in range(300):
        n = int(rng.integers(1, 8))
        own = rng.normal(0, 0.1, (n, M.FEATURES))
        label.append(bag % 3 != 0)
        if bag % 3 == 0:
            own[rng.integers(0, n), 5] += 2
        x.append(own)
        owner += [bag] * n
    model = M.train(np.concatenate(x), np.array(owner), np.array(label, float))
    begins = np.searchsorted(owner, np.arange(300))
    score = M._forward(model.weights, (np.concatenate(x) - model.shift) / model.scale, begins, np.array(owner))["s"]
    assert ((score > 0.5) == np.array(label)).mean() > 0.97


def test_quality_is_learned(spark, odd, none):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = M.fit(docs, labels)
    found = M.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in found) >= 0.95 * len(found)
    scored = M.score(odd, model).collect()
    assert len(scored) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in scored)
    assert len({r["score"] for r in scored if r["doc_id"] in (4, 5, 6)}) == 1
    assert {r["score"] for r in M.score(odd, M.fit(none, labels)).collect()} == {0.5}
    assert M.score(none, model).collect() == []
