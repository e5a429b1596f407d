"""Every stage of the pipeline against a brute-force version, on the small table with odd rows added."""

import random

import numpy as np
import pytest

import corpus_pipeline as P
from loadwitness.llm import attention_mil, naive_bayes
from loadwitness.llm.common import stored, table
from tests.llm.conftest import TEXTS
from tests.llm.test_operators import by_brute_force, without_lines

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SMALL, "documents")
    added = [(-i - 1, t, "en", "src0", len(t or "")) for i, (_, t) in enumerate(TEXTS)]
    docs = stored(docs.union(spark.createDataFrame(added, docs.schema)), "pipeline-test")
    made = [docs]
    for name, stage in P.STAGES:
        made.append(stored(stage(spark, made[-1], SMALL), name))
    return made


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_and_rows(stages):
    for made in stages[:-1]:
        assert made.columns == stages[0].columns
    counts = [len(texts(s)) for s in stages[:-1]]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 100


def test_filters_decide_by_their_models(spark, stages):
    model = naive_bayes.fit(stages[0])
    before = texts(stages[0])
    named, p = naive_bayes.score_texts(model, list(before.values()))
    assert set(texts(stages[1])) == {d for d, n, x in zip(before, named, p, strict=True) if n != "und" and x >= P.SURE}
    before = texts(stages[1])
    model = attention_mil.fit(stages[1], table(spark, SMALL, "labels"))
    score = attention_mil.score_texts(model, list(before.values()))
    assert set(texts(stages[2])) == {d for d, s in zip(before, score, strict=True) if s >= attention_mil.THRESHOLD}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SMALL, "labels").collect()}
    clean = {d for d in before if labels.get(d) == 1}
    assert len(clean & set(texts(stages[2]))) >= 0.97 * len(clean)


def test_lines_and_near_duplicates(stages):
    wanted = {d: t for d, (t, _) in without_lines(list(texts(stages[2]).items())).items()}
    assert texts(stages[3]) == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3].collect())
    rows = sorted(wanted.items())
    groups = [eval(x) for x in by_brute_force(rows, P.SHINGLE_WORDS, P.SIMILAR_PERCENT)]
    assert set(texts(stages[4])) == {d for d, n, c in groups if d == c or not n}


def shuffled(spark):
    """Files of shuffles and their bytes (``.data``), in local mode."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    named = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in named if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


def test_near_duplicates_shuffle_less_than_they_read(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"{rng.getrandbits(40):x}" for _ in range(300))) for i in range(3000)]
    rows += [(i + 3000, t + " end") for i, t in rows[:100]]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6), "near-test")
    before = shuffled(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of any size
    try:
        found = P.near_duplicates(spark, docs, SMALL).select("doc_id").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    written = sum(n for name, n in shuffled(spark).items() if name not in before)
    assert sorted(r["doc_id"] for r in found) == list(range(3000))
    assert written < sum(len(t) for _, t in rows)


@pytest.mark.parametrize("most", [False, True])
def test_near_duplicates_where_few_or_most_rows_go(spark, most):
    rng = random.Random(6)
    own = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(60)) for _ in range(40)]
    rows = [(i, t, i) for i, t in enumerate(own)] + [(None, own[0], 1), (900, None, 2), (901, "", 3), (None, None, 4)]
    rows += [(100 + k, f"{own[k % 8]} w{k}", k) for k in range(200 if most else 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _mark int")
    found = P.near_duplicates(spark, docs, SMALL)
    assert found.columns == docs.columns
    wanted = [*enumerate(own), (900, None), (901, ""), (None, None)]
    assert sorted(repr((r["doc_id"], r["text"])) for r in found.collect()) == sorted(map(repr, wanted))


def test_packing_holds_everything(stages):
    rows = stages[5].collect()
    assert {r["doc_id"] for r in rows} == set(texts(stages[4]))
    assert max(r["offset"] + r["length"] for r in rows) <= P.CAPACITY
    tokens = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= np.ceil(tokens / P.CAPACITY) + 1


def test_an_empty_table(spark, stages):
    docs = stages[0].where("false")
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SMALL), f"none-{name}")
        assert docs.count() == 0
