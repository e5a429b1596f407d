"""Whitening against numpy's covariance and eigenvectors, over the whole small table and odd vectors."""

import numpy as np
import pytest

from loadwitness.llm import whitening as W
from loadwitness.llm.common import table
from loadwitness.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def check(found, vectors, components=4):
    """``found`` rows by id against the plain computation over ``vectors`` {id: entries}."""
    x = {i: np.floor(256 * np.array(v, float)) + 0 for i, v in vectors.items()}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums, mean = len(fit), fit.sum(0), fit.mean(0)
    cov = (fit - mean).T @ (fit - mean) / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    real = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(found) == real * len(vectors)
    signs = {}
    for r in found:
        k = r["component"] - 1
        row = [int(c) for c in x[r["vec_id"]]]
        assert r["n"] == n
        assert r["deviation"] == sum((n * c - int(s)) ** 2 for c, s in zip(row, sums, strict=True))
        assert r["explained"] == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
        wanted = (x[r["vec_id"]] - mean) @ axes[:, k] / np.sqrt(values[k])
        if abs(wanted) > 1e-3:
            signs.setdefault(k, set()).add(bool(wanted * r["whitened"] > 0))
        assert abs(abs(r["whitened"]) - abs(wanted)) < 1e-7
        assert 0 <= r["identity_error"] < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def test_whole_table(spark):
    rows = table(spark, SMALL, "embeddings").collect()
    found = QUERIES["op13_whitening"](spark, SMALL)
    assert dict(found.dtypes)["deviation"] == "bigint"
    check(found.collect(), {r["vec_id"]: r["embedding"] for r in rows})


def test_badly_conditioned_vectors(spark):
    """Entries that differ by ten orders of magnitude, copies, and a constant one."""
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=3) * [1e9, 1.0, 0.1]).tolist() + [5.0]) for i in range(300)]
    rows += [(i + 300, rows[0][1]) for i in range(200)]
    found = W.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(7)).collect()
    x = np.floor(256 * np.array([r[1] for r in rows]))
    assert {r["component"] for r in found} == {1, 2, 3} and {r["n"] for r in found} == {300}
    assert max(r["identity_error"] for r in found) < 1e-4
    third = [r for r in found if r["component"] == 3]
    assert len({r["whitened"] for r in third if r["vec_id"] == 0 or r["vec_id"] >= 300}) == 1
    assert len(x) * 3 == len(found)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], "a"), (1, [1.0, 2.0], "a"), (None, [0.5, 2.5], "b"), (2, None, "b"), (3, [nan, 1.0], "c"),
        (4, [None, 1.0], "c"), (5, [inf, 0.0], "c"), (6, [], "d"), (7, [1.0, 2.0, 3.0], "d"), (8, [1.0, 7.0], "e"),
        (9, [-0.0, 7.0], None),
    ]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n string")
    found = W.whiten(docs).collect()
    kept = {1: [1.0, 2.0], None: [0.5, 2.5], 8: [1.0, 7.0], 9: [0.0, 7.0]}
    check(list({(r["vec_id"], r["component"]): r for r in found}.values()), kept)
    assert [r["vec_id"] for r in found].count(1) == 4
    assert W.whiten(docs.where("false")).collect() == []
    assert W.whiten(docs.where("vec_id = 1")).collect() == []
    with pytest.raises(Exception, match="too large"):
        W.whiten(spark.createDataFrame([(1, [1e30])], "vec_id bigint, embedding array<double>")).collect()


def test_lengths_are_whitened_apart(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=3 + i % 2).tolist()) for i in range(80)]
    found = W.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    for odd in (0, 1):
        check([r for r in found if r["vec_id"] % 2 == odd], {i: v for i, v in rows if i % 2 == odd})


def test_far_from_the_origin(spark):
    """Exact beyond 64 bits: the sum of squares is a decimal."""
    rows = [(i, [float(2**40 + i), 1.0]) for i in range(4)]
    found = W.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    check(found, dict(rows))
