"""Approximate nearest neighbours by cross-polytope hashing.

In each of ``TABLES`` tables a vector is turned by a pseudo-rotation (three rounds of random signs and a fast Hadamard
transform) and falls into the bucket of the signed axis nearest to it. A query looks into the ``PROBES`` buckets of each
table whose axes are nearest to it; what it finds there is ranked by the inner products of the original vectors. The tables
are the same for any number of vectors, so recall does not depend on it.

Members are dealt into shards by a hash, never by bucket, so a crowded bucket makes no task larger than another. A shard
holds its part of every bucket: each block of queries meets each shard once, every vector travels once per block it meets
instead of once per table and probe, and the best of all shards remain.

Vectors of unequal length are brought to one sphere first: one more coordinate fills each up to the largest norm and is zero
for queries, so that order by angle is order by inner product. Equal vectors are one class, which enters every table once;
a class needs no more members than the result has places, and those of the smallest ids.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from loadwitness.llm.common import stored

TABLES, PROBES, SEED = 16, 8, 20
# Bytes of vectors, as doubles, of a shard of members and of a block of queries; smaller tables still have SHARDS of them.
BLOCK_BYTES, SHARDS = 1 << 25, 8
# Inner products that a task holds at a time, and vectors that it turns at a time.
PRODUCTS, COLUMNS = 1 << 22, 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised fast Hadamard transform of each row; its length is a power of two.

    Components are held as columns, so that each step adds and subtracts long neighbouring stretches.
    """
    n, d = x.shape
    out = np.array(x.T, order="C", copy=True)
    for at in range(0, n, COLUMNS):
        part, step = np.ascontiguousarray(out[:, at : at + COLUMNS]), 1
        while step < d:
            pairs = part.reshape(-1, 2, step, part.shape[1])
            low = pairs[:, 0] - pairs[:, 1]
            pairs[:, 0] += pairs[:, 1]
            pairs[:, 1] = low
            step *= 2
        out[:, at : at + COLUMNS] = part
    out /= math.sqrt(d)
    return out.T


class Tables:
    """Rotations and bucket numbers; ``norm``: the largest norm of all vectors, None if all have the same."""

    def __init__(self, dim: int, norm: float | None):
        self.dim, self.norm = dim, norm
        self.width = 1 << max(0, dim + (norm is not None) - 1).bit_length()
        rng = np.random.default_rng(SEED)
        self.signs = rng.choice([-1.0, 1.0], (TABLES, 3, self.width))

    @property
    def buckets_in_all(self) -> int:
        return 2 * self.width

    def _turned(self, x: np.ndarray, query: bool, table: int) -> np.ndarray:
        lengths = np.linalg.norm(x, axis=1, keepdims=True)
        out = np.zeros((len(x), self.width))
        if self.norm is None or query:
            out[:, : self.dim] = x / lengths
        else:
            out[:, : self.dim] = x / self.norm
            out[:, self.dim] = np.sqrt(np.maximum(0, 1 - (lengths[:, 0] / self.norm) ** 2))
        for signs in self.signs[table]:
            out = hadamard(out * signs)
        return np.concatenate([out, -out], axis=1)

    def buckets(self, x: np.ndarray, table: int) -> np.ndarray:
        """The bucket of each vector."""
        return self._turned(x, False, table).argmax(axis=1)

    def probes(self, x: np.ndarray, table: int) -> np.ndarray:
        """The buckets nearest to each query, in any order (rows of at most ``PROBES``)."""
        far, near = np.ascontiguousarray(-self._turned(x, True, table)), min(PROBES, 2 * self.width)
        return far.argpartition(near - 1, axis=1)[:, :near]


def _best(q: np.ndarray, m: np.ndarray, score: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """Of distinct pairs the ``keep`` best of each query; ties go to the smaller member number."""
    order = np.lexsort((m, -score, q))
    q, m, score = q[order], m[order], score[order]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (m[1:] != m[:-1])
    q, m, score = q[fresh], m[fresh], score[fresh]
    some = np.arange(len(q)) - np.searchsorted(q, q, "left") < keep
    return q[some], m[some], score[some]


def _compare(asks: np.ndarray, x: np.ndarray, q: np.ndarray, m: np.ndarray, floor: np.ndarray, keep: int) -> list[tuple]:
    """Pairs (query, member, exact inner product) of ``q`` x ``m`` that may be among the ``keep`` best: for each query the
    best of ``m``, unless below its ``floor``. The margin is for rounding in the products, so that it leaves nobody out."""
    out, step = [], max(1, PRODUCTS // max(1, len(m)))
    members = x[m].T
    for at in range(0, len(q), step):
        some = q[at : at + step]
        score = asks[some] @ members
        edge = floor[some]
        if len(m) > keep:
            edge = np.maximum(edge, np.partition(score, len(m) - keep, axis=1)[:, len(m) - keep])
        low = np.where(np.isfinite(edge), edge - 1e-9 * (1 + np.abs(edge)), edge)
        row, column = np.nonzero(score >= low[:, None])
        pair = some[row], m[column]
        out.append((*pair, (asks[pair[0]] * x[pair[1]]).sum(axis=1)))
    return out


def best_of_shard(asks: np.ndarray, x: np.ndarray, tables: Tables, keep: int) -> tuple[np.ndarray, ...]:
    """Rows (query, member, score) of the ``keep`` members of ``x`` nearest to each of ``asks`` among those in the buckets that
    it probes. Of equal scores the earlier member comes first. A query whose buckets hold fewer than ``keep`` members of the
    shard is compared with the whole of it."""
    found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if not len(asks) or not len(x):
        return found
    floor = np.full(len(asks), -np.inf)
    for table in range(TABLES):
        bucket, probed = tables.buckets(x, table), tables.probes(asks, table)
        members, axis = np.argsort(bucket, kind="stable"), probed.ravel()
        by_axis = np.argsort(axis, kind="stable")
        askers, order = by_axis // probed.shape[1], axis[by_axis]
        sizes = np.bincount(bucket, minlength=tables.buckets_in_all)
        ends = np.cumsum(sizes)
        parts = [found]
        for b in np.unique(order):
            if sizes[b]:
                q = askers[np.searchsorted(order, b, "left") : np.searchsorted(order, b, "right")]
                parts += _compare(asks, x, q, members[ends[b] - sizes[b] : ends[b]], floor, keep)
        found = _best(*[np.concatenate(column) for column in zip(*parts)], keep)
        floor = _floor(found, len(asks), keep)
    wanted = min(keep, len(x))
    short = np.flatnonzero(np.bincount(found[0], minlength=len(asks)) < wanted)
    if len(short):
        parts = [found, *_compare(asks, x, short, np.arange(len(x)), floor, keep)]
        found = _best(*[np.concatenate(column) for column in zip(*parts)], keep)
    return found


def _floor(found: tuple[np.ndarray, ...], queries: int, keep: int) -> np.ndarray:
    """The score of each query's last place, minus infinity where places are free."""
    floor = np.full(queries, -np.inf)
    last = np.flatnonzero(np.arange(len(found[0])) - np.searchsorted(found[0], found[0], "left") == keep - 1)
    floor[found[0][last]] = found[2][last]
    return floor


def _search_shard(tables: Tables, keep: int):
    """``best_of_shard`` for the rows of one shard and block of queries: a row per query, its members as lists."""

    def run(group):
        import pyarrow as pa

        asks, ids, least = (np.asarray(group.column(c)) for c in ("asks", "class", "least"))
        x = group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = x.astype(np.float64).reshape(-1, tables.dim)
        rows, members = np.flatnonzero(asks), np.flatnonzero(~asks)
        members = members[np.argsort(least[members], kind="stable")]
        q, m, score = best_of_shard(x[rows], x[members], tables, keep)
        begin = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
        at = pa.array(np.append(begin, len(q)).astype(np.int32))
        lists = {"c": ids[members[m]], "least": least[members[m]], "far": -score}
        return pa.table(
            {"q": ids[rows[q[begin]]], **{k: pa.ListArray.from_arrays(at, pa.array(v)) for k, v in lists.items()}}
        )

    return run


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite numbers."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def _search(classes: DataFrame, tables: Tables, k: int, members: int, queries: int) -> DataFrame:
    """``q`` (class that asks), ``near``: up to ``k + 1`` pairs (negative score, id) in order, its own ids among them."""
    size = 8 * tables.dim
    shards = max(min(SHARDS, members), math.ceil(members * size / BLOCK_BYTES))
    blocks = max(1, math.ceil(queries * size / BLOCK_BYTES))

    def dealt(rows: DataFrame, asks: bool, own: int, others: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("class"), F.lit(own)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        shard, block = (other, mine) if asks else (mine, other)
        return rows.select(
            shard.alias("shard"), block.alias("block"), F.lit(asks).alias("asks"), "class", "least", "vector"
        )

    found = (
        dealt(classes, False, shards, blocks).union(dealt(classes.where("asks"), True, blocks, shards))
        .repartition(shards * blocks, "shard", "block")
        .groupBy("shard", "block")
        .applyInArrow(_search_shard(tables, k + 1), "q bigint, c array<bigint>, least array<bigint>, far array<double>")
    )
    # At most k + 1 candidates from each shard.
    near = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("far", "least", "c"))))
    best = found.groupBy("q").agg(F.slice(near, 1, k + 1).alias("best"))
    ids = classes.select(F.col("class").alias("c"), "ids")
    return (
        best.select("q", F.inline("best")).select("q", "far", "c").join(ids, "c")
        .select("q", "far", F.explode("ids").alias("vec_id"))
        .groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("far", "vec_id"))), 1, k + 1).alias("near"))
    )


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the ``k`` vectors found nearest to each query.

    ``queries`` is a condition over ``vectors``. Nearest is the largest inner product of the original vectors; ties go to
    the smaller id; a query is no candidate of its own. With fewer candidates than ``k`` all are returned. Vectors of each
    length are searched among their own kind, as others have no inner product with them; there is one search per length.
    Vectors that are null, zero or hold null or non-finite components take no part, nor do null ids. Rows that repeat id and
    vector count once. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    exact = vectors.schema[vector_col].dataType.simpleString() in ("array<float>", "array<double>")
    v = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        (F.col(vector_col) if exact else F.transform(vector_col, lambda x: x.cast("double"))).alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
        F.size(vector_col).alias("dim"),
    )
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    shapes = v.groupBy("dim").agg(
        F.count("*").alias("n"), F.count_if("asks").alias("asking"), F.max(norm).alias("high"), F.min(norm).alias("low")
    )
    found = [_nearest(v.where(F.col("dim") == s["dim"]), s, k) for s in shapes.where("asking > 0").collect()]
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return reduce(DataFrame.union, found)


def _nearest(v: DataFrame, shape: Row, k: int) -> DataFrame:
    """``nearest`` among vectors of one length; ``shape`` has its number of rows and queries and the range of norms."""
    mark = ["h1", "h2"]
    hashed = v.select(
        "vec_id", "asks", "vector", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2")
    )
    # A query leaves itself out, so one more than k.
    by_id = Window.partitionBy(*mark).orderBy("vec_id")
    members = (
        hashed.select("vec_id", *mark).distinct().withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= k + 1)
        .groupBy(*mark).agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    once = hashed.groupBy(*mark).agg(F.first("vector").alias("vector"), F.max("asks").alias("asks"))
    classes = stored(
        once.join(members, mark).select(
            F.monotonically_increasing_id().alias("class"), F.col("ids")[0].alias("least"), "ids", "asks", "vector", *mark
        ),
        "vector-classes",
    )
    same = shape["low"] >= shape["high"] * (1 - 1e-6)
    listed = _search(classes, Tables(shape["dim"], None if same else shape["high"]), k, shape["n"], shape["asking"])
    asked = hashed.where("asks").select(F.col("vec_id").alias("query_id"), *mark).distinct()
    each = asked.join(classes.select(*mark, F.col("class").alias("q")), mark).join(listed, "q")
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    return each.select("query_id", F.posexplode(F.slice(others, 1, k))).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("col.vec_id").alias("vec_id"), (-F.col("col.far")).alias("score")
    )
