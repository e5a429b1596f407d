"""Joins whose large side may hold a third of its rows under one key."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwitness.scratch import written

SALTS = 16
# Rows of one key that a task may well take.
HOT = 1_000_000
# Tasks over which a left join spreads rows with a null key, once those are that many.
NULL_SALTS = 1024


def salted_join(
    big: DataFrame, small: DataFrame, on: list[str], salt_by: list[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Equi-join ``big`` to ``small`` on ``on``, spreading each key of ``big`` over ``salts`` tasks.

    The salt is a hash of ``salt_by``, so a retried task puts its rows where the first try did. ``small`` is
    repeated once per salt: use it where ``small`` has few rows per key. No hint is given; Spark broadcasts
    ``small`` when its estimate is under the session's threshold (so at most ``salts`` times that threshold goes
    out), joins by shuffle beyond it, and splits what is still skewed (AQE).
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"salting does not keep the meaning of a {how} join")
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def by_shuffle(small: DataFrame) -> DataFrame:
    """``small`` marked to be joined by shuffle. Spark broadcasts by an estimate from files, which leaves out what compression,
    exploded lists and built texts make of them, and does not turn back once the plan stands: a side that grows with the
    runs would go through the driver."""
    return small.hint("merge")


def counted_join(
    big: DataFrame, small: DataFrame, on: list[str], salt_by: list[str], counted: DataFrame | None = None, hot: int | None = None,
    how: str = "inner",
) -> DataFrame:
    """Inner or left equi-join of ``big`` to ``small`` on ``on`` in which only keys with more than ``hot`` rows in ``big`` are
    salted, each over as many tasks as it has ``hot`` rows; of ``small`` only the rows of such keys are repeated.

    The rows of each key are counted first, with partial counts, in ``counted`` where another frame with the rows of ``big``
    is cheaper to read. There is at most one such key per ``hot`` rows. Without any the join is a plain one, by shuffle. Rows
    with a null key match nothing: an inner join leaves them out, a left join spreads them if they are many.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salting does not keep the meaning of a {how} join")
    hot = hot or HOT
    present = reduce(and_, [F.col(c).isNotNull() for c in on])
    rows = counted if counted is not None else big
    if how == "inner":
        rows = rows.where(present)
    keys = rows.groupBy(*on).agg(F.count("*").alias("_rows"))
    busy = written(keys.where(F.col("_rows") > hot).select(*on, F.ceil(F.col("_rows") / hot).alias("_salts")), "hot-keys")
    if busy.isEmpty():
        return big.join(by_shuffle(small), on, how)
    known = F.coalesce("_salts", F.lit(1).cast("bigint"))
    left, salts = big.where(present), known
    if how == "left":
        left, salts = big, F.when(present, known).otherwise(F.lit(NULL_SALTS).cast("bigint"))
    left = left.join(busy, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_by), salts)).drop("_salts")
    right = small.join(busy, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), known - 1)))
    return left.join(by_shuffle(right.drop("_salts")), [*on, "_salt"], how).drop("_salt")


def join_nulls_apart(left: DataFrame, right: DataFrame, on: list[str], spread: list[str]) -> DataFrame:
    """Left join on ``on``. Rows of ``left`` with a null there match nothing; they are spread by a hash of ``spread``
    instead of meeting in one task."""
    absent = reduce(or_, [F.col(c).isNull() for c in on])
    marked = left.withColumn("_apart", F.when(absent, F.xxhash64(*spread)))
    renamed = right.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in right.columns]).withColumn(
        "_never", F.lit(None).cast("bigint")
    )
    same = reduce(and_, [F.col(c) == F.col(f"_on_{c}") for c in on]) & F.col("_apart").eqNullSafe(F.col("_never"))
    return marked.join(by_shuffle(renamed), same, "left").drop("_apart", "_never", *[f"_on_{c}" for c in on])
