"""Row-level comparison of a source with its target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadwitness.functions.comments import SOURCE_ONLY, TARGET_ONLY
from loadwitness.functions.rowhash import canonical_text, field, hashable
from loadwitness.scratch import materialise

# Words of 64 bits in the table that tells which keys may differ. It is sent to all executors, so this bounds what is sent:
# at most so many rows of two numbers, whatever the number of differing rows.
TABLE_WORDS = 1 << 18

# Ranges of rows whose digests are compared first; so many numbers reach the driver at most.
RANGES = 4096

KEYS = ["_key_1", "_key_2"]
RANGE = "_range"
HASH = "_row_hash"


def shared_columns(source: DataFrame, target: DataFrame, cols: Sequence[str] | None = None) -> T.StructType:
    """Target fields to compare: those asked for, or all that the source has too. Case and order do not count."""
    have = {name.lower() for name in source.columns}
    if cols is None:
        return T.StructType([f for f in target.schema.fields if f.name.lower() in have])
    by_name = {f.name.lower(): f for f in target.schema.fields}
    missing = [c for c in cols if c.lower() not in by_name or c.lower() not in have]
    if missing:
        raise ValueError(f"columns not on both sides: {missing}")
    return T.StructType([by_name[c.lower()] for c in cols])


def converts(raw: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether a value that is not null keeps all it says in the target type: cast there and back it is the same.

    Text is not compared as it is written (``1.50`` is 1.5), but by what it says: as an instant for dates, as a number
    with 18 places for decimals. Values with inner types only have to convert.
    """
    cast = raw.try_cast(target)
    same = F.lit(True)
    if isinstance(source, T.StringType):
        if isinstance(target, T.DateType):
            same = raw.try_cast("timestamp_ntz") == cast.cast("timestamp_ntz")
        elif isinstance(target, T.DecimalType):
            same = raw.try_cast(T.DecimalType(38, 18)) == cast.try_cast(T.DecimalType(38, 18))
    elif not isinstance(source, (T.ArrayType, T.MapType, T.StructType)):
        same = cast.try_cast(source) == raw
    return cast.isNotNull() & F.coalesce(same, F.lit(False))


def _casts(df: DataFrame, fields: T.StructType) -> list[tuple[T.StructField, Column, Column | None]]:
    """Each field's value in the target type, and the raw text of values that lose something there (None: no cast needed)."""
    own = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in fields.fields:
        mine = own[f.name.lower()]
        raw = F.col(f"`{mine.name}`")
        if mine.dataType == f.dataType:
            out.append((f, raw, None))
        else:
            fits = converts(raw, mine.dataType, f.dataType)
            out.append((f, F.when(fits, raw.try_cast(f.dataType)), F.when(raw.isNotNull() & ~fits, raw.cast("string"))))
    return out


def canonical_rows(
    df: DataFrame, fields: T.StructType, scales: Mapping[str, int] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """The row hash and each column as canonical text, after a cast to the type in ``fields``.

    Of the other columns those in ``keep`` stay.

    A value that cannot be cast keeps its raw text and hashes unlike any value of the type, null included.
    """
    scales = scales or {}
    texts, parts = [], []
    for f, value, failed in _casts(df, fields):
        text = canonical_text(value, f.dataType, scales.get(f.name))
        texts.append((text if failed is None else F.coalesce(text, failed)).alias(f.name))
        parts.append(field(text, failed))
    return df.select(*keep, F.sha2(F.concat(*parts), 256).alias(HASH), *texts)


def with_keys(
    df: DataFrame,
    fields: T.StructType,
    scales: Mapping[str, int] | None = None,
    ranges: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The compared columns, those in ``keep``, ``_range`` (by the key where ``ranges`` is not given) and a 128-bit key: two
    rows have the same key exactly when their canonical texts agree.

    The key hashes typed values, an order of magnitude cheaper than rendering and SHA-256, which are left to the rows
    that differ. Both halves see each value with a mark of its presence, in opposite orders, so values cannot slide
    between columns. Unequal rows share a key with a chance of 1 to 10^38.
    """
    scales = scales or {}
    own = {f.name.lower(): f.name for f in df.schema.fields}
    columns = [F.col(f"`{own[f.name.lower()]}`") for f in fields.fields]
    values, marks = [], ([], [])
    for i, (f, value, failed) in enumerate(_casts(df, fields)):
        compact, text = hashable(value, f.dataType, scales.get(f.name))
        values.append(compact.alias(f"_v{i}"))
        for half in (0, 1):
            mark = F.when(compact.isNotNull(), F.lit(0).cast("bigint"))
            for other in (failed, text):
                if other is not None:
                    mark = mark.when(other.isNotNull(), F.xxhash64(F.lit(half), other))
            marks[half].append(mark.otherwise(F.lit(1).cast("bigint")).alias(f"_m{half}_{i}"))
    # Rendered values are used twice, so they get a projection of their own.
    number = (F.lit(0) if ranges is None else ranges).alias(RANGE)
    prepared = df.select(*columns, *keep, *values, *marks[0], *marks[1], number)
    number = F.pmod(KEYS[0], F.lit(RANGES)).cast("int") if ranges is None else F.col(RANGE)
    first, second = ([c for i in range(len(values)) for c in (f"_m{half}_{i}", f"_v{i}")] for half in (0, 1))
    keyed = prepared.select(
        *columns, *keep, F.xxhash64(*first).alias(KEYS[0]), F.xxhash64(F.lit(1), *reversed(second)).alias(KEYS[1]), RANGE
    )
    return keyed.withColumn(RANGE, number)


def _numbered(df: DataFrame, fields: T.StructType, facts: Sequence[Column] = ()) -> DataFrame:
    """The compared columns as ``c0``, ``c1`` and so on, ``facts`` as ``f0``, ``f1``: no column can have the name of a helper
    then."""
    own = {f.name.lower(): f.name for f in df.schema.fields}
    columns = [F.col(f"`{own[f.name.lower()]}`").alias(f"c{i}") for i, f in enumerate(fields.fields)]
    return df.select(*columns, *[F.coalesce(c, F.lit(False)).alias(f"f{i}") for i, c in enumerate(facts)])


def _ordered_by(fields: T.StructType, range_by: str | None) -> int:
    """Place of the column whose values make the ranges: the one asked for, else the first with an order in numbers, else
    the first (whose rows get ranges by their keys)."""
    names = [f.name.lower() for f in fields.fields]
    if range_by is not None:
        return names.index(range_by.lower())
    kinds = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return next((i for i, f in enumerate(fields.fields) if isinstance(f.dataType, kinds)), 0)


def _as_number(value: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return None


def _range_columns(sides: Sequence[DataFrame], fields: T.StructType, at: int) -> list[Column | None]:
    """Per side the number of the range that a row is in, equal for equal rows nearly always.

    Ranges of equal width between the least and the greatest value of both sides, so that rows which were loaded together and
    differ together share ranges; None for values without such an order. Which range a row is in never decides whether it
    is reported.
    """
    kind = fields.fields[at].dataType
    numbers = [_as_number(_casts(df, fields)[at][1], kind) for df in sides]
    if numbers[0] is None:
        return [None for _ in sides]
    known = [F.when((n > float("-inf")) & (n < float("inf")), n) for n in numbers]
    values = reduce(DataFrame.unionByName, [df.select(n.alias("n")) for df, n in zip(sides, known, strict=True)])
    low, high = values.agg(F.min("n"), F.max("n")).first()
    width = F.lit(max((high - low) / RANGES, 1e-300) if low is not None else 1.0)
    within = [F.floor((n - F.lit(low or 0.0)) / width) for n in known]
    return [F.coalesce(F.least(w, F.lit(RANGES - 1)).cast("int"), F.lit(-1)) for w in within]


@dataclass(frozen=True)
class Digests:
    """What the first scan of both sides tells: ranges that are unequal, rows of each side, rows for which each fact holds."""

    unequal: list[int]
    rows: tuple[int, int]
    facts: tuple[list[int], list[int]]


def range_digests(source: DataFrame, target: DataFrame) -> Digests:
    """Ranges whose rows on the two sides differ in number or in the sums of their 128-bit keys, and counts of all rows.

    What one side adds the other takes away, so sums stay small; they are added up before the one shuffle, which
    carries a row per range and task. Ranges with equal sums hold the same rows, copies included. Columns ``f0``, ``f1`` and
    so on, where a side has them, are counted along. The driver gets a row per range.
    """
    halves = [f(F.col(k)) for k in KEYS for f in (lambda c: F.shiftright(c, 32), lambda c: c.bitwiseAND(F.lit(0xFFFFFFFF)))]
    sides = (source, target)
    facts = [sum(c.startswith("f") for c in df.columns) for df in sides]
    digest = ["n", *[f"h{i}" for i in range(len(halves))]]
    counts = [f"r{side}" for side in (0, 1)] + [f"f{side}_{i}" for side in (0, 1) for i in range(facts[side])]

    def signed(side: int) -> DataFrame:
        sign, own = (1, -1)[side], {f"r{side}": F.lit(1)} | {f"f{side}_{i}": F.col(f"f{i}") for i in range(facts[side])}
        return sides[side].select(
            RANGE,
            F.lit(sign).cast("bigint").alias("n"),
            *[(h * sign).alias(f"h{i}") for i, h in enumerate(halves)],
            *[own.get(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        )

    sums = signed(0).unionByName(signed(1)).groupBy(RANGE).agg(*[F.sum(c).alias(c) for c in digest + counts])
    differs = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in digest])
    found = sums.select(RANGE, differs.alias("differs"), *counts).collect()
    total = {c: sum(r[c] for r in found) for c in counts}
    return Digests(
        sorted(r[RANGE] for r in found if r["differs"]),
        (total["r0"], total["r1"]),
        tuple([total[f"f{side}_{i}"] for i in range(facts[side])] for side in (0, 1)),
    )


def side_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Copies of each key on either side, with one shuffle that carries the key and two counts.

    Copies are added up before the shuffle, so a row that makes up a third of a table travels once per task.
    """

    def tagged(rows: DataFrame, s: int, t: int) -> DataFrame:
        return rows.select(*KEYS, F.lit(s).cast("bigint").alias("s"), F.lit(t).cast("bigint").alias("t"))

    return (
        tagged(source, 1, 0)
        .unionByName(tagged(target, 0, 1))
        .groupBy(*KEYS)
        .agg(F.sum("s").alias("source_copies"), F.sum("t").alias("target_copies"))
    )


def _places(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_word", F.pmod(KEYS[0], F.lit(TABLE_WORDS))).withColumn(
        "_bit", F.pmod(KEYS[1], F.lit(64)).cast("int")
    )


def _with_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One row behind each key in ``found``.

    Equal rows are left out where they are read, by a table of bits of fixed size; only what it lets through is
    shuffled, one row per key and task. Full tables let equal rows through as well, which the join then leaves out.
    """
    words = _places(found).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    near = _places(rows).join(F.broadcast(words), "_word").where("shiftrightunsigned(_bits, _bit) & 1 = 1")
    return near.drop("_word", "_bit", "_bits").dropDuplicates(KEYS).join(found, KEYS)


def compare(
    source: DataFrame,
    target: DataFrame,
    cols: Sequence[str] | None = None,
    multiset: bool = False,
    scales: Mapping[str, int] | None = None,
    sides: Sequence[str] = (SOURCE_ONLY, TARGET_ONLY),
    range_by: str | None = None,
) -> DataFrame:
    """Rows that one side holds and the other does not: ``side, row_hash, copies, data``.

    There is one record per distinct row; ``copies`` says how often it stands there. With ``multiset`` a row on
    both sides is reported too where the numbers of copies differ, on the side with more, ``copies`` being the surplus.
    Columns may have any names.

    A first scan of both sides compares digests of ranges (of the values of ``range_by``); ranges that agree are read no
    further, and nothing of them is shuffled. In the others keys only are compared and the differing ones written down;
    a last scan fetches their rows and drops the equal ones before anything else than keys is shuffled.
    """
    return compare_and_count(source, target, cols, multiset, scales, sides, range_by)[0]


def compare_and_count(
    source: DataFrame,
    target: DataFrame,
    cols: Sequence[str] | None = None,
    multiset: bool = False,
    scales: Mapping[str, int] | None = None,
    sides: Sequence[str] = (SOURCE_ONLY, TARGET_ONLY),
    range_by: str | None = None,
    source_facts: Sequence[Column] = (),
    target_facts: Sequence[Column] = (),
) -> tuple[DataFrame, Digests]:
    """``compare``, and what its first scan counts: the rows of each side and those for which each fact (a condition on
    any columns of that side) is true. The counts are sums of an aggregate, so a task that runs twice counts once."""
    fields = shared_columns(source, target, cols)
    if not fields.fields:
        raise ValueError("the two sides share no column")
    at = _ordered_by(fields, range_by)
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields.fields)])
    scales = {f"c{i}": scales[f.name] for i, f in enumerate(fields.fields) if f.name in scales} if scales else {}
    facts = (source_facts, target_facts)
    both = [_numbered(df, fields, some) for df, some in zip((source, target), facts, strict=True)]
    ranges = _range_columns(both, plain, at)
    counted = [
        with_keys(df, plain, scales, number, [f"f{i}" for i in range(len(some))])
        for df, number, some in zip(both, ranges, facts, strict=True)
    ]
    digests = range_digests(*counted)
    unequal = digests.unequal
    if not unequal:
        schema = "side string, row_hash string, copies bigint, data map<string,string>"
        return source.sparkSession.createDataFrame([], schema), digests
    keyed = {
        side: with_keys(df, plain, scales, number) for side, df, number in zip((SOURCE_ONLY, TARGET_ONLY), both, ranges, strict=True)
    }
    if len(unequal) <= RANGES // 2:
        keyed = {side: rows.where(F.col(RANGE).isin(unequal)) for side, rows in keyed.items()}
    surplus = F.col("source_copies") - F.col("target_copies")
    differs = surplus != 0 if multiset else (F.col("source_copies") == 0) | (F.col("target_copies") == 0)
    found = materialise(
        side_counts(keyed[SOURCE_ONLY], keyed[TARGET_ONLY])
        .filter(differs)
        .select(
            *KEYS,
            F.when(surplus > 0, SOURCE_ONLY).otherwise(TARGET_ONLY).alias("_side"),
            F.abs(surplus).alias("_copies"),
        )
        .filter(F.col("_side").isin(*sides))
    )
    pairs = [part for i, f in enumerate(fields.fields) for part in (F.lit(f.name), F.col(f"c{i}"))]

    def one_side(side: str) -> DataFrame:
        rows = _with_rows(keyed[side], found.filter(F.col("_side") == side).drop("_side"))
        return canonical_rows(rows, plain, scales, keep=["_copies"]).select(
            F.lit(side).alias("side"),
            F.col(HASH).alias("row_hash"),
            F.col("_copies").alias("copies"),
            F.create_map(*pairs).alias("data"),
        )

    return reduce(DataFrame.unionByName, [one_side(side) for side in sides]), digests


def only_in(
    left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None, scales: Mapping[str, int] | None = None
) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` lacks, values taken in the types of ``right``."""
    return compare(left, right, cols, scales=scales, sides=(SOURCE_ONLY,)).drop("side")


def only_in_target(
    source: DataFrame, target: DataFrame, cols: Sequence[str] | None = None, scales: Mapping[str, int] | None = None
) -> DataFrame:
    """Distinct rows of ``target`` that ``source`` lacks, values taken in the types of ``target``."""
    return compare(source, target, cols, scales=scales, sides=(TARGET_ONLY,)).drop("side")


def row_count(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: ``source_rows, target_rows, difference``, the difference without sign. No column is read."""

    def ones(df: DataFrame, s: int, t: int) -> DataFrame:
        return df.select(F.lit(s).cast("bigint").alias("s"), F.lit(t).cast("bigint").alias("t"))

    totals = ones(source, 1, 0).unionByName(ones(target, 0, 1)).agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    s, t = F.coalesce("s", F.lit(0)), F.coalesce("t", F.lit(0))
    return totals.select(s.alias("source_rows"), t.alias("target_rows"), F.abs(s - t).alias("difference"))
