"""The five checks. Each returns rows of the result table (``RESULT_COLUMNS``), less the run's ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwitness.operators.compare import compare, compare_and_count, converts, row_count

RESULT_COLUMNS = ["validation_type", "column_name", "status", "metrics", "comment"]

# Words of the comments that the verdict rules look for.
NOT_UNIQUE = "NOT_UNIQUE"
NULLS_EXIST = "NULLs Exist"

# Between the columns of a composite key: comments are cut at commas.
KEY_SEPARATOR = " + "


def _metrics(**values) -> F.Column:
    pairs = [part for name, value in values.items() for part in (F.lit(name), value.cast("bigint"))]
    return F.create_map(*pairs).alias("metrics")


def duplicate_groups(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of ``copies``. A key with a null part is no duplicate."""
    known = reduce(and_, [F.col(c).isNotNull() for c in cols])
    return df.select(*cols).filter(known).groupBy(*cols).agg(F.count("*").alias("copies")).filter("copies > 1")


def duplicate_summary(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """A row per key (a list of columns): ``column_name, duplicate_groups, duplicate_rows``, all from one scan and one shuffle.

    Rows are expanded to the number and a 128-bit hash of each key that has no null part, counted before the shuffle; so
    a value that a third of the rows hold is a row per task. Two values share a hash with a chance of 1 to 10^38.
    """

    def hashed(i: int, cols: Sequence[str]) -> F.Column:
        known = reduce(and_, [F.col(c).isNotNull() for c in cols])
        halves = F.struct(
            F.lit(i).alias("key"), F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *reversed(cols)).alias("b")
        )
        return F.when(known, halves)

    named = df.select(F.explode(F.array(*[hashed(i, cols) for i, cols in enumerate(keys)])).alias("k")).where("k IS NOT NULL")
    repeated = named.groupBy("k.key", "k.a", "k.b").agg(F.count("*").alias("copies")).where("copies > 1")
    mine = [F.col("key") == i for i in range(len(keys))]
    counts = [
        F.struct(
            F.lit(KEY_SEPARATOR.join(cols)).alias("column_name"),
            F.count_if(mine[i]).alias("duplicate_groups"),
            F.coalesce(F.sum(F.when(mine[i], F.col("copies"))), F.lit(0).cast("bigint")).alias("duplicate_rows"),
        ).alias(f"k{i}")
        for i, cols in enumerate(keys)
    ]
    return repeated.agg(*counts).select(F.inline(F.array(*[f"k{i}" for i in range(len(keys))])))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: ``column_name, nulls, total_rows``, all from one pass."""
    counts = df.agg(
        F.count("*").alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    )
    per_column = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(cols)])
    return counts.select("total_rows", F.inline(per_column)).select("column_name", "nulls", "total_rows")


def schema_probes(
    source: DataFrame, target: DataFrame, compat: Mapping[str, Sequence[str]] | None = None
) -> dict[str, F.Column]:
    """By column (in lower case) of another type that ``compat`` declares: whether a source value does not convert without
    loss."""
    right = {f.name.lower(): f for f in target.schema.fields}
    probes = {}
    for s in source.schema.fields:
        t = right.get(s.name.lower())
        if t is None or s.dataType.simpleString() == t.dataType.simpleString():
            continue
        if t.dataType.simpleString() in (compat or {}).get(s.dataType.simpleString(), ()):
            raw = F.col(f"`{s.name}`")
            probes[s.name.lower()] = raw.isNotNull() & ~converts(raw, s.dataType, t.dataType)
    return probes


def schema_pairs(
    source: DataFrame,
    target: DataFrame,
    compat: Mapping[str, Sequence[str]] | None = None,
    counted: Mapping[str, int] | None = None,
) -> DataFrame:
    """Columns of both sides by name (case does not count): types, position, whether they fit.

    A source type fits an equal target type, or one that ``compat`` declares if every value converts without loss. Values are read
    for declared pairs only, all in one pass; without such pairs, or with what ``schema_probes`` found ``counted`` already, no
    data is read.
    """
    left = {f.name.lower(): (i, f) for i, f in enumerate(source.schema.fields)}
    right = {f.name.lower(): (i, f) for i, f in enumerate(target.schema.fields)}
    probes = schema_probes(source, target, compat)
    place = {key: i for i, key in enumerate(probes)}
    rows = []
    for key in [*left, *[k for k in right if k not in left]]:
        s_pos, s = left.get(key, (None, None))
        t_pos, t = right.get(key, (None, None))
        s_type = s.dataType.simpleString() if s else None
        t_type = t.dataType.simpleString() if t else None
        bad, fits = F.lit(0).cast("bigint"), F.lit(s_type == t_type)
        if key in probes:
            bad = F.col(f"n{place[key]}") if counted is None else F.lit(counted[key]).cast("bigint")
            fits = bad == 0
        rows.append(
            F.struct(
                F.lit(s.name if s else t.name).alias("column_name"),
                F.lit(s_type).cast("string").alias("source_type"),
                F.lit(t_type).cast("string").alias("target_type"),
                F.lit(s_pos).cast("int").alias("source_pos"),
                F.lit(t_pos).cast("int").alias("target_pos"),
                bad.alias("unconvertible"),
                fits.alias("fits"),
            )
        )
    sums = [F.count_if(bad).alias(f"n{place[key]}") for key, bad in probes.items()]
    probed = source.agg(*sums) if sums and counted is None else source.sparkSession.range(1)
    return probed.select(F.inline(F.array(*rows)))


def _schema_text(df: DataFrame) -> str:
    return "[" + ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in df.schema.fields) + "]"


def check_schema(
    source: DataFrame,
    target: DataFrame,
    compat: Mapping[str, Sequence[str]] | None = None,
    counted: Mapping[str, int] | None = None,
) -> DataFrame:
    """One ``schemas`` row with both schemas, one ``schema`` row per column that does not fit."""
    pairs = schema_pairs(source, target, compat, counted)
    both = f"Source Schema: {_schema_text(source)} Target Schema: {_schema_text(target)}"
    bad = F.count_if(~F.col("fits"))
    head = pairs.agg(F.count("*").alias("n"), bad.alias("bad")).select(
        F.lit("schemas").alias("validation_type"),
        F.lit(None).cast("string").alias("column_name"),
        F.when(F.col("bad") == 0, "passed").otherwise("failed").alias("status"),
        _metrics(columns=F.col("n"), mismatches=F.col("bad")),
        F.lit(both).alias("comment"),
    )
    rows = pairs.filter(~F.col("fits")).select(
        F.lit("schema").alias("validation_type"),
        "column_name",
        F.lit("failed").alias("status"),
        _metrics(unconvertible=F.col("unconvertible")),
        F.concat(
            F.lit("Column "),
            "column_name",
            F.lit(": source "),
            F.coalesce("source_type", F.lit("missing")),
            F.lit(", target "),
            F.coalesce("target_type", F.lit("missing")),
        ).alias("comment"),
    )
    return head.unionByName(rows)


def check_data(
    source: DataFrame,
    target: DataFrame,
    cols: Sequence[str] | None = None,
    multiset: bool = False,
    scales: Mapping[str, int] | None = None,
) -> DataFrame:
    """One ``data`` row per row that stands on one side only: tag, double bar, row as JSON with its hash."""
    return _data_rows(compare(source, target, cols, multiset, scales))


def _data_rows(differing: DataFrame) -> DataFrame:
    with_hash = F.map_concat("data", F.create_map(F.lit("row_hash"), F.col("row_hash")))
    return differing.select(
        F.lit("data").alias("validation_type"),
        F.lit(None).cast("string").alias("column_name"),
        F.lit("failed").alias("status"),
        _metrics(copies=F.col("copies")),
        F.concat("side", F.lit("||"), F.to_json(with_hash, {"ignoreNullFields": "false"})).alias("comment"),
    )


def check_row_count(source: DataFrame, target: DataFrame) -> DataFrame:
    """One ``row_count`` row."""
    return _row_count_rows(row_count(source, target))


def _row_count_rows(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.lit("row_count").alias("validation_type"),
        F.lit(None).cast("string").alias("column_name"),
        F.when(F.col("difference") == 0, "passed").otherwise("failed").alias("status"),
        _metrics(source=F.col("source_rows"), target=F.col("target_rows"), difference=F.col("difference")),
        F.format_string(
            "Source Row Count: %d, Target: %d, Difference: %d", "source_rows", "target_rows", "difference"
        ).alias("comment"),
    )


def check_unique(target: DataFrame, cols: Sequence[str], composite: bool = False) -> DataFrame:
    """One ``uniqueness`` row per column, or one for all columns as a composite key."""
    return check_keys(target, [list(cols)] if composite else [[c] for c in cols])


def check_keys(target: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """One ``uniqueness`` row per key, which is one column or several."""
    unique = F.col("duplicate_groups") == 0
    return duplicate_summary(target, keys).select(
        F.lit("uniqueness").alias("validation_type"),
        "column_name",
        F.when(unique, "passed").otherwise("failed").alias("status"),
        _metrics(groups=F.col("duplicate_groups"), rows=F.col("duplicate_rows")),
        F.concat(
            F.lit("Column: "),
            "column_name",
            F.lit(", Status: "),
            F.when(unique, "UNIQUE").otherwise(NOT_UNIQUE),
            F.lit(", Duplicates: "),
            F.col("duplicate_rows").cast("string"),
        ).alias("comment"),
    )


def check_not_null(target: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One ``not_null`` row per column."""
    return _not_null_rows(null_counts(target, cols))


def _not_null_rows(counts: DataFrame) -> DataFrame:
    clean = F.col("nulls") == 0
    return counts.select(
        F.lit("not_null").alias("validation_type"),
        "column_name",
        F.when(clean, "passed").otherwise("failed").alias("status"),
        _metrics(nulls=F.col("nulls"), rows=F.col("total_rows")),
        F.concat(
            F.lit("Column: "),
            "column_name",
            F.lit(", Result: "),
            F.when(clean, "No NULLs").otherwise(NULLS_EXIST),
            F.lit(", Count: "),
            F.col("nulls").cast("string"),
        ).alias("comment"),
    )


def check_sides(
    source: DataFrame,
    target: DataFrame,
    compat: Mapping[str, Sequence[str]] | None = None,
    cols: Sequence[str] | None = None,
    multiset: bool = False,
    scales: Mapping[str, int] | None = None,
    not_null: Sequence[str] = (),
) -> DataFrame:
    """The rows of ``check_schema``, ``check_data``, ``check_row_count`` and, for the columns in ``not_null``,
    ``check_not_null``: row counts, nulls and values that do not convert are counted in the comparison's first scan, so
    none of them reads a side again."""
    spark, probes = source.sparkSession, schema_probes(source, target, compat)
    nulls = [F.col(c).isNull() for c in not_null]
    differing, seen = compare_and_count(
        source, target, cols, multiset, scales, source_facts=list(probes.values()), target_facts=nulls
    )
    a, b = seen.rows
    counts = spark.createDataFrame([(a, b, abs(a - b))], "source_rows bigint, target_rows bigint, difference bigint")
    frames = [
        check_schema(source, target, compat, dict(zip(probes, seen.facts[0], strict=True))),
        _data_rows(differing),
        _row_count_rows(counts),
    ]
    if nulls:
        found = [(c, n, b) for c, n in zip(not_null, seen.facts[1], strict=True)]
        frames.append(_not_null_rows(spark.createDataFrame(found, "column_name string, nulls bigint, total_rows bigint")))
    return reduce(DataFrame.unionByName, frames)
