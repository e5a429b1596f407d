"""Comparison against brute force, and its laws."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadwitness.functions.comments import SOURCE_ONLY, TARGET_ONLY
from loadwitness.operators import checks
from loadwitness.operators import compare as cmp
from loadwitness.operators.compare import compare, only_in, only_in_target, row_count

SCHEMA = "k bigint, t string, x double"
ROW = st.tuples(
    st.one_of(st.none(), st.integers(0, 3)), st.sampled_from([None, "", "a", "ab"]), st.sampled_from([None, 0.0, 1.25, -2.5])
)


def listed(found):
    out = Counter()
    for r in found.collect():
        assert len(r.row_hash) == 64
        out[(r.side, tuple(r.data[c] for c in ("k", "t", "x")))] = r.copies
    return out


def text(row):
    return tuple(None if v is None else str(v) for v in row)


def expected(a, b, multiset):
    a, b = Counter(map(text, a)), Counter(map(text, b))
    if multiset:
        left, right = a - b, b - a
    else:
        left = Counter({r: n for r, n in a.items() if r not in b})
        right = Counter({r: n for r, n in b.items() if r not in a})
    out = Counter({(SOURCE_ONLY, r): n for r, n in left.items()})
    out.update({(TARGET_ONLY, r): n for r, n in right.items()})
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=st.lists(ROW, max_size=12), b=st.lists(ROW, max_size=12), multiset=st.booleans())
def test_against_brute_force(spark, a, b, multiset):
    src, tgt = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    found = compare(src, tgt, multiset=multiset)
    assert listed(found) == expected(a, b, multiset)


def test_nothing_differs_from_itself(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, "a", 0.5), (None, None, None)], SCHEMA)
    assert compare(df, df, multiset=True).count() == 0


def test_sides_mirror(spark):
    a = spark.createDataFrame([(1, "a", 0.5), (2, None, 0.5)], SCHEMA)
    b = spark.createDataFrame([(1, "a", 0.5), (None, "2", 0.5)], SCHEMA)
    assert {r.row_hash for r in only_in(a, b).collect()} == {r.row_hash for r in only_in_target(b, a).collect()}


def test_copies_balance(spark):
    a = spark.createDataFrame([(1, "a", 0.5)] * 7 + [(2, "b", 0.5)], SCHEMA)
    b = spark.createDataFrame([(1, "a", 0.5)] * 4 + [(3, "b", 0.5)] * 2, SCHEMA)
    rows = compare(a, b, multiset=True).collect()
    signed = sum(r.copies if r.side == SOURCE_ONLY else -r.copies for r in rows)
    assert signed == a.count() - b.count()


@pytest.mark.parametrize("words", [1, 1 << 18])
def test_a_dominant_row_is_reported_once_with_its_copies(spark, words, monkeypatch):
    monkeypatch.setattr("loadwitness.operators.compare.TABLE_WORDS", words)
    a = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id) AS k", "'t' AS t", "0.5D AS x")
    b = a.filter("k >= 0")
    rows = compare(a, b).collect()
    assert [(r.side, r.copies, r.data["k"]) for r in rows] == [(SOURCE_ONLY, 10_000, "-1")]


def test_order_and_case_of_columns_do_not_count(spark):
    a = spark.createDataFrame([(1, "a")], "K bigint, t string")
    b = spark.createDataFrame([("a", 1)], "T string, k bigint")
    assert compare(a, b).count() == 0


def test_values_that_do_not_convert_are_discrepancies(spark):
    a = spark.createDataFrame([("1",), ("x",), (None,), ("2024-13-01",)], "d string")
    b = spark.createDataFrame([(1,), (None,)], "d int")
    assert {r.data["d"] for r in compare(a, b, sides=[SOURCE_ONLY]).collect()} == {"x", "2024-13-01"}
    assert compare(a, b, sides=[TARGET_ONLY]).count() == 0


def test_scale_rounds_doubles(spark):
    a = spark.createDataFrame([(1.001,), (1e20,), (float("nan"),)], "x double")
    b = spark.createDataFrame([(1.002,), (1e20,), (float("nan"),)], "x double")
    assert compare(a, b).count() == 2
    assert compare(a, b, scales={"x": 2}).count() == 0


def test_empty_sides(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, "a", 0.5)], SCHEMA)
    assert listed(compare(none, one)) == {(TARGET_ONLY, ("1", "a", "0.5")): 1}
    assert listed(compare(one, none)) == {(SOURCE_ONLY, ("1", "a", "0.5")): 1}
    assert row_count(none, none).first().asDict() == {"source_rows": 0, "target_rows": 0, "difference": 0}


def test_unknown_columns_are_refused(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="not on both sides"):
        compare(df, df, ["b"])
    with pytest.raises(ValueError, match="no column"):
        compare(df, df.withColumnRenamed("a", "b"))


def test_duplicates_ignore_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (1, None), (2, 2), (2, 2)], "a int, b int")
    assert [tuple(r) for r in checks.duplicate_groups(df, ["a", "b"]).collect()] == [(2, 2, 2)]
    per_column = {r.column_name: (r.status, r.comment) for r in checks.check_unique(df, ["a", "b"]).collect()}
    assert per_column == {
        "a": ("failed", "Column: a, Status: NOT_UNIQUE, Duplicates: 5"),
        "b": ("failed", "Column: b, Status: NOT_UNIQUE, Duplicates: 2"),
    }


def test_empty_target_passes_its_checks(spark):
    none = spark.createDataFrame([], "a int")
    assert checks.check_unique(none, ["a"]).first().status == "passed"
    assert checks.check_not_null(none, ["a"]).first().comment == "Column: a, Result: No NULLs, Count: 0"


def test_schema_check(spark):
    a = spark.createDataFrame([("1", "2024-01-01", 1, 1)], "Id string, day string, only_a int, n int")
    b = spark.createDataFrame([], "id int, day date, only_b int, n bigint")
    found = {r.column_name: r for r in checks.schema_pairs(a, b, {"string": ["date"]}).collect()}
    assert {n for n, r in found.items() if r.fits} == {"day"}
    assert found["only_a"].target_type is None and found["only_b"].source_type is None
    comments = {r.column_name: r.comment for r in checks.check_schema(a, b, {"string": ["date"]}).collect()}
    assert comments["n"] == "Column n: source int, target bigint"
    assert comments["only_b"] == "Column only_b: source missing, target int"
    assert comments[None].endswith("Target Schema: [id: int, day: date, only_b: int, n: bigint]")
    dirty = a.withColumn("day", a["Id"] * 0 + 1).selectExpr("cast('soon' as string) AS day")
    row = checks.schema_pairs(dirty, b.select("day"), {"string": ["date"]}).first()
    assert (row.fits, row.unconvertible) == (False, 1)


def test_what_a_conversion_loses_is_a_discrepancy(spark):
    a = spark.sql(
        "SELECT 1.7D AS n, timestamp_ntz'2024-01-01 10:00:00' AS d, '2024-01-01 23:59:59' AS t, '1.239' AS x"
        " UNION ALL SELECT 2D, timestamp_ntz'2024-01-02 00:00:00', '2024-01-02', '1.20'"
    )
    b = spark.sql("SELECT 1 AS n, date'2024-01-01' AS d, date'2024-01-01' AS t, 1.24BD AS x UNION ALL SELECT 2, date'2024-01-02', date'2024-01-02', 1.2BD")
    for column in ("n", "d", "t", "x"):
        found = compare(a, b, cols=[column]).collect()
        assert sorted(r.side for r in found) == sorted([SOURCE_ONLY, TARGET_ONLY]), column


def test_times_inside_nested_values_keep_microseconds(spark):
    one = "SELECT array(timestamp'2024-01-01 00:00:00.{0}') AS a, named_struct('t', timestamp'2024-01-01 00:00:00.{0}', 'z', {1}) AS s, map('k', array({1})) AS m"
    a, b = spark.sql(one.format("123456", "0.0D")), spark.sql(one.format("123999", "-0.0D"))
    for column, differ in (("a", 2), ("s", 2), ("m", 0)):
        assert compare(a, b, cols=[column]).count() == differ, column
    assert compare(a, a).count() == 0


def test_columns_may_have_the_names_of_helpers(spark):
    names = ["_word", "_bit", "_v0", "_copies", "_key_1", "_range", "_side", "c1", "_row_hash"]
    schema = ", ".join(f"`{n}` int" for n in names)
    source = spark.createDataFrame([tuple(range(9)), (1,) * 9], schema)
    target = spark.createDataFrame([tuple(range(9)), (2,) * 9], schema)
    found = {r["side"]: r["data"] for r in cmp.compare(source, target).collect()}
    assert found == {SOURCE_ONLY: dict.fromkeys(names, "1"), TARGET_ONLY: dict.fromkeys(names, "2")}


def shuffled_rows(spark, monkeypatch, source, target, **how):
    """What the comparison of keys is given, and the rows that are found."""
    given = []

    def watch(a, b, real=cmp.side_counts):
        given.append(a.count() + b.count())
        return real(a, b)

    monkeypatch.setattr(cmp, "side_counts", watch)
    return cmp.compare(source, target, **how).count(), sum(given)


def test_equal_ranges_are_not_shuffled(spark, monkeypatch):
    """A tenth of all rows differ, as a load that went wrong does: nothing but their ranges is read again."""
    source = spark.range(100_000).select("id", (F.col("id") * 3).alias("n"), F.lit("x").alias("t"))
    target = source.withColumn("t", F.when(F.col("id").between(40_000, 49_999), "y").otherwise(F.col("t")))
    found, given = shuffled_rows(spark, monkeypatch, source, target)
    assert found == 20_000 and 20_000 <= given <= 20_200
    found, given = shuffled_rows(spark, monkeypatch, source, target, range_by="n")
    assert found == 20_000 and given <= 20_200
    assert shuffled_rows(spark, monkeypatch, source, source.select("t", "n", "id")) == (0, 0)


@pytest.mark.parametrize("kind", ["bigint", "double", "date", "timestamp", "decimal(20,4)", "string", "boolean"])
def test_ranges_decide_nothing(spark, kind):
    """Whatever the type of the column that makes ranges, nulls, copies and values at both ends are compared alike."""
    base = spark.range(50).select(
        (F.col("id") % 2 if kind == "boolean" else F.timestamp_seconds("id") if kind in ("date", "timestamp") else F.col("id"))
        .cast(kind).alias("k"), F.col("id").alias("n"),
    )
    none = base.limit(1).select(F.lit(None).cast(kind).alias("k"), F.lit(-1).cast("bigint").alias("n"))
    source, target = base.unionByName(none).unionByName(base.where("n = 7")), base.where("n <> 3").unionByName(none.withColumn("n", F.lit(-2)))
    found = sorted((r["side"], r["data"]["n"], r["copies"]) for r in cmp.compare(source, target).collect())
    assert found == sorted([(SOURCE_ONLY, "-1", 1), (SOURCE_ONLY, "3", 1), (TARGET_ONLY, "-2", 1)])
    surplus = sorted((r["side"], r["data"]["n"]) for r in cmp.compare(source, target, multiset=True).collect())
    assert surplus == sorted([(SOURCE_ONLY, "-1"), (SOURCE_ONLY, "3"), (TARGET_ONLY, "-2"), (SOURCE_ONLY, "7")])
    assert cmp.compare(none, none).collect() == [] and cmp.compare(base.where("false"), base.where("false")).collect() == []


def test_uniqueness_of_all_keys_in_one_scan(spark, tmp_path):
    rows = [(1, "a", 0.0, None), (2, "a", -0.0, "x"), (2, None, float("nan"), "x"), (None, None, float("nan"), "y")]
    spark.createDataFrame(rows, "a int, b string, c double, d string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    keys = [["a"], ["b"], ["c"], ["a", "d"], ["b", "c"], ["a", "b", "c", "d"]]
    found = checks.duplicate_summary(df, keys)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    for key, row in zip(keys, found.collect(), strict=True):
        groups = checks.duplicate_groups(df, key).collect()
        assert (row["column_name"], row["duplicate_groups"]) == (" + ".join(key), len(groups))
        assert row["duplicate_rows"] == sum(g["copies"] for g in groups)


def test_checks_from_one_scan_agree_with_checks_of_their_own(spark):
    """Nulls, values that lose something, columns that are not compared, columns named as helpers are, empty sides."""
    a = spark.sql(
        "SELECT CAST(id AS STRING) AS id, IF(id % 5 = 0, null, IF(id % 7 = 0, 'never', '2024-01-02')) AS day, id AS f0, 1 AS more FROM range(200)"
    )
    b = spark.sql(
        "SELECT CAST(id AS STRING) AS id, IF(id % 5 = 0, null, date'2024-01-02') AS day, IF(id % 3 = 0, null, id) AS F0, null AS other FROM range(20, 230)"
    )
    compat, columns = {"string": ["date"]}, ["id", "day", "other", "F0"]
    for left, right, cols in [(a, b, None), (a, b, ["id", "day"]), (a.limit(0), b, None), (a, b.limit(0), ["F0"]), (b, b, None)]:
        apart = [
            checks.check_schema(left, right, compat),
            checks.check_data(left, right, cols),
            checks.check_row_count(left, right),
            checks.check_not_null(right, columns),
        ]
        rows = sorted(repr(r) for df in apart for r in df.collect())
        together = checks.check_sides(left, right, compat, cols, not_null=columns)
        assert sorted(map(repr, together.collect())) == rows
    assert checks.schema_probes(a, b, compat).keys() == {"day"}
