"""Column functions on literal rows."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadwitness.functions import comments as C
from loadwitness.functions import jsonpath as J
from loadwitness.functions import scalars as S
from loadwitness.functions.rowhash import row_hash


def values(spark, build, rows, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, c {dtype}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("c"))).collect()]


@pytest.mark.parametrize(
    "comment, tag, payload, side",
    [
        ("present_only_in_source||a||b", "present_only_in_source", "a||b", "present_only_in_source"),
        ("present_only_in_source", "present_only_in_source", "", "present_only_in_source"),
        ("x present_only_in_destination y||", "x present_only_in_destination y", "", "present_only_in_destination"),
        ("other||present_only_in_source", "other", "present_only_in_source", "other"),
        ("", "", "", "other"),
    ],
)
def test_split_tag(spark, comment, tag, payload, side):
    assert values(spark, C.tag, [comment]) == [tag]
    assert values(spark, C.payload, [comment]) == [payload]
    assert values(spark, C.side, [comment]) == [side]


@pytest.mark.parametrize(
    "payload, text",
    [
        ('{"a":"1","b":"x","row_hash":"zz"}', "a: 1, b: x"),
        ('{"a":1,"b":2,"a":3}', "a: 3, b: 2"),
        ('{"a":null}', "a: None"),
        ("5", "5"),
        ("[1,2]", "[1,2]"),
        ('{"row_hash":"zz"}', ""),
        (" 7,F||" + "aF" * 32, "7,F"),
        ("7||" + "a" * 63, "7||" + "a" * 63),
        ("a||b||" + "0" * 64, "a||b"),
        ("", ""),
    ],
)
def test_render_payload(spark, payload, text):
    assert values(spark, C.render_payload, [payload]) == [text]


def test_schemas_are_cut_at_the_first_bracket(spark):
    comment = "Source Schema: [a: array<int>[x], b: int] Target Schema:[]"
    assert values(spark, C.source_schema, [comment, "Source Schema: none", None]) == ["[a: array<int>[x]", None, None]
    assert values(spark, C.target_schema, [comment]) == ["[]"]


def test_counts(spark):
    texts = [
        "Source Row Count: 7, Target: 8, Difference: 1",
        "Number of rows in Source:7 Target:8 Difference: -1",
        "nothing",
    ]
    assert values(spark, C.source_count, texts) == ["7", "7", None]
    assert values(spark, C.target_count, texts) == ["8", "8", None]
    assert values(spark, C.difference, texts) == ["1", None, None]


def test_format_pairs(spark):
    text = lambda sep: lambda c: C.pairs_text(C.format_pairs(c, sep))
    assert values(spark, text(", "), [" A: 1, B: x:y, none "]) == ["A: 1\nB: x:y\nnone"]
    assert values(spark, text(","), ["A: 1 ,B: 2"]) == ["A: 1\nB: 2"]
    keys = values(spark, lambda c: F.transform(C.format_pairs(c), lambda p: p["key"]), ["A: 1, :odd, none"])
    assert keys == [["A", None, None]]


def test_ids(spark):
    big = 900000000000000001
    assert values(spark, S.id_to_string, [big, None], "bigint") == [str(big), None]
    assert values(spark, S.cast_batch_id, ["12", "None", "", None]) == [12, None, None, None]
    assert values(spark, S.valid_batch, ["12", "None", "none", "", None]) == [True, False, False, False, False]


def test_names_and_links(spark):
    name = lambda c: S.report_name(c, F.lit(5))
    assert values(spark, name, ['a b/\\:*?"<>|c']) == ["Data_Validation_Report_a_bc_Batch_5"]
    assert values(spark, S.or_na, ["x", "", None]) == ["x", "N/A", "N/A"]
    link = lambda c: S.workspace_url("http://h/100%", c, F.lit(3))
    found = values(spark, link, [9, None], "bigint")
    assert found == ["http://h/100%/workspace?workspace_id=9&pipeline_id=3&active_tab=curationUI", "N/A"]
    assert values(spark, S.status_class, ["Success", "Failed", "SUCCESS", None]) == ["ok", "error", "neutral", "neutral"]


def test_json_paths(spark):
    text = '{"config":{"nodeName":"n","x":null},"id":"12","bad":"y"}'
    assert values(spark, lambda c: J.json_path_text(c, "config", "nodeName"), [text, "{}", None]) == ["n", None, None]
    assert values(spark, lambda c: J.json_path_text(c, "config", "x"), [text]) == [None]
    assert values(spark, lambda c: J.json_cast(c, "int", "id"), [text]) == [12]
    assert values(spark, lambda c: J.json_cast(c, "int", "bad", strict=False), [text]) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, lambda c: J.json_cast(c, "int", "bad"), [text])


def test_row_hash_tells_nulls_and_fields_apart(spark):
    schema = T.StructType().add("a", "string").add("b", "string")
    rows = [("a", None), (None, "a"), ("", None), (None, None), ("a", "b"), ("ab", ""), ("a:1", "b")]
    df = spark.createDataFrame(rows, schema)
    assert len({r[0] for r in df.select(row_hash(schema)).collect()}) == len(rows)
    one = spark.createDataFrame([("x", None)], schema).select(row_hash(schema)).first()[0]
    assert one == hashlib.sha256(b"1:x~").hexdigest()


def test_row_hash_of_numbers(spark):
    schema = T.StructType().add("a", "double")
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.005,), (1.0049,), (float("nan"),), (1e300,)], schema)
    exact = [r[0] for r in df.select(row_hash(schema)).collect()]
    assert exact[0] == exact[1] and len(set(exact)) == 5
    rounded = [r[0] for r in df.select(row_hash(schema, {"a": 2})).collect()]
    assert rounded[2] != rounded[3] and len(set(rounded)) == 5
