"""Status rules, workflows and lookups on literal rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loadwitness.operators import lookups, status, workflow
from loadwitness.operators.skew import salted_join


@pytest.mark.parametrize(
    "raw, code, wanted",
    [
        ("SUCCESS", 13, "Succeeded"),
        ("COMPLETED", 13, "Completed"),
        ("PROGRESS", 29, "Failed"),
        ("ERROR", 32, "Failed"),
        (None, 13, "Failed"),
        ("PROGRESS", 14, "Running"),
        ("PROGRESS", None, "Running"),
        ("ERROR", None, "Failed"),
        (None, None, "Waiting"),
        (None, 12, "Waiting"),
        ("SKIPPED", 13, None),
        ("success", None, None),
    ],
)
def test_normalise_status(spark, raw, code, wanted):
    df = spark.createDataFrame([(raw, code)], "s string, c int")
    assert df.select(status.normalise_status(F.col("s"), F.col("c"))).first()[0] == wanted


def test_latest_status(spark):
    t = datetime(2024, 1, 1)
    rows = [
        (1, 1, 1, 3, 12, t),
        (2, 1, 1, 25, 13, t),  # same time, higher id
        (3, 1, 1, 4, 32, datetime(2025, 1, 1)),  # other job type
        (4, 2, 1, 3, 29, datetime(2025, 1, 1)),
        (5, 2, 1, 3, 14, None),  # no time sorts as latest
    ]
    flow = spark.createDataFrame(
        rows, "flow_id long, data_movement_id long, batch_id long, job_type_id int, status_code_id int, flow_ts timestamp"
    )
    assert {r.data_movement_id: r.status_code_id for r in status.latest_status(flow).collect()} == {1: 13, 2: 14}


@pytest.mark.parametrize(
    "nodes, kind, wanted",
    [
        ([("Data Validation", "Succeeded")], "data", "Success"),
        ([("Data Validation", "Succeeded"), ("Saving Data Validation Result", "Failed")], "data", "Fail"),
        ([("Data Validation", "Completed")], "data", "NA"),
        ([("Data Validation", "Running")], "data", "NA"),
        ([("Data Validation", None), ("data validation 2", "Succeeded")], "data", "Success"),
        ([(None, "Failed"), ("", "Failed")], "data", "NA"),
        ([("Fetching Target Schema", "Failed")], "schema", "Fail"),
        ([("Fetching Target Schema", "Failed")], "ingestion", "Fail"),  # "target" is a keyword of ingestion too
    ],
)
def test_step_status(spark, nodes, kind, wanted):
    df = spark.createDataFrame([(1, 1, n, s) for n, s in nodes], "pipeline_id long, batch_id long, node_name string, status string")
    assert status.step_status(df).first()[kind] == wanted


def test_a_node_counts_once_per_step(spark):
    df = spark.createDataFrame([("Data Validation saving data validation result",), ("x",)], "node_name string")
    assert [r.validation_type for r in status.match_steps(df).collect()] == ["data"]


WORDS = [("data", "Data Val"), ("data", "data"), ("short", "x"), ("short", "va"), ("other", "nowhere"), ("none", ""), ("none", None)]
WORDS += [(None, "data"), ("long", "saving data validation result"), ("data.2", "é")]


@pytest.mark.parametrize("literals", [0, 500])
def test_keywords_of_a_table(spark, monkeypatch, literals):
    monkeypatch.setattr(status, "LITERALS", literals)
    words = spark.createDataFrame(WORDS, "validation_type string, keyword string")
    names = ["Data Validation", "saving data validation result", "x", "VA", "", None, "Ünrelated É", "v", "x"]
    states = ["Failed", "Succeeded", "Succeeded", None, "Failed", "Failed", "succeeded", "Failed", "FAILED"]
    rows = [(1 + i // 5, 7, i, n, s) for i, (n, s) in enumerate(zip(names, states))]
    nodes = spark.createDataFrame(rows, "pipeline_id long, batch_id long, object_id long, node_name string, status string")
    found = status.match_steps(nodes, words)
    assert found.columns == [*nodes.columns, "validation_type"]
    wanted = {(i, t) for _, _, i, n, _ in rows for t, w in WORDS if t and w and w.lower() in (n or "").lower()}
    assert sorted((r.object_id, r.validation_type) for r in found.collect()) == sorted(wanted)
    wide = {r.pipeline_id: r.asDict() for r in status.step_status(nodes, words).collect()}
    for pipeline in (1, 2):
        for step in ("data", "short", "other", "none", "long", "data.2"):
            seen = {str(s).upper() for p, _, i, _, s in rows if p == pipeline and (i, step) in wanted}
            state = "Fail" if "FAILED" in seen else "Success" if "SUCCEEDED" in seen else "NA"
            assert wide[pipeline][step] == state
    long = status.step_status_rows(status.step_status(nodes, words)).collect()
    assert {(r.pipeline_id, r.validation_type, r.step_status) for r in long} == {
        (p, t, v) for p, row in wide.items() for t, v in row.items() if t not in ("pipeline_id", "batch_id")
    }


def test_no_keywords_match_nothing(spark):
    nodes = spark.createDataFrame([(1, 1, "data", "Failed")], "pipeline_id long, batch_id long, node_name string, status string")
    none = spark.createDataFrame([], "validation_type string, keyword string")
    assert status.match_steps(nodes, none).collect() == [] and status.match_steps(nodes, {}).collect() == []
    assert status.step_status(nodes, none).columns == ["pipeline_id", "batch_id"]


def test_current_rows_of_text_and_time(spark):
    texts = spark.createDataFrame([("9999-12-31 00:00:00.000",), ("2024-01-01 00:00:00.000",)], "valid_to_ts string")
    assert status.current_rows(texts).count() == 1
    assert status.current_rows(texts.select(F.col("valid_to_ts").cast("timestamp"))).count() == 1


def nodes_of(spark, *configs):
    parts = ",".join(f'{{"nodeId":"{i + 1}","config":{c}}}' for i, c in enumerate(configs))
    text = '{"workflowJson":{"nodeDataArray":[' + parts + "]}}"
    return spark.createDataFrame([(1, text)], "workflow_orch_id long, workflow_orch_json string")


RUNS = "workflow_orch_id long, batch_id long, node_id long, node_batch_id long, status string"


def routed(spark, runs, *configs):
    node_runs = spark.createDataFrame(runs, RUNS)
    wanted = spark.createDataFrame([(1, 5)], "workflow_orch_id long, batch_id long")
    return workflow.workflow_nodes(wanted, nodes_of(spark, *configs), node_runs)


@pytest.mark.parametrize(
    "state, route", [("FAILED", "failed"), ("SUCCESS", "validate"), (None, "validate"), ("RUNNING", "pending")]
)
def test_route(spark, state, route):
    nodes = routed(spark, [(1, 5, 1, 50, state)], '{"name":"Ingestion pipeline","data_movement_name":"p"}')
    row = workflow.route_runs(nodes).first()
    assert (row.route, row.ingestion_status, row.ingestion_name) == (route, state, "p")


def test_route_without_ingestion(spark):
    assert workflow.route_runs(routed(spark, [], '{"name":"x"}')).first().route == "validate"


def test_last_node_of_a_name_wins_and_other_batches_do_not_count(spark):
    nodes = routed(
        spark,
        [(1, 5, 1, 50, "SUCCESS"), (1, 5, 2, 51, "FAILED"), (1, 4, 3, 52, "SUCCESS")],
        '{"name":"a","data_movement_id":"7"}',
        '{"name":"a","workflow_orch_id":"8"}',
        '{"name":"b"}',
        '{"name":""}',
        "{}",
    )
    found = {r.node_name: (r.pipeline_id, r.status) for r in workflow.node_details(nodes).collect()}
    assert found == {"a": ("8", "FAILED"), "b": (None, None)}
    assert sorted(r.pos for r in workflow.exclude_nodes(nodes, ["a"]).collect()) == [2, 3]


def test_no_list_gives_no_row(spark):
    df = spark.createDataFrame([(1, '{"workflowJson":{}}'), (2, None)], "workflow_orch_id long, workflow_orch_json string")
    assert workflow.explode_nodes(df).count() == 0


def test_lookup_reports_missing_keys(spark):
    table = spark.createDataFrame(
        [("a", 2, "9999-12-31 00:00:00.000"), ("a", 1, "9999-12-31 00:00:00.000"), ("b", 3, "2024-01-01 00:00:00.000")],
        "name string, id int, valid_to_ts string",
    )
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    found = {r.name: (r.id, r.found) for r in lookups.lookup_current(keys, table, "name", "id").collect()}
    assert found == {"a": (1, True), "b": (None, False), "c": (None, False)}


def test_salted_join_keeps_every_row(spark):
    big = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    small = spark.range(1500).selectExpr("id AS k", "id * 10 AS w")
    for how in ("inner", "left", "left_semi"):
        ours = salted_join(big, small, ["k"], ["v"], how).select(*big.join(small, "k", how).columns)
        assert sorted(map(str, ours.collect())) == sorted(map(str, big.join(small, "k", how).collect()))
    with pytest.raises(ValueError):
        salted_join(big, small, ["k"], ["v"], "full")
