"""Truth tables of the verdict rules under the three rule sets."""

import pytest

from loadwitness.operators.results import discrepancies, discrepancy_counts, preview, with_totals
from loadwitness.operators.status import KEYWORDS
from loadwitness.plans.report import discrepancy_report, report_step
from loadwitness.plans.verdict import verdicts

RESULTS = "seq long, batch_id long, validation_type string, comment string"
RUNS = """seq long, dataflow_batch_id long, pipeline_id long, batch_id long, pipeline_name string, status string,
          ingestion_status string, ingestion_name string"""
BOTH = "Source Schema: [a: int] Target Schema: [a: int]"


def run_of(spark, status="SUCCESS", ingestion="SUCCESS"):
    return spark.createDataFrame([(1, 9, 1, 7, "p", status, ingestion, "ing")], RUNS)


def steps_of(spark, state):
    kinds = ", ".join(f"{k} string" for k in KEYWORDS)
    return spark.createDataFrame([(1, 7, *[state] * len(KEYWORDS))], f"pipeline_id long, batch_id long, {kinds}")


def results_of(spark, *rows):
    return spark.createDataFrame([(i, 7, kind, text) for i, (kind, text) in enumerate(rows)], RESULTS)


def judge(spark, rules, step, *rows, state="Success", **run):
    found = verdicts(results_of(spark, *rows), steps_of(spark, state), run_of(spark, **run), rules)
    row = found.filter(f"step_id = {step}").first()
    return row.execution_status, row.verdict


CASES = [
    # step, comments, verdict under r1, r2, r3
    (2, [], "Pass", "Fail", "Fail"),
    (2, [("schemas", BOTH)], "Pass", "Pass", "Pass"),
    (2, [("schemas", "Source Schema: [a: int]")], "Pass", "Fail", "Fail"),
    (2, [("schemas", "Source Schema: [N/A] Target Schema: [a: int]")], "Pass", "Fail", "Fail"),
    (2, [("schemas", ""), ("schemas", BOTH)], "Pass", "Pass", "Pass"),
    (2, [("schemas", BOTH), ("schemas", "")], "Pass", "Fail", "Fail"),
    (2, [("schemas", BOTH), ("schema", "x")], "Fail", "Fail", "Fail"),
    (3, [], "NA", "Pass", "Pass"),
    (3, [("data", "other||x")], "Pass", "Pass", "Pass"),
    (3, [("data", "present_only_in_source")], "Fail", "Fail", "Fail"),
    (3, [("data", "present_only_in_destination||{}")], "Fail", "Fail", "Fail"),
    (4, [], "NA", "NA", "NA"),
    (4, [("row_count", "Difference: 0")], "Pass", "Pass", "Pass"),
    (4, [("row_count", "Difference: 00")], "Fail", "Fail", "Fail"),
    (4, [("row_count", "Difference: -1")], "Fail", "Fail", "Fail"),
    (4, [("row_count", "Difference: 0"), ("row_count", "Difference: 4")], "Pass", "Pass", "Pass"),
    (4, [("row_count", "Difference: 4"), ("row_count", "Difference: 0")], "Fail", "Fail", "Fail"),
    (5, [], "NA", "NA", "NA"),
    (5, [("uniqueness", "unique")], "Pass", "Pass", "Pass"),
    (5, [("uniqueness", "unique"), ("uniqueness", "Not_Unique")], "Fail", "Fail", "Fail"),
    (5, [("uniqueness", "Failed")], "Fail", "Pass", "Pass"),
    (6, [], "NA", "NA", "NA"),
    (6, [("not_null", "No NULLs")], "Pass", "Pass", "Pass"),
    (6, [("not_null", "NULLs Exist")], "Fail", "Fail", "Fail"),
    (6, [("not_null", "nulls exist")], "Fail", "Fail", "Pass"),
    (6, [("not_null", "check failed")], "Fail", "Pass", "Pass"),
]


@pytest.mark.parametrize("step, rows, r1, r2, r3", CASES)
def test_rules(spark, step, rows, r1, r2, r3):
    found = {rules: judge(spark, rules, step, *rows)[1] for rules in ("r1", "r2", "r3")}
    assert found == {"r1": r1, "r2": r2, "r3": r3}


@pytest.mark.parametrize("state", ["Fail", "NA"])
@pytest.mark.parametrize("rules", ["r1", "r2", "r3"])
def test_only_executed_steps_are_judged(spark, rules, state):
    assert judge(spark, rules, 4, ("row_count", "Difference: 0"), state=state) == (state, "NA")


@pytest.mark.parametrize(
    "status, r2, r3",
    [("SUCCESS", "Success", "Success"), ("success", "NA", "Success"), ("FAILED", "NA", "Fail"), (None, "NA", "Fail")],
)
def test_gate(spark, status, r2, r3):
    assert judge(spark, "r2", 3, status=status)[0] == r2
    assert judge(spark, "r3", 3, status=status)[0] == r3
    assert judge(spark, "r1", 3, status=status)[0] == "Success"


def test_ingestion(spark):
    by_ingestion = {s: judge(spark, "r3", 1, ingestion=s)[1] for s in ("SUCCESS", "FAILED", "RUNNING", None)}
    assert by_ingestion == {"SUCCESS": "Pass", "FAILED": "Fail", "RUNNING": "NA", None: "NA"}
    assert judge(spark, "r2", 1, status="FAILED", ingestion="SUCCESS") == ("FAILED", "Fail")
    assert judge(spark, "r1", 1)[1] == "NA"
    assert judge(spark, "r1", 1, ("ingestion", "done"))[1] == "Pass"
    assert judge(spark, "r1", 1, ("ingestion", "done"), state="Fail")[1] == "NA"


def test_runs_without_nodes_or_comments_keep_their_six_rows(spark):
    nothing = steps_of(spark, "Success").filter("false")
    found = verdicts(results_of(spark), nothing, run_of(spark))
    assert [(r.execution_status, r.verdict) for r in found.orderBy("step_id").collect()] == [("SUCCESS", "Pass")] + [("NA", "NA")] * 5


def test_unknown_rule_set(spark):
    with pytest.raises(ValueError):
        judge(spark, "r4", 3)


def data_rows(n):
    return [("data", f"present_only_in_source||{i}") for i in range(n)]


@pytest.mark.parametrize("n, inline", [(0, 0), (10, 10), (11, 0)])
def test_no_list_is_cut(spark, n, inline):
    found = discrepancies(results_of(spark, *data_rows(n)))
    listed = preview(found).collect()
    assert len(listed) == n == with_totals(found).count()
    assert sum(r.inline for r in listed) == inline
    assert sorted(r.line_no for r in listed if r.inline) == list(range(1, inline + 1))
    assert all(r.total == n for r in listed)


def test_unknown_tags_count_in_the_total_only(spark):
    found = discrepancies(results_of(spark, *data_rows(2), ("data", "other||x")))
    assert discrepancy_counts(found).first()[1:] == (2, 0, 3)


def report_lines_of(spark, *rows):
    found = discrepancy_report(run_of(spark), results_of(spark, *rows), steps_of(spark, "Success"))
    return [r.text for r in found.orderBy("section", "seq").collect()]


def test_discrepancy_report(spark):
    rows = [("data", "present_only_in_destination||b"), ("data", 'present_only_in_source||{"k":1}'), ("data", "other||x")]
    assert report_lines_of(spark, *rows) == [
        "Total Discrepancies: 2",
        "- Present only in Source: 1",
        "- Present only in Destination: 1",
        "Data: k: 1",
        "Data: b",
    ]
    assert report_lines_of(spark, ("data", "other||x")) == ["No Data Discrepancies Found."]
    assert report_lines_of(spark, ("row_count", "Difference: 0")) == []


def test_failed_execution_is_said(spark):
    found = report_step(run_of(spark), results_of(spark), steps_of(spark, "Fail"))
    row = found.filter("step_id = 5").first()
    assert row.actual == ["Node Execution Status: Fail", "N/A (Execution Failed)"]
    assert row.expected[0].startswith("1. Mandatory")
