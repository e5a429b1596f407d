"""Verdict rules, under all three rule sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadwitness.operators.results import RULES
from loadwitness.plans.verdict import verdicts_under
from loadwitness.registry import query
from loadwitness.registry.inputs import wide_status


def under_all_rules(d):
    return verdicts_under(d.validation_result, wide_status(d), d.run, *RULES)


def of_step(name: str, step: int) -> None:
    @query(name, f"SELECT rules, pipeline_id, batch_id, execution_status, verdict FROM ox_verdict WHERE step_id = {step}")
    def build(d):
        found = under_all_rules(d).filter(F.col("step_id") == step)
        return found.select("rules", "pipeline_id", "batch_id", "execution_status", "verdict")


of_step("ingestion_verdict", 1)
of_step("schema_verdict", 2)
of_step("data_verdict", 3)
of_step("row_count_verdict", 4)
of_step("uniqueness_verdict", 5)
of_step("not_null_verdict", 6)


@query(
    "execution_gate",
    "SELECT rules, pipeline_id, batch_id, step_id, execution_status, verdict = 'NA' AS not_judged FROM ox_verdict WHERE step_id > 1",
)
def execution_gate(d):
    found = under_all_rules(d).filter(F.col("step_id") > 1).withColumn("not_judged", F.col("verdict") == "NA")
    return found.select("rules", "pipeline_id", "batch_id", "step_id", "execution_status", "not_judged")
