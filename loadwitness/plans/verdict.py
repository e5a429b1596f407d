"""Pass / Fail / NA per run and step, under three rule sets.

``r3`` is the default. ``r2`` words the gate differently and reads null comments in any case; ``r1`` has no gate,
judges ingestion by its comments and forces NA afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwitness.operators.results import RULES, step_facts
from loadwitness.operators.skew import join_nulls_apart
from loadwitness.operators.status import KEYWORDS
from loadwitness.plans.steps import STEP_TYPES

COUNTS = [
    "ingestion_comments",
    "schema_mismatches",
    "data_comments",
    "source_only",
    "target_only",
    "row_count_comments",
    "uniqueness_comments",
    "not_null_comments",
]


def _check(rules: str) -> None:
    if rules not in RULES:
        raise ValueError(f"unknown rule set {rules!r}")


def _fail_if(condition: Column) -> Column:
    return F.when(condition, "Fail").otherwise("Pass")


def run_gate(status: Column, rules: str = "r3") -> Column:
    """Whether the details of a run count: its status is SUCCESS (in any case under r3). Null is not SUCCESS."""
    _check(rules)
    if rules == "r1":
        return F.lit(True)
    return F.coalesce((F.upper(status) if rules == "r3" else status) == "SUCCESS", F.lit(False))


def execution_status(step: int, rules: str = "r3") -> Column:
    """Status shown for a step, from the run's columns and its ``step_status`` columns."""
    _check(rules)
    own = F.coalesce(F.col(STEP_TYPES[step]), F.lit("NA"))
    if rules == "r1":
        return own
    if step == 1:
        return F.col("ingestion_status") if rules == "r3" else F.col("status")
    shut = "Fail" if rules == "r3" else "NA"
    return F.when(run_gate(F.col("status"), rules), own).otherwise(shut)


def ingestion_verdict(rules: str = "r3") -> Column:
    _check(rules)
    if rules == "r1":
        return F.when(F.col("ingestion_comments") > 0, "Pass").otherwise("NA")
    status = F.col("ingestion_status") if rules == "r3" else F.col("status")
    return F.when(status == "SUCCESS", "Pass").when(status == "FAILED", "Fail").otherwise("NA")


def schema_verdict(rules: str = "r3") -> Column:
    _check(rules)
    mismatch = F.col("schema_mismatches") > 0
    return _fail_if(mismatch if rules == "r1" else mismatch | F.coalesce("last_schemas_missing", F.lit(True)))


def data_verdict(rules: str = "r3") -> Column:
    _check(rules)
    judged = _fail_if((F.col("source_only") > 0) | (F.col("target_only") > 0))
    return F.when(F.col("data_comments") == 0, "NA").otherwise(judged) if rules == "r1" else judged


def row_count_verdict(rules: str = "r3") -> Column:
    _check(rules)
    return F.when(F.col("row_count_comments") == 0, "NA").otherwise(_fail_if(~F.col("counts_agree")))


def uniqueness_verdict(rules: str = "r3") -> Column:
    _check(rules)
    return F.when(F.col("uniqueness_comments") == 0, "NA").otherwise(_fail_if(F.col(f"not_unique_{rules}")))


def not_null_verdict(rules: str = "r3") -> Column:
    _check(rules)
    return F.when(F.col("not_null_comments") == 0, "NA").otherwise(_fail_if(F.col(f"nulls_exist_{rules}")))


JUDGES = {
    1: ingestion_verdict,
    2: schema_verdict,
    3: data_verdict,
    4: row_count_verdict,
    5: uniqueness_verdict,
    6: not_null_verdict,
}


def step_verdict(step: int, rules: str = "r3") -> Column:
    """Verdict of a step; anything but an executed step is NA (the ingestion of r2 and r3 judges its own status)."""
    judged = JUDGES[step](rules)
    if step == 1 and rules != "r1":
        return judged
    return F.when(execution_status(step, rules) == "Success", judged).otherwise("NA")


RUN = ["pipeline_id", "batch_id"]


def judged_runs(runs: DataFrame, results: DataFrame, wide_status: DataFrame, keys: Sequence[str] = RUN) -> DataFrame:
    """Runs with the status of each step and the facts of their comments: one row per run.

    Results and nodes are reduced to a row per run before they meet the runs. ``keys`` names a run; comments belong to it
    by those of the keys that they have. Runs without a batch (pipelines that never ran) meet nothing.
    """
    own = [k for k in keys if k in results.columns]
    with_steps = join_nulls_apart(runs, wide_status, list(keys), runs.columns)
    joined = join_nulls_apart(with_steps, step_facts(results, own), own, runs.columns)
    flags = [f"{flag}_{rules}" for flag in ("not_unique", "nulls_exist") for rules in RULES]
    return joined.fillna({**{c: 0 for c in COUNTS}, **{c: False for c in flags}})


def _step(step: int, rules: str) -> Column:
    return F.struct(
        F.lit(rules).alias("rules"),
        F.lit(step).alias("step_id"),
        F.lit(STEP_TYPES[step]).alias("validation_type"),
        execution_status(step, rules).alias("execution_status"),
        step_verdict(step, rules).alias("verdict"),
    )


def step_rows(judged: DataFrame, *rules: str) -> DataFrame:
    """Six rows per run and rule set: ``rules, step_id, validation_type, execution_status, verdict`` next to the run's columns."""
    steps = F.array(*[_step(step, r) for r in rules for step in STEP_TYPES])
    return judged.withColumn("step", F.explode(steps)).select("*", "step.*").drop("step", *KEYWORDS)


def verdicts(
    results: DataFrame, wide_status: DataFrame, runs: DataFrame, rules: str = "r3", keys: Sequence[str] = RUN
) -> DataFrame:
    """``keys``, then ``step_id, validation_type, execution_status, verdict``, for all runs at once."""
    return verdicts_under(results, wide_status, runs, rules, keys=keys).drop("rules")


def verdicts_under(
    results: DataFrame, wide_status: DataFrame, runs: DataFrame, *rules: str, keys: Sequence[str] = RUN
) -> DataFrame:
    """``verdicts`` under several rule sets, named in ``rules``; nodes and comments are still read once."""
    rows = step_rows(judged_runs(runs, results, wide_status, keys), *rules)
    return rows.select("rules", *keys, "step_id", "validation_type", "execution_status", "verdict")
