"""Reports as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwitness.functions.comments import SOURCE_ONLY, TARGET_ONLY
from loadwitness.functions.scalars import format_ts, numbered, report_name, status_class
from loadwitness.operators.lookups import execution_meta, with_object_names, with_workspace
from loadwitness.operators.results import (
    discrepancies,
    readable,
    report_lines,
    step_texts,
    with_totals,
)
from loadwitness.operators.skew import counted_join
from loadwitness.operators.status import node_execution, order_by_start
from loadwitness.plans.steps import STEP_TYPES, description, expected
from loadwitness.plans.verdict import judged_runs, step_rows, verdicts
from loadwitness.scratch import materialise


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _by_step(values: dict[int, Column]) -> Column:
    out = None
    for step, value in values.items():
        test = F.col("step_id") == step
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def _lines(*lines: Column) -> Column:
    """Array of the lines that are not null."""
    return F.filter(F.array(*lines), lambda line: line.isNotNull())


def _actual(rules: str) -> Column:
    """Lines of the actual result that do not grow with the number of comments."""
    label = "Node Execution Status: " if rules == "r3" else "Execution Status: "
    head = F.concat(F.lit(label), F.coalesce("execution_status", F.lit("None")))
    ran = F.lit(True) if rules == "r1" else F.col("execution_status") == "Success"
    refused = F.when(F.col("execution_status") == "Fail", F.lit("N/A (Execution Failed)"))
    if rules == "r1":
        refused = F.lit(None).cast("string")

    def shown(condition: Column, line: Column) -> Column:
        return F.when(ran & condition, line)

    def quoted(prefix: str, column: str) -> Column:
        return F.concat(F.lit(prefix), F.coalesce(F.col(column).cast("string"), F.lit("N/A")))

    always = F.lit(True)
    some_data = F.col("data_comments") > 0
    where = {
        "r1": F.lit("See 'Detailed Data Validation Logs' below for full list."),
        "r2": F.format_string("Full list in: data_validation_discrepancies_%s_%s.csv", "pipeline_id", "batch_id"),
        "r3": F.lit(None).cast("string"),
    }[rules]
    mismatched = F.col("schema_mismatches") > 0
    has_schemas = F.coalesce("has_schemas", F.lit(False))
    schemas_shown = has_schemas | ~mismatched if rules == "r1" else always
    heading_shown = mismatched & has_schemas if rules == "r1" else mismatched
    counted = F.col("row_count_comments") > 0
    none = F.lit("N/A")
    name = "ingestion_name" if rules == "r3" else "pipeline_name"
    first = [quoted("Pipeline Name: ", name)]
    if rules == "r1":
        first = [F.when(F.col("ingestion_comments") == 0, F.lit(line)) for line in ("Pipeline Name : N/A", "Source: N/A", "Target: N/A")]
    return _by_step(
        {
            1: _lines(head, *first),
            2: _lines(
                head,
                refused,
                shown(schemas_shown, quoted("Source Schema: ", "source_schema")),
                shown(schemas_shown, quoted("Target Schema: ", "target_schema")),
                shown(heading_shown, F.lit("Mismatch in schema:")),
            ),
            3: _lines(
                head,
                refused,
                shown(some_data, quoted("Total discrepancies: ", "data_comments")),
                shown(some_data & (F.col("source_only") > 0), quoted("- Present only in Source: ", "source_only")),
                shown(some_data & (F.col("target_only") > 0), quoted("- Present only in Destination: ", "target_only")),
                shown(some_data, where),
                shown(~some_data, none),
            ),
            4: _lines(
                head,
                refused,
                shown(counted, quoted("Number of rows in Source: ", "source_count")),
                shown(counted, quoted("Target: ", "target_count")),
                shown(counted, quoted("Difference: ", "difference")),
                shown(~counted, none),
            ),
            5: _lines(head, refused, shown(F.col("uniqueness_comments") == 0, none)),
            6: _lines(head, refused, shown(F.col("not_null_comments") == 0, none)),
        }
    )


def report_step(runs: DataFrame, results: DataFrame, wide_status: DataFrame, rules: str = "r3") -> DataFrame:
    """Six rows per run: description, expected results, actual result, verdict.

    ``actual`` holds a fixed number of lines at most; comments that are quoted one by one are in ``quoted_lines``.
    """
    judged = judged_runs(runs, results, wide_status).join(step_texts(results), "batch_id", "left")
    rows = step_rows(judged, rules)
    described = _by_step({s: F.lit(description(s, rules)) for s in STEP_TYPES})
    wanted = _by_step({s: numbered(_texts(expected(s, rules))) for s in STEP_TYPES})
    return rows.select(
        "dataflow_batch_id",
        "seq",
        "pipeline_id",
        "batch_id",
        "step_id",
        described.alias("description"),
        wanted.alias("expected"),
        "execution_status",
        _actual(rules).alias("actual"),
        "verdict",
    )


def quoted_lines(runs: DataFrame, results: DataFrame, wide_status: DataFrame, rules: str = "r3") -> DataFrame:
    """Comments quoted by the steps that were executed, one row each: ``pipeline_id, batch_id, step_id, seq, line``.

    ``heading`` names the side of a data comment.
    """
    steps = verdicts(results, wide_status, runs, rules)
    if rules != "r1":
        steps = steps.filter(F.col("execution_status") == "Success")
    open_steps = steps.select("pipeline_id", "batch_id", "step_id", "validation_type")
    on = ["batch_id", "validation_type"]
    return counted_join(report_lines(results, rules), open_steps, on, ["seq"], counted=results.select(*on)).select(
        "pipeline_id", "batch_id", "step_id", "heading", "seq", "line", "inline"
    )


def step_order(steps: DataFrame) -> DataFrame:
    """Report order: by dataflow batch, place of the pipeline in its list, step."""
    return steps.orderBy("dataflow_batch_id", "seq", "step_id")


def batch_report(runs: DataFrame, results: DataFrame, wide_status: DataFrame, rules: str = "r3") -> DataFrame:
    """All pipelines of a dataflow batch in list order; ``break_after`` marks the end of every block but the last."""
    last = runs.groupBy("dataflow_batch_id").agg(F.max("seq").alias("last_seq"))
    each = runs.select("dataflow_batch_id", F.explode(F.array(*[F.lit(s) for s in STEP_TYPES])))
    steps = counted_join(
        report_step(runs, results, wide_status, rules), last, ["dataflow_batch_id"], ["pipeline_id", "batch_id"], counted=each
    )
    ends_block = (F.col("step_id") == max(STEP_TYPES)) & (F.col("seq") < F.col("last_seq"))
    return steps.withColumn("break_after", ends_block).drop("last_seq")


def report_header(
    runs: DataFrame, flow: DataFrame, schedule: DataFrame, workspaces: DataFrame, base_url: str, run_time: str
) -> DataFrame:
    """One row per run: names, link, objects, who started it, start and end."""
    meta = execution_meta(flow, schedule).withColumnRenamed("batch_id", "dataflow_batch_id")
    dressed = with_object_names(with_workspace(runs, workspaces, base_url), workspaces, counted=runs)
    return counted_join(dressed, meta, ["dataflow_batch_id"], ["batch_id"], counted=runs, how="left").select(
        "dataflow_batch_id",
        "pipeline_id",
        "batch_id",
        "pipeline_name",
        "executed_by",
        format_ts(F.col("started_at")).alias("started_at"),
        format_ts(F.lit(run_time).cast("timestamp_ntz")).alias("ended_at"),
        "source_obj_name",
        "target_obj_name",
        "pipeline_url",
    )


def ingestion_failed_report(routed: DataFrame, flow: DataFrame, schedule: DataFrame, run_time: str) -> DataFrame:
    """For dataflow batches whose ingestion failed: the first step alone, Fail."""
    failed = routed.filter(F.col("route") == "failed")
    meta = execution_meta(flow, schedule)
    return counted_join(failed, meta, ["batch_id"], ["workflow_orch_id"], how="left").select(
        F.col("workflow_orch_id"),
        F.col("batch_id").alias("dataflow_batch_id"),
        F.lit(1).alias("step_id"),
        F.lit(description(1, "r3")).alias("description"),
        numbered(_texts(expected(1, "r3"))).alias("expected"),
        _lines(
            F.concat(F.lit("Node Execution Status: "), "ingestion_status"),
            F.concat(F.lit("Pipeline Name: "), F.coalesce("ingestion_name", F.lit("None"))),
        ).alias("actual"),
        F.lit("Fail").alias("verdict"),
        "executed_by",
        format_ts(F.col("started_at")).alias("started_at"),
        format_ts(F.lit(run_time).cast("timestamp_ntz")).alias("ended_at"),
    )


def executed_data_runs(runs: DataFrame, results: DataFrame, wide_status: DataFrame, rules: str = "r3") -> DataFrame:
    """Runs whose data step was executed and has comments: those that get a discrepancy report."""
    judged = step_rows(judged_runs(runs, results, wide_status), rules)
    return judged.filter(
        (F.col("validation_type") == "data") & (F.col("execution_status") == "Success") & (F.col("data_comments") > 0)
    )


def discrepancy_report(runs: DataFrame, results: DataFrame, wide_status: DataFrame) -> DataFrame:
    """Per run with data comments: totals (section 0), then rows present only in the source (1) and in the target (2).

    ``seq`` orders the lines of a section. Comments of unknown tag are not in these totals. Which runs are reported is
    worked out once and written down, as both parts need it.
    """
    keys = ["pipeline_id", "batch_id"]
    reported = materialise(executed_data_runs(runs, results, wide_status).select(*keys, "source_only", "target_only"))
    tagged = F.col("source_only") + F.col("target_only")
    heads = F.array(
        F.when(tagged > 0, F.concat(F.lit("Total Discrepancies: "), tagged.cast("string"))).otherwise(
            "No Data Discrepancies Found."
        ),
        F.when(F.col("source_only") > 0, F.concat(F.lit("- Present only in Source: "), F.col("source_only").cast("string"))),
        F.when(F.col("target_only") > 0, F.concat(F.lit("- Present only in Destination: "), F.col("target_only").cast("string"))),
    )
    totals = reported.select(
        *keys, F.lit(0).alias("section"), F.posexplode(F.filter(heads, lambda h: h.isNotNull())).alias("seq", "text")
    ).withColumn("seq", F.col("seq").cast("bigint"))
    found = discrepancies(results).filter(F.col("side").isin(SOURCE_ONLY, TARGET_ONLY))
    rows = readable(counted_join(found, reported.select(*keys), ["batch_id"], ["seq"])).select(
        *keys,
        F.when(F.col("side") == SOURCE_ONLY, 1).otherwise(2).alias("section"),
        "seq",
        F.concat(F.lit("Data: "), "text").alias("text"),
    )
    return totals.unionByName(rows)


def manifest(runs: DataFrame, results: DataFrame, wide_status: DataFrame) -> DataFrame:
    """Runs that have a discrepancy report, and its name."""
    return executed_data_runs(runs, results, wide_status).select(
        "dataflow_batch_id",
        "pipeline_id",
        "batch_id",
        F.concat(report_name(F.col("pipeline_name"), F.col("batch_id")), F.lit(".pdf")).alias("report"),
    )


def detailed_log(results: DataFrame) -> DataFrame:
    """All discrepancies with the heading of their side; ``inline`` marks those of batches that have few."""
    heading = F.when(F.col("side") == SOURCE_ONLY, "Present only in Source:").when(
        F.col("side") == TARGET_ONLY, "Present only in Destination:"
    )
    rows = with_totals(discrepancies(results)).withColumn("heading", heading)
    return readable(rows.filter(F.col("heading").isNotNull())).select("batch_id", "heading", "seq", "text", "inline")


def node_definitions(execution: DataFrame) -> DataFrame:
    """Object, name, status with its marker, type and description of each node run."""
    return execution.select(
        "object_id",
        "batch_id",
        "node_name",
        "status",
        status_class(F.col("status")).alias("status_class"),
        "node_type_name",
        "description",
    )


def execution_status_table(execution: DataFrame) -> DataFrame:
    """Node, status, start and end of each node run, in order of start."""
    return order_by_start(execution).select(
        "node_id",
        "batch_id",
        "status",
        status_class(F.col("status")).alias("status_class"),
        "start_time",
        "end_time",
    )


def execution_report(status: DataFrame, objects: DataFrame, types: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables of the execution report."""
    execution = node_execution(status, objects, types)
    return node_definitions(execution), execution_status_table(execution)
