"""Report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadwitness.operators.status import node_execution
from loadwitness.operators.workflow import route_runs
from loadwitness.plans import report
from loadwitness.plans.steps import STEP_TYPES, description, expected
from loadwitness.registry import query
from loadwitness.registry.inputs import run_nodes, wide_status
from loadwitness.registry.joins import URL

RUN_TIME = "2026-01-31 12:34:56.789012"


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _steps_sql(rules: str) -> str:
    rows = [
        f"({s}, {_lit(description(s, rules))}, {_lit(chr(10).join(f'{i}. {t}' for i, t in enumerate(expected(s, rules), 1)))})"
        for s in STEP_TYPES
    ]
    return f"(VALUES {', '.join(rows)}) t(step_id, description, expected)"


def _found(comment: str, pattern: str, group: int = 1) -> str:
    return f"coalesce(nullif(regexp_extract({comment}, '{pattern}', {group}), ''), 'N/A')"


def _report_sql(rules: str) -> str:
    label = "Node Execution Status: " if rules == "r3" else "Execution Status: "
    ran = "true" if rules == "r1" else "coalesce(v.execution_status = 'Success', false)"
    refused = "NULL" if rules == "r1" else "CASE WHEN v.execution_status = 'Fail' THEN 'N/A (Execution Failed)' END"
    name = "r.ingestion_name" if rules == "r3" else "r.pipeline_name"
    data, schema = "coalesce(f.n_data, 0)", "coalesce(f.n_schema, 0)"
    summed = f"{data} > 0"
    where = {
        "r1": "'See ''Detailed Data Validation Logs'' below for full list.'",
        "r2": "concat('Full list in: data_validation_discrepancies_', v.pipeline_id, '_', v.batch_id, '.csv')",
        "r3": "NULL",
    }[rules]
    has = "coalesce(f.schemas_comment <> '', false)"
    shown, heading = f"({has} OR {schema} = 0)", f"({has} AND {schema} > 0)"
    if rules != "r1":
        shown, heading = "true", f"{schema} > 0"
    first = f"concat('Pipeline Name: ', {name})"
    if rules == "r1":
        first = "CASE WHEN coalesce(f.n_ingestion, 0) = 0 THEN concat_ws(chr(10), 'Pipeline Name : N/A', 'Source: N/A', 'Target: N/A') END"

    def when(step: int, condition: str, value: str) -> str:
        return f"CASE WHEN v.step_id = {step} AND {ran} AND {condition} THEN {value} END"

    counts = "(Source Row Count:|Number of rows in Source:)\\s*(\\d+)"
    some_counts = "coalesce(f.n_row_count, 0) > 0"
    source, target = (_found("f.schemas_comment", f"{side} Schema:\\s*(\\[.*?\\])") for side in ("Source", "Target"))
    lines = [
        f"concat('{label}', coalesce(v.execution_status, 'None'))",
        f"CASE WHEN v.step_id = 1 THEN {first} ELSE {refused} END",
        when(2, shown, f"concat('Source Schema: ', {source})"),
        when(2, shown, f"concat('Target Schema: ', {target})"),
        when(2, heading, "'Mismatch in schema:'"),
        when(3, summed, f"concat('Total discrepancies: ', {data})"),
        when(3, f"{summed} AND f.n_source > 0", "concat('- Present only in Source: ', f.n_source)"),
        when(3, f"{summed} AND f.n_target > 0", "concat('- Present only in Destination: ', f.n_target)"),
        when(3, summed, where),
        when(3, f"{data} = 0", "'N/A'"),
        when(4, some_counts, f"concat('Number of rows in Source: ', {_found('f.row_count_comment', counts, 2)})"),
        when(4, some_counts, f"concat('Target: ', {_found('f.row_count_comment', 'Target:\\s*(\\d+)')})"),
        when(4, some_counts, f"concat('Difference: ', {_found('f.row_count_comment', 'Difference:\\s*(\\d+)')})"),
        when(4, "coalesce(f.n_row_count, 0) = 0", "'N/A'"),
        when(5, "coalesce(f.n_uniqueness, 0) = 0", "'N/A'"),
        when(6, "coalesce(f.n_not_null, 0) = 0", "'N/A'"),
    ]
    return f"""SELECT r.dataflow_batch_id, r.seq, v.pipeline_id, v.batch_id, v.step_id, t.description, t.expected, v.execution_status,
       concat_ws(chr(10), {", ".join(lines)}) AS actual, v.verdict
FROM ox_verdict_{rules} v JOIN fx_run r USING (pipeline_id, batch_id) JOIN {_steps_sql(rules)} ON t.step_id = v.step_id
LEFT JOIN ox_facts_{rules} f ON f.batch_id = v.batch_id"""


def _report(name: str, rules: str) -> None:
    @query(name, _report_sql(rules))
    def build(d):
        rows = report.report_step(d.run, d.validation_result, wide_status(d), rules)
        return rows.withColumn("expected", F.array_join("expected", "\n")).withColumn("actual", F.array_join("actual", "\n"))


_report("test_execution", "r3")
_report("test_execution_r2", "r2")
_report("test_execution_r1", "r1")


def _lines_sql(rules: str) -> str:
    by_blank = "replace(regexp_replace(comment, '^\\s+|\\s+$', '', 'g'), ', ', chr(10))"
    by_comma = "regexp_replace(regexp_replace(comment, '^\\s+|\\s+$', '', 'g'), '\\s*,\\s*', chr(10), 'g')"
    not_null = by_blank if rules == "r1" else by_comma
    kinds = "'schema', 'uniqueness'" if rules == "r2" else "'schema', 'uniqueness', 'not_null'"
    listed = f"""SELECT batch_id, validation_type, CAST(NULL AS VARCHAR) AS heading, seq,
       CASE validation_type WHEN 'schema' THEN trim(comment) WHEN 'uniqueness' THEN {by_blank} ELSE {not_null} END AS line,
       true AS inline
FROM fx_validation_result WHERE validation_type IN ({kinds})"""
    if rules != "r3":
        listed += """ UNION ALL SELECT batch_id, 'data', concat(side, ':'), seq, text, n <= 10
FROM (SELECT *, count(*) OVER (PARTITION BY batch_id) AS n FROM ox_data) d WHERE side <> 'other'"""
    ran = "" if rules == "r1" else "WHERE v.execution_status = 'Success'"
    return f"""SELECT v.pipeline_id, v.batch_id, v.step_id, l.heading, l.seq, l.line, l.inline
FROM ox_verdict_{rules} v JOIN ({listed}) l ON l.batch_id = v.batch_id AND l.validation_type = v.validation_type {ran}"""


def _lines(name: str, rules: str) -> None:
    @query(name, _lines_sql(rules))
    def build(d):
        return report.quoted_lines(d.run, d.validation_result, wide_status(d), rules)


_lines("quoted_lines", "r3")
_lines("quoted_lines_r2", "r2")
_lines("quoted_lines_r1", "r1")


@query(
    "report_header",
    f"""SELECT r.dataflow_batch_id, r.pipeline_id, r.batch_id, r.pipeline_name, s.executed_by,
       strftime(s.started_at, '%Y-%m-%d %H:%M:%S.%f') AS started_at, '{RUN_TIME}' AS ended_at,
       coalesce(nullif(n.source_obj_name, ''), 'N/A') AS source_obj_name, coalesce(nullif(n.target_obj_name, ''), 'N/A') AS target_obj_name,
       CASE WHEN w.workspace_id IS NULL THEN 'N/A' ELSE concat('{URL}/workspace?workspace_id=', w.workspace_id, '&pipeline_id=',
            r.pipeline_id, '&active_tab=curationUI') END AS pipeline_url
FROM fx_run r LEFT JOIN ox_start s ON s.batch_id = r.dataflow_batch_id LEFT JOIN ox_names n USING (pipeline_id)
LEFT JOIN fx_workspace_pipeline w ON w.workspace_pipeline_id = r.pipeline_id""",
)
def report_header(d):
    return report.report_header(d.run, d.init_flow, d.schedule, d.workspace_pipeline, URL, RUN_TIME)


@query(
    "ingestion_failed",
    f"""SELECT r.workflow_orch_id, r.batch_id AS dataflow_batch_id, 1 AS step_id, t.description, t.expected,
       concat('Node Execution Status: FAILED', chr(10), 'Pipeline Name: ', coalesce(r.ingestion_name, 'None')) AS actual, 'Fail' AS verdict,
       s.executed_by, strftime(s.started_at, '%Y-%m-%d %H:%M:%S.%f') AS started_at, '{RUN_TIME}' AS ended_at
FROM ox_route r JOIN {_steps_sql("r3")} ON t.step_id = 1 LEFT JOIN ox_start s ON s.batch_id = r.batch_id WHERE r.route = 'failed'""",
)
def ingestion_failed(d):
    rows = report.ingestion_failed_report(route_runs(run_nodes(d)), d.init_flow, d.schedule, RUN_TIME)
    return rows.withColumn("expected", F.array_join("expected", "\n")).withColumn("actual", F.array_join("actual", "\n"))


# Runs that get a discrepancy report.
_REPORTED = """SELECT v.pipeline_id, v.batch_id, r.dataflow_batch_id, r.pipeline_name, f.n_source, f.n_target
FROM ox_verdict_r3 v JOIN fx_run r USING (pipeline_id, batch_id) JOIN ox_facts_r3 f ON f.batch_id = v.batch_id
WHERE v.step_id = 3 AND v.execution_status = 'Success' AND f.n_data > 0"""


@query(
    "discrepancy_report",
    f"""WITH reported AS ({_REPORTED}),
heads AS (SELECT pipeline_id, batch_id, list_filter([
    CASE WHEN n_source + n_target > 0 THEN concat('Total Discrepancies: ', n_source + n_target) ELSE 'No Data Discrepancies Found.' END,
    CASE WHEN n_source > 0 THEN concat('- Present only in Source: ', n_source) END,
    CASE WHEN n_target > 0 THEN concat('- Present only in Destination: ', n_target) END], lambda h: h IS NOT NULL) AS h FROM reported)
SELECT pipeline_id, batch_id, 0 AS section, generate_subscripts(h, 1) - 1 AS seq, unnest(h) AS text FROM heads
UNION ALL SELECT r.pipeline_id, r.batch_id, CASE WHEN d.side = 'present_only_in_source' THEN 1 ELSE 2 END, d.seq, concat('Data: ', d.text)
FROM reported r JOIN ox_data d ON d.batch_id = r.batch_id WHERE d.side <> 'other'""",
)
def discrepancy_report(d):
    return report.discrepancy_report(d.run, d.validation_result, wide_status(d))


@query(
    "node_definitions",
    """SELECT object_id, batch_id, node_name, status, CASE status WHEN 'Success' THEN 'ok' WHEN 'Failed' THEN 'error' ELSE 'neutral' END AS status_class, node_type_name, description FROM ox_execution""",
)
def node_definitions(d):
    return report.node_definitions(node_execution(d.node_status, d.object, d.node_type))


@query(
    "execution_status",
    """SELECT node_id, batch_id, status, CASE status WHEN 'Success' THEN 'ok' WHEN 'Failed' THEN 'error' ELSE 'neutral' END AS status_class, start_time, end_time FROM ox_execution
ORDER BY start_time NULLS LAST, node_id""",
)
def execution_status(d):
    return report.execution_status_table(node_execution(d.node_status, d.object, d.node_type))


@query(
    "discrepancy_manifest",
    f"""SELECT dataflow_batch_id, pipeline_id, batch_id, concat('Data_Validation_Report_',
       regexp_replace(replace(pipeline_name, ' ', '_'), '[\\\\/:*?"<>|]', '', 'g'), '_Batch_', batch_id, '.pdf') AS report
FROM ({_REPORTED}) x""",
)
def discrepancy_manifest(d):
    return report.manifest(d.run, d.validation_result, wide_status(d))


@query(
    "detailed_log",
    """SELECT batch_id, CASE side WHEN 'present_only_in_source' THEN 'Present only in Source:' ELSE 'Present only in Destination:' END
       AS heading, seq, text, n <= 10 AS inline
FROM (SELECT *, count(*) OVER (PARTITION BY batch_id) AS n FROM ox_data) x WHERE side <> 'other'""",
)
def detailed_log(d):
    return report.detailed_log(d.validation_result)
