"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadwitness.operators import compare, lookups, status, workflow
from loadwitness.plans import dataflow
from loadwitness.registry import query
from loadwitness.registry.inputs import SCALES, nodes, run_nodes
from loadwitness.registry.oracle_views import PAIR_COLUMNS

COLUMNS = list(PAIR_COLUMNS)
_NAMES = ", ".join(COLUMNS)
URL = "https://example.org/ui"


def spread(found):
    """A comparison result with one column per field."""
    return found.select(*[c for c in found.columns if c != "data"], *[F.col("data")[c].alias(c) for c in COLUMNS])


@query("execution_meta", "SELECT batch_id, executed_by, started_at FROM ox_start")
def execution_meta(d):
    return lookups.execution_meta(d.init_flow, d.schedule)


_EXECUTION = "data_movement_id, batch_id, node_id, object_id, node_name, description, node_type_name, status, start_time, end_time"


@query("node_execution", f"SELECT {_EXECUTION} FROM ox_execution")
def node_execution(d):
    return status.node_execution(d.node_status, d.object, d.node_type).select(*_EXECUTION.split(", "))


@query(
    "json_key_join",
    """SELECT o.object_id, t.node_type_name FROM fx_object o
JOIN fx_node_type t ON t.node_type_id = CAST(o.object_info ->> '$.nodeTypeId' AS INTEGER)""",
)
def json_key_join(d):
    return status.with_node_type(d.object, d.node_type).select("object_id", "node_type_name")


@query(
    "node_status_left",
    "SELECT workflow_orch_id, batch_id, pos, node_id, node_name, pipeline_name, pipeline_id, node_batch_id, status FROM ox_run_node",
)
def node_status_left(d):
    return run_nodes(d)


@query("step_node_left", "SELECT pipeline_id, batch_id, object_id, node_name, status FROM ox_node_status")
def step_node_left(d):
    return nodes(d)


@query("lateral_explode", "SELECT workflow_orch_id, pos, node_id, node_name, pipeline_name, pipeline_id FROM ox_node")
def lateral_explode(d):
    return workflow.explode_nodes(d.workflow)


@query(
    "scalar_status",
    """SELECT r.pipeline_id, r.batch_id, l.status_code_id, coalesce(l.status_code_id IN (13, 29, 32), false) AS flow_failed
FROM fx_run r LEFT JOIN ox_latest l ON l.data_movement_id = r.pipeline_id AND l.batch_id = r.batch_id""",
)
def scalar_status(d):
    return status.run_codes(d.run, d.flow_status).withColumn(
        "flow_failed", F.coalesce(F.col("status_code_id").isin(*status.FAILED_CODES), F.lit(False))
    )


@query(
    "workspace_lookup",
    """SELECT r.pipeline_id, r.batch_id, coalesce(CAST(w.workspace_id AS VARCHAR), 'N/A') AS workspace_id
FROM fx_run r LEFT JOIN fx_workspace_pipeline w ON w.workspace_pipeline_id = r.pipeline_id""",
)
def workspace_lookup(d):
    return lookups.with_workspace(d.run, d.workspace_pipeline, URL).select("pipeline_id", "batch_id", "workspace_id")


@query("keyword_join", "SELECT pipeline_id, batch_id, object_id, node_name, status, validation_type FROM ox_match")
def keyword_join(d):
    return status.match_steps(nodes(d))


# Keywords out of the data: the name of each pipeline's first node, and words of one and two letters.
_OWN_KEYWORDS = """
SELECT concat('like_', workspace_pipeline_id % 3) AS validation_type, lower(min({name})) AS keyword
FROM {objects} GROUP BY workspace_pipeline_id
UNION SELECT 'short', 'a' UNION SELECT 'short', 'ro' UNION SELECT 'none', '' UNION SELECT 'none', NULL"""


@query(
    "keyword_join_table",
    f"""WITH k AS ({_OWN_KEYWORDS.format(name="object_info ->> '$.config.nodeName'", objects="fx_object")})
SELECT DISTINCT n.pipeline_id, n.batch_id, n.object_id, n.node_name, n.status, k.validation_type
FROM ox_node_status n JOIN k ON k.keyword <> '' AND contains(lower(coalesce(n.node_name, '')), k.keyword)""",
)
def keyword_join_table(d):
    """Nodes matched by the keywords of a table."""
    named = d.object.select("workspace_pipeline_id", F.get_json_object("object_info", "$.config.nodeName").alias("node_name"))
    words = d.spark.sql(_OWN_KEYWORDS.format(name="node_name", objects="{named}"), named=named)
    return status.match_steps(nodes(d), words)


@query(
    "present_only_in_source",
    f"SELECT row_hash, copies, {_NAMES} FROM ox_hashed_source WHERE row_hash NOT IN (SELECT row_hash FROM ox_hashed_target)",
)
def present_only_in_source(d):
    return spread(compare.only_in(d.source, d.target, scales=SCALES))


@query(
    "present_only_in_destination",
    f"SELECT row_hash, copies, {_NAMES} FROM ox_hashed_target WHERE row_hash NOT IN (SELECT row_hash FROM ox_hashed_source)",
)
def present_only_in_destination(d):
    return spread(compare.only_in_target(d.source, d.target, scales=SCALES))


@query(
    "named_lookup",
    """SELECT w.data_movement_name, v.data_movement_id, v.data_movement_id IS NOT NULL AS found
FROM (SELECT DISTINCT data_movement_name FROM fx_wanted_name) w
LEFT JOIN (SELECT data_movement_name, min(data_movement_id) AS data_movement_id FROM fx_version
           WHERE valid_to_ts = '9999-12-31 00:00:00.000' GROUP BY 1) v USING (data_movement_name)""",
)
def named_lookup(d):
    return lookups.lookup_current(d.wanted_name, d.version, "data_movement_name", "data_movement_id")


@query(
    "workflow_of_run",
    """SELECT DISTINCT w.node_batch_id, n.workflow_orch_id, n.batch_id, n.batch_id IS NOT NULL AS found
FROM (SELECT CASE WHEN node_id % 5 = 0 THEN -node_batch_id ELSE node_batch_id END AS node_batch_id FROM fx_workflow_node) w
LEFT JOIN fx_workflow_node n ON n.node_batch_id = w.node_batch_id""",
)
def workflow_of_run(d):
    """Some of the wanted ids belong to no workflow."""
    unknown = F.when(F.col("node_id") % 5 == 0, -F.col("node_batch_id")).otherwise(F.col("node_batch_id"))
    return workflow.resolve_run(d.workflow_node, d.workflow_node.select(unknown.alias("node_batch_id")))


@query(
    "child_workflow",
    "SELECT dataflow_id, dataflow_batch_id, seq, node_name, pipeline_name, pipeline_id, pipeline_batch_id, status FROM ox_child",
)
def child_workflow(d):
    return workflow.validation_runs(run_nodes(d), d.workflow, d.workflow_node)


@query(
    "report_runs",
    """SELECT c.dataflow_batch_id, c.seq, CAST(c.pipeline_id AS BIGINT) AS pipeline_id, c.pipeline_batch_id AS batch_id,
       c.pipeline_name, c.status, r.ingestion_status, r.ingestion_name
FROM ox_child c JOIN ox_route r ON r.workflow_orch_id = c.dataflow_id AND r.batch_id = c.dataflow_batch_id
WHERE r.route = 'validate'""",
)
def report_runs(d):
    """The pipelines that the reports of all dataflow runs cover."""
    return dataflow.report_runs(run_nodes(d), d.workflow, d.workflow_node)
