"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadwitness.functions import scalars as S
from loadwitness.operators import lookups, status, workflow
from loadwitness.plans import verdict
from loadwitness.registry import query
from loadwitness.registry.inputs import run_nodes
from loadwitness.registry.oracle_views import STATUS_CASE


@query("project_alias", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_state FROM orders")
def project_alias(d):
    return d.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("order_state")
    )


@query(
    "batch_filter",
    """SELECT batch_id, validation_type, seq, comment FROM fx_validation_result
WHERE batch_id IN (SELECT batch_id FROM fx_run) ORDER BY validation_type""",
)
def batch_filter(d):
    return status.for_batch(d.validation_result, d.run).select("batch_id", "validation_type", "seq", "comment")


@query("in_list", "SELECT flow_id, batch_id, status_code_id FROM fx_flow_status WHERE status_code_id IN (13, 29, 32)")
def in_list(d):
    return status.with_codes(d.flow_status, "status_code_id", status.FAILED_CODES).select("flow_id", "batch_id", "status_code_id")


@query(
    "not_in_nodes",
    """SELECT workflow_orch_id, pos, node_id, node_name FROM ox_node
WHERE node_name NOT IN ('Modify validation pipelines', 'Target crawler')""",
)
def not_in_nodes(d):
    found = workflow.exclude_nodes(workflow.explode_nodes(d.workflow))
    return found.select("workflow_orch_id", "pos", "node_id", "node_name")


@query("current_version", "SELECT object_id, workspace_pipeline_id FROM fx_object WHERE valid_to_ts = '9999-12-31 00:00:00.000'")
def current_version(d):
    return status.current_rows(d.object).select("object_id", "workspace_pipeline_id")


@query("status_code_filter", "SELECT batch_id, job_schedule_id, valid_from_ts FROM fx_init_flow WHERE status_code_id = 12")
def status_code_filter(d):
    return status.with_codes(d.init_flow, "status_code_id", [lookups.STARTED]).select(
        "batch_id", "job_schedule_id", "valid_from_ts"
    )


@query(
    "node_name_present",
    "SELECT workflow_orch_id, pos, node_name FROM ox_node WHERE node_name IS NOT NULL AND node_name <> ''",
)
def node_name_present(d):
    return workflow.named_nodes(workflow.explode_nodes(d.workflow)).select("workflow_orch_id", "pos", "node_name")


@query("coalesce_fields", "SELECT workflow_orch_id, pos, pipeline_name, pipeline_id FROM ox_node")
def coalesce_fields(d):
    return workflow.explode_nodes(d.workflow).select("workflow_orch_id", "pos", "pipeline_name", "pipeline_id")


@query(
    "default_na",
    """SELECT r.pipeline_id, r.batch_id, coalesce(nullif(n.source_obj_name, ''), 'N/A') AS source_obj_name,
       coalesce(nullif(n.target_obj_name, ''), 'N/A') AS target_obj_name
FROM fx_run r LEFT JOIN ox_names n USING (pipeline_id)""",
)
def default_na(d):
    return lookups.with_object_names(d.run.select("pipeline_id", "batch_id"), d.workspace_pipeline)


@query(
    "status_case",
    f"""SELECT n.node_id, n.batch_id, {STATUS_CASE} AS status
FROM fx_node_status n LEFT JOIN ox_latest f ON f.data_movement_id = n.data_movement_id AND f.batch_id = n.batch_id""",
)
def status_case(d):
    coded = d.node_status.join(status.latest_status(d.flow_status), ["data_movement_id", "batch_id"], "left")
    return coded.select(
        "node_id", "batch_id", status.normalise_status(F.col("status"), F.col("status_code_id")).alias("status")
    )


@query(
    "batch_id_valid",
    """SELECT workflow_orch_id, batch_id, pos, node_batch_id IS NOT NULL AS valid FROM ox_run_node""",
)
def batch_id_valid(d):
    as_text = F.coalesce(S.id_to_string(F.col("node_batch_id")), F.lit("None"))
    return run_nodes(d).select("workflow_orch_id", "batch_id", "pos", S.valid_batch(as_text).alias("valid"))


@query("node_details", "SELECT workflow_orch_id, batch_id, node_name, node_id, pipeline_name, pipeline_id, node_batch_id, status FROM ox_detail")
def node_details(d):
    return workflow.node_details(run_nodes(d))


@query("ingestion_branch", "SELECT workflow_orch_id, batch_id, ingestion_status, ingestion_name, route FROM ox_route")
def ingestion_branch(d):
    return workflow.route_runs(run_nodes(d))


@query(
    "run_gate",
    """SELECT pipeline_id, batch_id, coalesce(upper(status) = 'SUCCESS', false) AS open_r3,
       coalesce(status = 'SUCCESS', false) AS open_r2, true AS open_r1 FROM fx_run""",
)
def run_gate(d):
    gates = [verdict.run_gate(F.col("status"), r).alias(f"open_{r}") for r in ("r3", "r2", "r1")]
    return d.run.select("pipeline_id", "batch_id", *gates)
