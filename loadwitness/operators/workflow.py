"""Workflow definitions expanded to nodes, and the route a run takes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwitness.functions.jsonpath import workflow_nodes_array
from loadwitness.operators.skew import by_shuffle, counted_join, join_nulls_apart

# Names of nodes with a part of their own.
INGESTION_NODE = "Ingestion pipeline"
VALIDATION_NODE = "Validation dataflow"
NOT_VALIDATED = ("Modify validation pipelines", "Target crawler")

NODE_COLUMNS = ["pos", "node_id", "node_name", "pipeline_name", "pipeline_id"]


def explode_nodes(workflows: DataFrame) -> DataFrame:
    """One row per node of a workflow's JSON, with its place in the list; no list, no row.

    Name and id of what the node runs come from the pipeline fields, else from the workflow fields.
    """
    return workflows.select(
        "workflow_orch_id", F.posexplode(workflow_nodes_array(F.col("workflow_orch_json"))).alias("pos", "node")
    ).select(
        "workflow_orch_id",
        "pos",
        F.col("node.nodeId").alias("node_id"),
        F.col("node.config.name").alias("node_name"),
        F.coalesce("node.config.data_movement_name", "node.config.workflow_orch_name").alias("pipeline_name"),
        F.coalesce("node.config.data_movement_id", "node.config.workflow_orch_id").alias("pipeline_id"),
    )


def resolve_run(node_runs: DataFrame, node_batches: DataFrame) -> DataFrame:
    """Dataflow and dataflow batch to which each ``node_batch_id`` belongs.

    One that belongs to none stays, with nulls and ``found`` false, so that callers can report it.
    """
    wanted = node_batches.select("node_batch_id").distinct()
    known = node_runs.select("node_batch_id", "workflow_orch_id", "batch_id").distinct().withColumn("found", F.lit(True))
    return wanted.join(by_shuffle(known), "node_batch_id", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def _attach_status(nodes: DataFrame, node_runs: DataFrame) -> DataFrame:
    """Left join to node runs on node and batch, so nodes that never ran stay with null status."""
    ran = node_runs.select(F.col("node_id").alias("node_key"), "batch_id", "node_batch_id", "status")
    keyed = nodes.withColumn("node_key", F.col("node_id").try_cast("bigint"))
    return join_nulls_apart(keyed, ran, ["node_key", "batch_id"], ["workflow_orch_id", "pos"]).drop("node_key")


def workflow_nodes(runs: DataFrame, workflows: DataFrame, node_runs: DataFrame) -> DataFrame:
    """All nodes of each run ``(workflow_orch_id, batch_id)`` with batch and status of the node."""
    wanted = runs.select("workflow_orch_id", "batch_id").distinct()
    defined = for_workflows(workflows, wanted)
    listed = counted_join(wanted, explode_nodes(defined), ["workflow_orch_id"], ["batch_id"])
    return _attach_status(listed, node_runs)


def for_workflows(workflows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Only definitions that are needed, before their JSON is parsed."""
    return workflows.join(wanted.select("workflow_orch_id").distinct(), "workflow_orch_id", "left_semi")


def named_nodes(nodes: DataFrame) -> DataFrame:
    """Without the nodes whose name is null or empty."""
    return nodes.filter(F.col("node_name").isNotNull() & (F.col("node_name") != ""))


def node_details(nodes: DataFrame) -> DataFrame:
    """One row per run and node name; of nodes with the same name the last in the list. Nameless nodes are dropped."""
    named = named_nodes(nodes)
    last = F.max_by(F.struct("node_id", "pipeline_name", "pipeline_id", "node_batch_id", "status"), "pos")
    return (
        named.groupBy("workflow_orch_id", "batch_id", "node_name")
        .agg(last.alias("last"))
        .select("workflow_orch_id", "batch_id", "node_name", "last.*")
    )


def route_runs(nodes: DataFrame) -> DataFrame:
    """Per run: status and name of its ingestion, and where it goes.

    ``failed`` gets the failure report only; ``validate`` covers success, no status and no ingestion node at all;
    any other status is ``pending``.
    """
    is_ingestion = F.col("node_name") == INGESTION_NODE
    last = F.max_by(F.struct("status", "pipeline_name"), F.when(is_ingestion, F.col("pos")))
    status = F.col("ingestion.status")
    return nodes.groupBy("workflow_orch_id", "batch_id").agg(last.alias("ingestion")).select(
        "workflow_orch_id",
        "batch_id",
        status.alias("ingestion_status"),
        F.col("ingestion.pipeline_name").alias("ingestion_name"),
        F.when(status == "FAILED", "failed")
        .when(status.isNull() | (status == "SUCCESS"), "validate")
        .otherwise("pending")
        .alias("route"),
    )


def exclude_nodes(nodes: DataFrame, names: Sequence[str] = NOT_VALIDATED) -> DataFrame:
    """Without the nodes of these names; a nameless node goes too."""
    return nodes.filter(~F.col("node_name").isin(*names))


def validation_runs(nodes: DataFrame, workflows: DataFrame, node_runs: DataFrame) -> DataFrame:
    """The validation pipelines of each run.

    ``nodes`` come from ``workflow_nodes``. The run's ``Validation dataflow`` node names a second workflow and its
    batch; that workflow's nodes, less the helpers, are what is validated.
    """
    child = node_details(nodes).filter(F.col("node_name") == VALIDATION_NODE).select(
        F.col("workflow_orch_id").alias("dataflow_id"),
        F.col("batch_id").alias("dataflow_batch_id"),
        F.col("pipeline_id").try_cast("bigint").alias("workflow_orch_id"),
        F.col("node_batch_id").alias("batch_id"),
    )
    listed = counted_join(
        child,
        exclude_nodes(explode_nodes(for_workflows(workflows, child))),
        ["workflow_orch_id"],
        ["dataflow_id", "dataflow_batch_id"],
    )
    return _attach_status(listed, node_runs).select(
        "dataflow_id",
        "dataflow_batch_id",
        F.col("pos").alias("seq"),
        "node_name",
        "pipeline_name",
        "pipeline_id",
        F.col("node_batch_id").alias("pipeline_batch_id"),
        "status",
    )
