"""From the workflow of a dataflow to the runs its report covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwitness.functions.scalars import cast_batch_id
from loadwitness.operators.skew import counted_join
from loadwitness.operators.workflow import route_runs, validation_runs
from loadwitness.scratch import materialise


def report_runs(nodes: DataFrame, workflows: DataFrame, node_runs: DataFrame) -> DataFrame:
    """The ``runs`` that the reports take: validation pipelines of all dataflow runs that go on to validation.

    ``nodes`` come from ``workflow_nodes``; they are worked out once and written down, as both steps start from them. A pipeline that never ran stays, without batch and status. Dataflow runs with
    failed ingestion are in ``ingestion_failed_report`` instead.
    """
    nodes = materialise(nodes)
    go_on = route_runs(nodes).filter(F.col("route") == "validate").select(
        F.col("workflow_orch_id").alias("dataflow_id"),
        F.col("batch_id").alias("dataflow_batch_id"),
        "ingestion_status",
        "ingestion_name",
    )
    listed = validation_runs(nodes, workflows, node_runs)
    return counted_join(listed, go_on, ["dataflow_id", "dataflow_batch_id"], ["seq"]).select(
        "dataflow_batch_id",
        "seq",
        cast_batch_id(F.col("pipeline_id")).alias("pipeline_id"),
        F.col("pipeline_batch_id").alias("batch_id"),
        "pipeline_name",
        "status",
        "ingestion_status",
        "ingestion_name",
    )
