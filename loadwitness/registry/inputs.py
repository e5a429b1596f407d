"""What several queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwitness.operators.status import node_status, step_status
from loadwitness.operators.workflow import resolve_run, workflow_nodes
from loadwitness.sources.specs import MappingSpec

SCALES = {"o_totalprice": 2, "l_quantity": 2, "l_extendedprice": 2, "l_discount": 2, "l_tax": 2}
TEXT_TO_DATE = {"string": ["date", "timestamp"]}


def mappings() -> list[MappingSpec]:
    return [
        MappingSpec(
            "m1", 1, 1001, "fx_source", "fx_target", uniqueness_columns=["o_orderkey"],
            not_null_columns=["o_orderkey", "o_orderpriority"], compatible_types=TEXT_TO_DATE, scales=SCALES,
        ),
        MappingSpec(
            "m2", 2, 1002, "orders", "orders", uniqueness_columns=["o_orderkey", "o_custkey"],
            not_null_columns=["o_orderkey", "o_custkey", "o_orderstatus"], compatible_types=TEXT_TO_DATE, scales=SCALES,
        ),
        MappingSpec(
            "m3", 3, 1003, "lineitem", "lineitem", uniqueness_columns=["l_orderkey", "l_linenumber"],
            not_null_columns=["l_partkey", "l_suppkey"], scales=SCALES, unique_keys=[["l_orderkey", "l_linenumber"]],
        ),
    ]


def main_mapping() -> MappingSpec:
    return mappings()[0]


def object_of(d, name: str) -> DataFrame:
    return getattr(d, name.removeprefix("fx_"))


def objects_of(d, spec: MappingSpec) -> tuple[DataFrame, DataFrame]:
    return object_of(d, spec.source_object), object_of(d, spec.target_object)


def nodes(d) -> DataFrame:
    return node_status(d.run, d.object, d.node_status, d.flow_status)


def wide_status(d) -> DataFrame:
    return step_status(nodes(d))


def main_runs(d) -> DataFrame:
    """Runs of the main dataflows, found through the batches of their nodes."""
    main = d.workflow_node.filter(F.col("workflow_orch_id") >= 0)
    return resolve_run(d.workflow_node, main).where("found").select("workflow_orch_id", "batch_id").distinct()


def run_nodes(d) -> DataFrame:
    return workflow_nodes(main_runs(d), d.workflow, d.workflow_node)
