"""Fields of JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_path_text(c: Column, *path: str) -> Column:
    """Text at a path of object keys; a missing path gives null."""
    return F.get_json_object(c, "$" + "".join(f"['{key}']" for key in path))


def json_cast(c: Column, to: str, *path: str, strict: bool = True) -> Column:
    """Text at a path, cast; a bad number is an error, or null where dirty data is expected."""
    text = json_path_text(c, *path)
    return text.cast(to) if strict else text.try_cast(to)


# Only the fields that are used are parsed, in one pass over the text.
WORKFLOW = T.StructType().add(
    "workflowJson",
    T.StructType().add(
        "nodeDataArray",
        T.ArrayType(
            T.StructType()
            .add("nodeId", T.StringType())
            .add(
                "config",
                T.StructType()
                .add("name", T.StringType())
                .add("data_movement_name", T.StringType())
                .add("workflow_orch_name", T.StringType())
                .add("data_movement_id", T.StringType())
                .add("workflow_orch_id", T.StringType()),
            )
        ),
    ),
)

VARIABLES_PATH = ["pipelineJson", "pipeline_config", "flow_details", "user_variables", "user_variables_details"]


def _nest(path: list[str], leaf: T.DataType) -> T.StructType:
    inner = leaf if len(path) == 1 else _nest(path[1:], leaf)
    return T.StructType().add(path[0], inner)


VARIABLES = _nest(
    VARIABLES_PATH, T.ArrayType(T.StructType().add("variable", T.StringType()).add("value", T.StringType()))
)


def workflow_nodes_array(c: Column) -> Column:
    return F.from_json(c, WORKFLOW)["workflowJson"]["nodeDataArray"]


def variables_array(c: Column) -> Column:
    parsed = F.from_json(c, VARIABLES)
    for key in VARIABLES_PATH:
        parsed = parsed[key]
    return parsed
