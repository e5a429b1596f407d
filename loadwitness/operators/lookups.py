"""Lookups that dress a run: who started it, where it lives, what it reads and writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwitness.functions.jsonpath import variables_array
from loadwitness.functions.scalars import or_na, workspace_url
from loadwitness.operators.skew import counted_join
from loadwitness.operators.status import current_rows

# Fixed value: code of the record that starts a run.
STARTED = 12


def first_row(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The first row of each group: ``columns`` at the smallest ``order``, which should tell rows apart.

    An aggregate with partial results; no group is sorted in one task.
    """
    first = F.min_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(*by).agg(first.alias("first")).select(*by, "first.*")


def execution_starts(flow: DataFrame, schedule: DataFrame) -> DataFrame:
    """Start records with the user who scheduled them.

    Repeated records of a batch under one schedule are reduced to the earliest before the join.
    """
    starts = (
        flow.filter(F.col("status_code_id") == STARTED)
        .groupBy("batch_id", "job_schedule_id")
        .agg(F.min("valid_from_ts").alias("valid_from_ts"))
    )
    who = schedule.select("job_schedule_id", F.col("cru_by").alias("executed_by"))
    return counted_join(starts, who, ["job_schedule_id"], ["batch_id"])


def execution_meta(flow: DataFrame, schedule: DataFrame) -> DataFrame:
    """One row per batch: ``executed_by, started_at`` of its first start record (by time, then schedule id)."""
    order = ["valid_from_ts", "job_schedule_id", "executed_by"]
    first = first_row(execution_starts(flow, schedule), ["batch_id"], order, ["executed_by", "valid_from_ts"])
    return first.withColumnRenamed("valid_from_ts", "started_at")


def with_workspace(runs: DataFrame, workspaces: DataFrame, base_url: str, counted: DataFrame | None = None) -> DataFrame:
    """Runs with workspace id and link, ``N/A`` where the pipeline has none; of several workspaces the lowest.

    ``counted``: a frame with the same runs that is cheaper to count.
    """
    own = workspaces.groupBy(F.col("workspace_pipeline_id").alias("pipeline_id")).agg(
        F.min("workspace_id").alias("workspace_id")
    )
    return (
        counted_join(runs, own, ["pipeline_id"], runs.columns, counted, how="left")
        .withColumn("pipeline_url", workspace_url(base_url, F.col("workspace_id"), F.col("pipeline_id")))
        .withColumn("workspace_id", F.coalesce(F.col("workspace_id").cast("string"), F.lit("N/A")))
    )


def variables(workspaces: DataFrame) -> DataFrame:
    """One row per user variable of a pipeline."""
    return workspaces.select(
        F.col("workspace_pipeline_id").alias("pipeline_id"), F.inline(variables_array(F.col("workspace_pipeline_json")))
    )


def object_names(workspaces: DataFrame) -> DataFrame:
    """Source and target object of each pipeline, one row each, nulls where the variable is not there."""

    def value_of(name: str):
        values = F.transform(
            F.filter(F.col("vars"), lambda v: v["variable"] == name), lambda v: v["value"]
        )
        return F.max(F.array_max(values)).alias(name)

    held = workspaces.select(
        F.col("workspace_pipeline_id").alias("pipeline_id"), variables_array(F.col("workspace_pipeline_json")).alias("vars")
    )
    return held.groupBy("pipeline_id").agg(value_of("source_obj_name"), value_of("target_obj_name"))


def with_object_names(runs: DataFrame, workspaces: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Runs with the names of their objects, ``N/A`` for null, empty or unknown ones; ``counted`` as in ``with_workspace``."""
    named = counted_join(runs, object_names(workspaces), ["pipeline_id"], runs.columns, counted, how="left")
    return named.withColumn("source_obj_name", or_na(F.col("source_obj_name"))).withColumn(
        "target_obj_name", or_na(F.col("target_obj_name"))
    )


def lookup_current(keys: DataFrame, table: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """For each key the ``value`` of its current row, the first by ``order`` when there are many.

    A key without a current row stays, with null and ``found`` false, so that callers can report it.
    """
    order = order or value
    first = current_rows(table).groupBy(key).agg(F.min_by(value, order).alias(value), F.lit(True).alias("found"))
    return keys.select(key).distinct().join(first, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))
