"""Status of runs and of their nodes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwitness.functions.jsonpath import json_cast, json_path_text
from loadwitness.functions.scalars import OPEN_END, lower_text, upper_text
from loadwitness.operators.skew import counted_join, salted_join

# Codes and words of the metadata store.
JOB_TYPES = (3, 25)
FAILED_CODES = (13, 29, 32)
KEYWORDS = {
    "schema": ["schema validator", "fetching source schema", "fetching target schema", "saving schema validation result"],
    "data": ["data validation", "saving data validation result"],
    "row_count": ["row count validator", "saving row count validation"],
    "uniqueness": ["uniqueness validator", "saving uniqueness validation"],
    "not_null": ["not null validator", "saving not null validation"],
    "ingestion": ["rest api source", "target", "get body", "ingestion"],
}

# Keywords of a table that become one expression, and letters by which more of them meet names.
LITERALS, LETTERS = 500, 3


def with_codes(df: DataFrame, column: str, codes: Sequence[int]) -> DataFrame:
    """Rows whose code is in a list."""
    return df.filter(F.col(column).isin(*codes))


def for_batch(df: DataFrame, ids: DataFrame, on: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Rows of the batches in ``ids``, for all of them at once."""
    return df.join(ids.select(*on).distinct(), list(on), "left_semi")


def current_rows(df: DataFrame, column: str = "valid_to_ts") -> DataFrame:
    """Rows of a slowly changing table that are valid now."""
    return df.filter(F.col(column) == F.lit(OPEN_END).cast(df.schema[column].dataType))


def latest_status(flow: DataFrame, job_types: Sequence[int] = JOB_TYPES) -> DataFrame:
    """Last status code per pipeline and batch; among equal times the higher ``flow_id``.

    A missing time sorts as the latest, as the metadata store sorts it. An aggregate with partial results, so a
    pipeline with most of the log does not end up in one task.
    """
    order = F.struct(F.col("flow_ts").isNull(), "flow_ts", "flow_id")
    return (
        with_codes(flow, "job_type_id", job_types)
        .groupBy("data_movement_id", "batch_id")
        .agg(F.max_by("status_code_id", order).alias("status_code_id"))
    )


def run_codes(runs: DataFrame, flow: DataFrame) -> DataFrame:
    """The last status code of each run, null where the log has none."""
    latest = latest_status(flow).withColumnRenamed("data_movement_id", "pipeline_id")
    return runs.select("pipeline_id", "batch_id").distinct().join(latest, ["pipeline_id", "batch_id"], "left")


def normalise_status(status: Column, flow_code: Column) -> Column:
    """Node status as reported; the first rule that holds decides, an unknown status gives null."""
    flow_failed = flow_code.isin(*FAILED_CODES)
    open_or_error = status.isin("PROGRESS", "ERROR") | status.isNull()
    return (
        F.when(status == "SUCCESS", "Succeeded")
        .when(status == "COMPLETED", "Completed")
        .when(open_or_error & flow_failed, "Failed")
        .when(status == "PROGRESS", "Running")
        .when(status == "ERROR", "Failed")
        .when(status.isNull(), "Waiting")
    )


def node_status(runs: DataFrame, objects: DataFrame, status: DataFrame, flow: DataFrame) -> DataFrame:
    """Every node of each run's pipeline with its normalised status, whether it ran or not.

    ``runs`` has ``pipeline_id, batch_id``. The run's own status code is looked up once per run, before its nodes
    are attached, so only the last join has the size of the node list.
    """
    coded = run_codes(runs, flow)
    nodes = objects.select(
        F.col("workspace_pipeline_id").alias("pipeline_id"),
        "object_id",
        json_path_text(F.col("object_info"), "config", "nodeName").alias("node_name"),
    )
    # A pipeline has few nodes and ever more runs, so the runs of a busy one are spread and its nodes copied.
    listed = runs.select("pipeline_id", "batch_id").distinct()
    per_run = counted_join(coded, nodes, ["pipeline_id"], ["batch_id"], counted=listed)
    ran = status.select(
        F.col("node_id").alias("object_id"),
        F.col("data_movement_id").alias("pipeline_id"),
        "batch_id",
        F.col("status").alias("raw_status"),
    )
    return per_run.join(ran, ["object_id", "pipeline_id", "batch_id"], "left").select(
        "pipeline_id",
        "batch_id",
        "object_id",
        "node_name",
        normalise_status(F.col("raw_status"), F.col("status_code_id")).alias("status"),
    )


def _listed(keywords: DataFrame | Mapping[str, Sequence[str]]) -> dict[str, list[str]] | None:
    """Keywords by step; none if a table holds more than ``LITERALS`` rows. Null and empty keywords speak of nothing."""
    if not isinstance(keywords, DataFrame):
        return {t: [w for w in words if w] for t, words in keywords.items()}
    rows = keywords.select("validation_type", "keyword").limit(LITERALS + 1).collect()
    if len(rows) > LITERALS:
        return None
    listed: dict[str, list[str]] = {}
    for r in rows:
        if r.validation_type is not None:
            listed.setdefault(r.validation_type, []).extend([r.keyword] if r.keyword else [])
    return listed


def speaks_of(node_name: Column, words: Sequence[str]) -> Column:
    """Whether a node's name holds any of the keywords."""
    name = lower_text(node_name)
    found = F.lit(False)
    for word in words:
        found = found | name.contains(F.lower(F.lit(word)))
    return found


def match_steps(nodes: DataFrame, keywords: DataFrame | Mapping[str, Sequence[str]] = KEYWORDS) -> DataFrame:
    """One row per node and step its name speaks of; a node can count for several steps, once for each.

    ``keywords`` are lists by step or a table of ``validation_type, keyword``. Up to ``LITERALS`` of them become one
    expression; more meet the distinct names by the first letters of each keyword.
    """
    listed = _listed(keywords)
    if listed is None:
        return _match_by_letters(nodes, keywords)
    if not listed:
        return nodes.withColumn("validation_type", F.lit(None).cast("string")).where(F.lit(False))
    types = F.filter(
        F.array(*[F.when(speaks_of(F.col("node_name"), words), F.lit(t)) for t, words in listed.items()]),
        lambda t: t.isNotNull(),
    )
    return nodes.withColumn("validation_type", F.explode(types))


def _match_by_letters(nodes: DataFrame, keywords: DataFrame) -> DataFrame:
    """``match_steps`` by a join of every stretch of up to ``LETTERS`` letters of a distinct name with the keywords that begin
    so; those that the name holds remain. Names, letters and nodes of a name may be hot, so both joins are salted."""
    words = keywords.where("validation_type IS NOT NULL AND keyword <> ''").select(
        "validation_type", F.lower("keyword").alias("word"), F.lower("keyword").substr(1, LETTERS).alias("letters")
    ).distinct()
    name = lower_text(F.col("node_name"))
    names = nodes.select(name.alias("_name")).where("_name <> ''").distinct()
    begins = F.sequence(F.lit(1), F.length("_name"))
    stretches = F.flatten(
        F.transform(begins, lambda at: F.array(*[F.substr("_name", at, F.lit(n)) for n in range(1, LETTERS + 1)]))
    )
    met = salted_join(names.select("_name", F.explode(F.array_distinct(stretches)).alias("letters")), words, ["letters"], ["_name"])
    steps = met.where(F.contains("_name", "word")).select("_name", "validation_type").distinct()
    return salted_join(nodes.withColumn("_name", name), steps, ["_name"], nodes.columns).drop("_name")


def step_status(nodes: DataFrame, keywords: DataFrame | Mapping[str, Sequence[str]] = KEYWORDS) -> DataFrame:
    """One row per run, one column per step: Fail if any node of the step failed, else Success if any succeeded, else NA.

    ``keywords`` as for ``match_steps``; a step without any keyword has a column too.
    """
    weight = _weight(F.col("status"))

    def rollup(t: str, worst: Column) -> Column:
        return F.when(worst == 2, "Fail").when(worst == 1, "Success").otherwise("NA").alias(t)

    listed, runs = _listed(keywords), ["pipeline_id", "batch_id"]
    if listed is not None:
        worst = {t: F.max(F.when(speaks_of(F.col("node_name"), words), weight)) for t, words in listed.items()}
        if not worst:
            return nodes.select(*runs).distinct()
        return nodes.groupBy(*runs).agg(*[rollup(t, w) for t, w in worst.items()])
    # Steps become columns, so their names are few.
    types = sorted(r[0] for r in keywords.where("validation_type IS NOT NULL").select("validation_type").distinct().collect())
    matched = _match_by_letters(nodes, keywords).select(*runs, "validation_type", weight.alias("_weight"))
    none = nodes.select(*runs, F.lit(None).cast("string").alias("validation_type"), F.lit(None).cast("int").alias("_weight"))
    worst = {t: F.max(F.when(F.col("validation_type") == t, F.col("_weight"))) for t in types}
    return matched.union(none).groupBy(*runs).agg(*[rollup(t, w) for t, w in worst.items()])


def _weight(status: Column) -> Column:
    status = upper_text(status)
    return F.when(status == "FAILED", 2).when(status == "SUCCEEDED", 1)


def step_status_rows(wide: DataFrame) -> DataFrame:
    """``step_status`` with one row per run and step."""
    types = [c for c in wide.columns if c not in ("pipeline_id", "batch_id")]
    rows = F.array(*[F.struct(F.lit(t).alias("validation_type"), F.col(f"`{t}`").alias("step_status")) for t in types])
    return wide.select("pipeline_id", "batch_id", F.inline(rows))


def with_node_type(objects: DataFrame, types: DataFrame) -> DataFrame:
    """Node definitions with the name of their type; one of unknown type is dropped.

    The key comes out of the definition's JSON and has few values, so the join is salted.
    """
    keyed = objects.withColumn("node_type_id", json_cast(F.col("object_info"), "int", "nodeTypeId"))
    names = types.select(F.col("node_type_id").cast("int").alias("node_type_id"), "node_type_name")
    return salted_join(keyed, names, ["node_type_id"], ["object_id"])


def node_execution(status: DataFrame, objects: DataFrame, types: DataFrame) -> DataFrame:
    """Node runs with the current definition of the node and the name of its type."""
    defined = with_node_type(current_rows(objects), types).select(
        F.col("workspace_pipeline_id").alias("data_movement_id"),
        F.col("object_id").alias("node_id"),
        "object_id",
        json_path_text(F.col("object_info"), "config", "nodeName").alias("node_name"),
        json_path_text(F.col("object_info"), "config", "description").alias("description"),
        "node_type_name",
    )
    ran = status.select("data_movement_id", "batch_id", "node_id", "status", "start_time", "end_time")
    return ran.join(defined, ["data_movement_id", "node_id"])


def status_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per status, largest first; a null status is left out."""
    counted = df.filter(F.col("status").isNotNull()).groupBy(*by, "status").agg(F.count("*").alias("n"))
    return counted.orderBy(*by, F.desc("n"), "status")


def status_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One line per group, ``status: n`` joined by a bar, the largest first."""
    counted = df.filter(F.col("status").isNotNull()).groupBy(*by, "status").agg(F.count("*").alias("n"))
    line = F.expr("listagg(concat(status, ': ', n), ' | ') WITHIN GROUP (ORDER BY n DESC, status)")
    return counted.groupBy(*by).agg(line.alias("status_summary"))


def total_records(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("total_records"))


def order_by_start(df: DataFrame) -> DataFrame:
    """By start time; runs that have not started come last, as in the metadata store."""
    return df.orderBy(F.asc_nulls_last("start_time"), "node_id")
