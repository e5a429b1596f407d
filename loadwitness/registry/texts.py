"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadwitness.functions import comments as C
from loadwitness.functions import jsonpath as J
from loadwitness.functions import scalars as S
from loadwitness.functions.rowhash import row_hash as hash_of
from loadwitness.operators.lookups import with_workspace
from loadwitness.operators.results import of_type
from loadwitness.plans.steps import EXPECTED, STEP_TYPES
from loadwitness.registry import query
from loadwitness.registry.inputs import SCALES, nodes, run_nodes
from loadwitness.registry.joins import URL
from loadwitness.registry.oracle_views import PAYLOAD, TAG, field


@query(
    "json_path_text",
    """SELECT object_id, object_info ->> '$.config.nodeName' AS node_name, object_info ->> '$.config.description' AS description,
       object_info ->> '$.config.absent' AS absent FROM fx_object""",
)
def json_path_text(d):
    info = F.col("object_info")
    return d.object.select(
        "object_id",
        J.json_path_text(info, "config", "nodeName").alias("node_name"),
        J.json_path_text(info, "config", "description").alias("description"),
        J.json_path_text(info, "config", "absent").alias("absent"),
    )


@query(
    "json_cast",
    """SELECT object_id, CAST(object_info ->> '$.nodeTypeId' AS INTEGER) AS node_type_id,
       TRY_CAST(object_info ->> '$.config.description' AS BIGINT) AS no_number FROM fx_object""",
)
def json_cast(d):
    info = F.col("object_info")
    return d.object.select(
        "object_id",
        J.json_cast(info, "int", "nodeTypeId").alias("node_type_id"),
        J.json_cast(info, "bigint", "config", "description", strict=False).alias("no_number"),
    )


@query("id_to_string", "SELECT node_id, CAST(node_batch_id AS VARCHAR) AS node_batch_text FROM fx_workflow_node")
def id_to_string(d):
    return d.workflow_node.select("node_id", S.id_to_string(F.col("node_batch_id")).alias("node_batch_text"))


@query(
    "cast_batch_id",
    """SELECT workflow_orch_id, batch_id, pos, TRY_CAST(coalesce(CAST(node_batch_id AS VARCHAR), 'None') AS BIGINT) AS cast_id
FROM ox_run_node""",
)
def cast_batch_id(d):
    text = F.coalesce(S.id_to_string(F.col("node_batch_id")), F.lit("None"))
    return run_nodes(d).select("workflow_orch_id", "batch_id", "pos", S.cast_batch_id(text).alias("cast_id"))


@query(
    "lower_upper",
    """SELECT n.node_id, lower(coalesce(o.object_info ->> '$.config.nodeName', '')) AS low_name, upper(n.status) AS up_status
FROM fx_node_status n JOIN fx_object o ON o.object_id = n.node_id""",
)
def lower_upper(d):
    named = d.object.select(F.col("object_id").alias("node_id"), J.json_path_text(F.col("object_info"), "config", "nodeName").alias("nm"))
    return d.node_status.join(named, "node_id").select(
        "node_id", S.lower_text(F.col("nm")).alias("low_name"), S.upper_text(F.col("status")).alias("up_status")
    )


@query(
    "contains",
    """SELECT seq, contains(comment, 'NULLs Exist') AS nulls_exist, contains(comment, 'present_only_in_source') AS source_only
FROM fx_validation_result""",
)
def contains(d):
    c = F.col("comment")
    return d.validation_result.select(
        "seq", S.contains(c, "NULLs Exist").alias("nulls_exist"), S.contains(c, C.SOURCE_ONLY).alias("source_only")
    )


@query("split_tag", f"SELECT seq, {TAG} AS tag, {PAYLOAD} AS payload FROM fx_validation_result WHERE validation_type = 'data'")
def split_tag(d):
    c = F.col("comment")
    return of_type(d.validation_result, "data").select("seq", C.tag(c).alias("tag"), C.payload(c).alias("payload"))


@query("parse_payload", "SELECT seq, text FROM ox_data")
def parse_payload(d):
    c = F.col("comment")
    return of_type(d.validation_result, "data").select("seq", C.render_payload(C.payload(c)).alias("text"))


@query(
    "strip_row_hash",
    f"""SELECT seq, trim(regexp_replace({PAYLOAD}, '\\|\\|[0-9a-fA-F]{{64}}$', '')) AS stripped
FROM fx_validation_result WHERE validation_type = 'data'""",
)
def strip_row_hash(d):
    return of_type(d.validation_result, "data").select("seq", C.strip_row_hash(C.payload(F.col("comment"))).alias("stripped"))


@query(
    "extract_schema",
    """SELECT seq, nullif(regexp_extract(comment, 'Source Schema:\\s*(\\[.*?\\])', 1), '') AS source_schema,
       nullif(regexp_extract(comment, 'Target Schema:\\s*(\\[.*?\\])', 1), '') AS target_schema
FROM fx_validation_result WHERE validation_type = 'schemas'""",
)
def extract_schema(d):
    c = F.col("comment")
    return of_type(d.validation_result, "schemas").select(
        "seq", C.source_schema(c).alias("source_schema"), C.target_schema(c).alias("target_schema")
    )


@query(
    "extract_counts",
    """SELECT seq, nullif(regexp_extract(comment, '(Source Row Count:|Number of rows in Source:)\\s*(\\d+)', 2), '') AS source_count,
       nullif(regexp_extract(comment, 'Target:\\s*(\\d+)', 1), '') AS target_count,
       nullif(regexp_extract(comment, 'Difference:\\s*(\\d+)', 1), '') AS difference
FROM fx_validation_result WHERE validation_type = 'row_count'""",
)
def extract_counts(d):
    c = F.col("comment")
    return of_type(d.validation_result, "row_count").select(
        "seq",
        C.source_count(c).alias("source_count"),
        C.target_count(c).alias("target_count"),
        C.difference(c).alias("difference"),
    )


@query(
    "format_pairs",
    """SELECT seq, CAST(pos AS INTEGER) AS pos, CASE WHEN strpos(part, ':') > 1 THEN substr(part, 1, strpos(part, ':') - 1) END AS key,
       CASE WHEN strpos(part, ':') > 1 THEN substr(part, strpos(part, ':') + 1) ELSE part END AS value
FROM (SELECT seq, generate_subscripts(a, 1) - 1 AS pos, CASE WHEN kind = 'not_null' THEN trim(unnest(a)) ELSE unnest(a) END AS part
      FROM (SELECT seq, validation_type AS kind,
                   string_split(trim(comment), CASE WHEN validation_type = 'not_null' THEN ',' ELSE ', ' END) AS a
            FROM fx_validation_result WHERE validation_type IN ('uniqueness', 'not_null')) x) y""",
)
def format_pairs(d):
    c = F.col("comment")
    pairs = F.when(F.col("validation_type") == "not_null", C.format_pairs(c, ",")).otherwise(C.format_pairs(c, ", "))
    found = of_type(d.validation_result, "uniqueness", "not_null").select("seq", F.posexplode(pairs).alias("pos", "pair"))
    return found.select("seq", "pos", "pair.key", "pair.value")


@query(
    "workspace_url",
    f"""SELECT r.pipeline_id, CASE WHEN w.workspace_id IS NULL THEN 'N/A' ELSE concat('{URL}/workspace?workspace_id=', w.workspace_id,
       '&pipeline_id=', r.pipeline_id, '&active_tab=curationUI') END AS pipeline_url
FROM fx_run r LEFT JOIN fx_workspace_pipeline w ON w.workspace_pipeline_id = r.pipeline_id""",
)
def workspace_url(d):
    return with_workspace(d.run, d.workspace_pipeline, URL).select("pipeline_id", "pipeline_url")


@query("format_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text FROM events")
def format_ts(d):
    return d.events.select("event_id", S.format_ts(F.col("ts")).alias("ts_text"))


_ORDER_TEXTS = [
    "CAST(o_orderkey AS VARCHAR)",
    "CAST(o_custkey AS VARCHAR)",
    "o_orderstatus",
    "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)",
    "CAST(o_orderdate AS VARCHAR)",
    "o_orderpriority",
]
_DOCUMENT_TEXTS = ["CAST(doc_id AS VARCHAR)", "text", "lang", "source", "CAST(n_chars AS VARCHAR)"]


def _hash_sql(texts: list[str]) -> str:
    return f"sha256(concat({', '.join(field(t) for t in texts)}))"


@query("row_hash", f"SELECT o_orderkey AS id, {_hash_sql(_ORDER_TEXTS)} AS row_hash FROM orders")
def row_hash(d):
    return d.orders.select(F.col("o_orderkey").alias("id"), hash_of(d.orders.schema, SCALES).alias("row_hash"))


@query("row_hash_text", f"SELECT doc_id AS id, {_hash_sql(_DOCUMENT_TEXTS)} AS row_hash FROM documents")
def row_hash_text(d):
    return d.documents.select(F.col("doc_id").alias("id"), hash_of(d.documents.schema).alias("row_hash"))


_EXPECTED_SQL = " UNION ALL ".join(
    f"SELECT {s} AS step_id, {i} AS line_no, '{i}. {text.replace(chr(39), chr(39) * 2)}' AS expected"
    for s in STEP_TYPES
    for i, text in enumerate(EXPECTED[s], 1)
)


@query("numbered_expected", f"SELECT r.pipeline_id, e.step_id, e.line_no, e.expected FROM fx_run r CROSS JOIN ({_EXPECTED_SQL}) e")
def numbered_expected(d):
    steps = F.array(
        *[F.struct(F.lit(s).alias("step_id"), S.numbered(F.array(*[F.lit(t) for t in EXPECTED[s]])).alias("texts")) for s in STEP_TYPES]
    )
    rows = d.run.select("pipeline_id", F.explode(steps).alias("s")).select("pipeline_id", "s.step_id", F.posexplode("s.texts"))
    return rows.select("pipeline_id", "step_id", (F.col("pos") + 1).alias("line_no"), F.col("col").alias("expected"))


@query(
    "status_class",
    """SELECT pipeline_id, batch_id, object_id, CASE status WHEN 'Success' THEN 'ok' WHEN 'Failed' THEN 'error' ELSE 'neutral' END
       AS status_class FROM ox_node_status""",
)
def status_class(d):
    return nodes(d).select("pipeline_id", "batch_id", "object_id", S.status_class(F.col("status")).alias("status_class"))
