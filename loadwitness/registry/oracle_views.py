"""Helper views of the oracles, in DuckDB SQL. They state the rules a second time, independently of the Spark code."""

from __future__ import annotations

from loadwitness.registry.views import ORACLE_VIEWS


def _values(rows: list[tuple]) -> str:
    def lit(v) -> str:
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


# Words in the names of nodes, stated once more so that a wrong one shows.
KEYWORD_ROWS = _values(
    [
        ("schema", "schema validator"),
        ("schema", "fetching source schema"),
        ("schema", "fetching target schema"),
        ("schema", "saving schema validation result"),
        ("data", "data validation"),
        ("data", "saving data validation result"),
        ("row_count", "row count validator"),
        ("row_count", "saving row count validation"),
        ("uniqueness", "uniqueness validator"),
        ("uniqueness", "saving uniqueness validation"),
        ("not_null", "not null validator"),
        ("not_null", "saving not null validation"),
        ("ingestion", "rest api source"),
        ("ingestion", "target"),
        ("ingestion", "get body"),
        ("ingestion", "ingestion"),
    ]
)
STEP_ROWS = _values([(1, "ingestion"), (2, "schema"), (3, "data"), (4, "row_count"), (5, "uniqueness"), (6, "not_null")])


def field(expr: str) -> str:
    return f"coalesce(length({expr}) || ':' || {expr}, '~')"


def hashed(columns: dict[str, str], table: str) -> str:
    """``row_hash, copies`` and the canonical text of each column, one row per distinct row."""
    texts = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    joined = ", ".join(field(name) for name in columns)
    names = ", ".join(columns)
    return f"""SELECT sha256(concat({joined})) AS row_hash, count(*) AS copies, {names}
FROM (SELECT {texts} FROM {table}) x GROUP BY {names}"""


PAIR_COLUMNS = {
    "o_orderkey": "CAST(o_orderkey AS VARCHAR)",
    "o_custkey": "CAST(o_custkey AS VARCHAR)",
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)",
    "o_orderpriority": "o_orderpriority",
    "o_orderday": "CAST(CAST(o_orderday AS DATE) AS VARCHAR)",
}

STATUS_CASE = """CASE WHEN n.status = 'SUCCESS' THEN 'Succeeded' WHEN n.status = 'COMPLETED' THEN 'Completed'
     WHEN (n.status IN ('PROGRESS', 'ERROR') OR n.status IS NULL) AND f.status_code_id IN (13, 29, 32) THEN 'Failed'
     WHEN n.status = 'PROGRESS' THEN 'Running' WHEN n.status = 'ERROR' THEN 'Failed' WHEN n.status IS NULL THEN 'Waiting' END"""

TAG = "split_part(comment, '||', 1)"
PAYLOAD = "CASE WHEN contains(comment, '||') THEN substr(comment, strpos(comment, '||') + 2) ELSE '' END"


def _not_unique(rules: str) -> str:
    return "contains(lower(comment), 'not_unique')" + (" OR contains(lower(comment), 'fail')" if rules == "r1" else "")


def _nulls(rules: str) -> str:
    if rules == "r3":
        return "contains(comment, 'NULLs Exist')"
    found = "(contains(lower(comment), 'nulls') AND NOT contains(lower(comment), 'no nulls'))"
    return found + (" OR contains(lower(comment), 'fail')" if rules == "r1" else "")


def _count(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


def _facts(rules: str) -> str:
    return f"""SELECT batch_id,
  {_count("validation_type = 'ingestion'")} AS n_ingestion, {_count("validation_type = 'schema'")} AS n_schema,
  arg_max(comment, seq) FILTER (validation_type = 'schemas') AS schemas_comment,
  {_count("validation_type = 'data'")} AS n_data,
  {_count(f"validation_type = 'data' AND contains({TAG}, 'present_only_in_source')")} AS n_source,
  {_count(f"validation_type = 'data' AND contains({TAG}, 'present_only_in_destination')")} AS n_target,
  {_count("validation_type = 'row_count'")} AS n_row_count,
  arg_min(comment, seq) FILTER (validation_type = 'row_count') AS row_count_comment,
  {_count("validation_type = 'uniqueness'")} AS n_uniqueness,
  {_count(f"validation_type = 'uniqueness' AND ({_not_unique(rules)})")} AS n_not_unique,
  {_count("validation_type = 'not_null'")} AS n_not_null,
  {_count(f"validation_type = 'not_null' AND ({_nulls(rules)})")} AS n_nulls
FROM fx_validation_result GROUP BY batch_id"""


def _verdicts(rules: str) -> str:
    if rules == "r1":
        shown = "coalesce(s.step_status, 'NA')"
    else:
        gate = "upper(r.status)" if rules == "r3" else "r.status"
        shut, own = ("'Fail'", "r.ingestion_status") if rules == "r3" else ("'NA'", "r.status")
        shown = f"""CASE WHEN t.step_id = 1 THEN {own}
          WHEN coalesce({gate} = 'SUCCESS', false) THEN coalesce(s.step_status, 'NA') ELSE {shut} END"""
    one = {
        "r1": "CASE WHEN execution_status = 'Success' AND n_ingestion > 0 THEN 'Pass' ELSE 'NA' END",
        "r2": "CASE execution_status WHEN 'SUCCESS' THEN 'Pass' WHEN 'FAILED' THEN 'Fail' ELSE 'NA' END",
    }
    one["r3"] = one["r2"]
    schema_bad = "coalesce(n_schema, 0) > 0"
    if rules != "r1":
        for which in ("Source", "Target"):
            found = f"coalesce(regexp_extract(schemas_comment, '{which} Schema:\\s*(\\[.*?\\])', 1), '')"
            schema_bad += f" OR {found} = '' OR contains({found}, 'N/A')"
    no_data = "WHEN step_id = 3 AND coalesce(n_data, 0) = 0 THEN 'NA'" if rules == "r1" else ""
    return f"""SELECT pipeline_id, batch_id, step_id, validation_type, execution_status,
  CASE WHEN step_id = 1 THEN {one[rules]}
       WHEN execution_status <> 'Success' THEN 'NA'
       WHEN step_id = 2 THEN CASE WHEN {schema_bad} THEN 'Fail' ELSE 'Pass' END
       {no_data}
       WHEN step_id = 3 THEN CASE WHEN coalesce(n_source, 0) + coalesce(n_target, 0) > 0 THEN 'Fail' ELSE 'Pass' END
       WHEN step_id = 4 THEN CASE WHEN coalesce(n_row_count, 0) = 0 THEN 'NA'
            WHEN regexp_extract(row_count_comment, 'Difference:\\s*(\\d+)', 1) = '0' THEN 'Pass' ELSE 'Fail' END
       WHEN step_id = 5 THEN CASE WHEN coalesce(n_uniqueness, 0) = 0 THEN 'NA' WHEN n_not_unique > 0 THEN 'Fail' ELSE 'Pass' END
       ELSE CASE WHEN coalesce(n_not_null, 0) = 0 THEN 'NA' WHEN n_nulls > 0 THEN 'Fail' ELSE 'Pass' END END AS verdict
FROM (
  SELECT r.pipeline_id, r.batch_id, t.step_id, t.validation_type, {shown} AS execution_status, f.* EXCLUDE (batch_id)
  FROM fx_run r CROSS JOIN ox_step t
  LEFT JOIN ox_step_status s USING (pipeline_id, batch_id, validation_type)
  LEFT JOIN ox_facts_{rules} f ON f.batch_id = r.batch_id
) x"""


ORACLE_VIEWS.update(
    {
        "ox_hashed_source": hashed(PAIR_COLUMNS, "fx_source"),
        "ox_hashed_target": hashed(PAIR_COLUMNS, "fx_target"),
        "ox_latest": """
SELECT data_movement_id, batch_id, status_code_id FROM (
  SELECT *, row_number() OVER (PARTITION BY data_movement_id, batch_id ORDER BY flow_ts DESC NULLS FIRST, flow_id DESC) AS rn
  FROM fx_flow_status WHERE job_type_id IN (3, 25)) x WHERE rn = 1""",
        "ox_node_status": f"""
SELECT r.pipeline_id, r.batch_id, o.object_id, o.object_info ->> '$.config.nodeName' AS node_name, {STATUS_CASE} AS status
FROM fx_run r JOIN fx_object o ON o.workspace_pipeline_id = r.pipeline_id
LEFT JOIN fx_node_status n ON n.node_id = o.object_id AND n.data_movement_id = r.pipeline_id AND n.batch_id = r.batch_id
LEFT JOIN ox_latest f ON f.data_movement_id = r.pipeline_id AND f.batch_id = r.batch_id""",
        "ox_keyword": f"SELECT * FROM (VALUES {KEYWORD_ROWS}) k(validation_type, keyword)",
        "ox_step": f"SELECT * FROM (VALUES {STEP_ROWS}) s(step_id, validation_type)",
        "ox_match": """
SELECT DISTINCT n.pipeline_id, n.batch_id, n.object_id, n.node_name, n.status, k.validation_type
FROM ox_node_status n JOIN ox_keyword k ON contains(lower(coalesce(n.node_name, '')), k.keyword)""",
        "ox_step_status": """
SELECT r.pipeline_id, r.batch_id, t.validation_type,
       CASE WHEN count(*) FILTER (upper(m.status) = 'FAILED') > 0 THEN 'Fail'
            WHEN count(*) FILTER (upper(m.status) = 'SUCCEEDED') > 0 THEN 'Success' ELSE 'NA' END AS step_status
FROM (SELECT DISTINCT pipeline_id, batch_id FROM ox_node_status) r CROSS JOIN ox_step t
LEFT JOIN ox_match m ON m.pipeline_id = r.pipeline_id AND m.batch_id = r.batch_id AND m.validation_type = t.validation_type
GROUP BY r.pipeline_id, r.batch_id, t.validation_type""",
        **{f"ox_facts_{r}": _facts(r) for r in ("r1", "r2", "r3")},
        **{f"ox_verdict_{r}": _verdicts(r) for r in ("r1", "r2", "r3")},
        "ox_verdict": " UNION ALL ".join(f"SELECT '{r}' AS rules, * FROM ox_verdict_{r}" for r in ("r1", "r2", "r3")),
        "ox_data": f"""
SELECT batch_id, seq, side, payload,
       CASE WHEN payload LIKE '{{%' THEN concat('o_orderkey: ', payload ->> '$.o_orderkey', ', o_orderstatus: ', payload ->> '$.o_orderstatus')
            ELSE trim(regexp_replace(payload, '\\|\\|[0-9a-fA-F]{{64}}$', '')) END AS text
FROM (SELECT batch_id, seq, {PAYLOAD} AS payload,
             CASE WHEN contains({TAG}, 'present_only_in_source') THEN 'present_only_in_source'
                  WHEN contains({TAG}, 'present_only_in_destination') THEN 'present_only_in_destination' ELSE 'other' END AS side
      FROM fx_validation_result WHERE validation_type = 'data') x""",
        "ox_node": """
SELECT workflow_orch_id, CAST(pos AS INTEGER) AS pos, node ->> '$.nodeId' AS node_id, node ->> '$.config.name' AS node_name,
       coalesce(node ->> '$.config.data_movement_name', node ->> '$.config.workflow_orch_name') AS pipeline_name,
       coalesce(node ->> '$.config.data_movement_id', node ->> '$.config.workflow_orch_id') AS pipeline_id
FROM (SELECT workflow_orch_id, unnest(a) AS node, generate_subscripts(a, 1) - 1 AS pos
      FROM (SELECT workflow_orch_id, CAST(workflow_orch_json -> '$.workflowJson.nodeDataArray' AS JSON[]) AS a FROM fx_workflow) x) y""",
        # Runs of the main dataflows, found through the batches of their nodes.
        "ox_run": """
SELECT DISTINCT w.workflow_orch_id, w.batch_id FROM fx_workflow_node w WHERE w.workflow_orch_id >= 0""",
        "ox_run_node": """
SELECT r.workflow_orch_id, r.batch_id, n.pos, n.node_id, n.node_name, n.pipeline_name, n.pipeline_id, s.node_batch_id, s.status
FROM ox_run r JOIN ox_node n ON n.workflow_orch_id = r.workflow_orch_id
LEFT JOIN fx_workflow_node s ON s.node_id = CAST(n.node_id AS BIGINT) AND s.batch_id = r.batch_id""",
        "ox_detail": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY workflow_orch_id, batch_id, node_name ORDER BY pos DESC) AS rn
  FROM ox_run_node WHERE node_name <> '') x WHERE rn = 1""",
        "ox_child": """
SELECT p.workflow_orch_id AS dataflow_id, p.batch_id AS dataflow_batch_id, n.pos AS seq, n.node_name, n.pipeline_name,
       n.pipeline_id, s.node_batch_id AS pipeline_batch_id, s.status
FROM ox_detail p JOIN ox_node n ON n.workflow_orch_id = CAST(p.pipeline_id AS BIGINT)
LEFT JOIN fx_workflow_node s ON s.node_id = CAST(n.node_id AS BIGINT) AND s.batch_id = p.node_batch_id
WHERE p.node_name = 'Validation dataflow' AND n.node_name NOT IN ('Modify validation pipelines', 'Target crawler')""",
        "ox_route": """
SELECT r.workflow_orch_id, r.batch_id, d.status AS ingestion_status, d.pipeline_name AS ingestion_name,
       CASE WHEN d.status = 'FAILED' THEN 'failed' WHEN d.status IS NULL OR d.status = 'SUCCESS' THEN 'validate' ELSE 'pending' END AS route
FROM ox_run r LEFT JOIN ox_detail d
  ON d.workflow_orch_id = r.workflow_orch_id AND d.batch_id = r.batch_id AND d.node_name = 'Ingestion pipeline'""",
        "ox_start": """
SELECT batch_id, executed_by, started_at FROM (
  SELECT f.batch_id, s.cru_by AS executed_by, f.valid_from_ts AS started_at,
         row_number() OVER (PARTITION BY f.batch_id ORDER BY f.valid_from_ts, f.job_schedule_id, s.cru_by) AS rn
  FROM fx_init_flow f JOIN fx_schedule s USING (job_schedule_id) WHERE f.status_code_id = 12) x WHERE rn = 1""",
        "ox_variable": """
SELECT pipeline_id, v ->> '$.variable' AS variable, v ->> '$.value' AS value
FROM (SELECT workspace_pipeline_id AS pipeline_id, unnest(CAST(workspace_pipeline_json ->
        '$.pipelineJson.pipeline_config.flow_details.user_variables.user_variables_details' AS JSON[])) AS v
      FROM fx_workspace_pipeline) x""",
        "ox_names": """
SELECT w.workspace_pipeline_id AS pipeline_id, max(CASE WHEN v.variable = 'source_obj_name' THEN v.value END) AS source_obj_name,
       max(CASE WHEN v.variable = 'target_obj_name' THEN v.value END) AS target_obj_name
FROM fx_workspace_pipeline w LEFT JOIN ox_variable v ON v.pipeline_id = w.workspace_pipeline_id GROUP BY 1""",
        "ox_execution": """
SELECT n.data_movement_id, n.batch_id, n.node_id, n.status, n.start_time, n.end_time, o.object_id, t.node_type_name,
       o.object_info ->> '$.config.nodeName' AS node_name, o.object_info ->> '$.config.description' AS description
FROM fx_node_status n JOIN fx_object o ON n.data_movement_id = o.workspace_pipeline_id AND n.node_id = o.object_id
JOIN fx_node_type t ON t.node_type_id = CAST(o.object_info ->> '$.nodeTypeId' AS INTEGER)
WHERE o.valid_to_ts = '9999-12-31 00:00:00.000'""",
    }
)
