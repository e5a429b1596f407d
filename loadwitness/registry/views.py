"""Derived inputs (``fx_``) in SQL that Spark and DuckDB run alike, and helper views (``ox_``) of the oracles.

The one difference is how a list becomes rows: ``explode(sequence(1, n))`` reads ``unnest(generate_series(1, n))`` in DuckDB.

Every view covers its whole table, so inputs grow with the data. What the rules call missing (a node that never ran, a
batch without comments) is a row under another batch or id, not a row left out. One pipeline per customer; its current
batch is ``1000 + c_custkey``; ``OLD`` moves an id out of the way.
"""

from __future__ import annotations

import re

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark"]

OLD = "1000000000000000"


def older(condition: str, batch: str) -> str:
    return f"CASE WHEN {condition} THEN {batch} - {OLD} ELSE {batch} END"


CUSTOMER_BATCH = "1000 + c_custkey"


_BOTH_SCHEMAS = "'Source Schema: [id: bigint, day: string] Target Schema: [id: bigint, day: date]'"

# Comments of each pipeline: type, when the current batch has none, text.
_COMMENTS = [
    (
        "schemas",
        "c_custkey % 29 = 0",
        f"CASE WHEN c_custkey % 12 = 0 THEN 'Source Schema: [id: bigint, day: string]' ELSE {_BOTH_SCHEMAS} END",
    ),
    # A second comment on some batches: the last one counts.
    (
        "schemas",
        "c_custkey % 5 <> 0",
        f"CASE WHEN c_custkey % 15 = 0 THEN 'Source Schema: [N/A] Target Schema: [id: int]' ELSE {_BOTH_SCHEMAS} END",
    ),
    ("schema", "c_custkey % 8 <> 0", "concat(' Column c', c_custkey, ': source string, target int ')"),
    (
        "row_count",
        "c_custkey % 13 = 0",
        "concat(CASE WHEN c_custkey % 2 = 0 THEN 'Source Row Count: ' ELSE 'Number of rows in Source: ' END,"
        " 100 + c_custkey % 3, ', Target: ', 101, ', Difference: ', c_custkey % 3 - 1)",
    ),
    # A second comment on some batches: the first one counts.
    ("row_count", "c_custkey % 4 <> 0", "concat('Source Row Count: ', c_custkey, ', Target: 0, Difference: ', c_custkey)"),
    (
        "uniqueness",
        "c_custkey % 16 = 0",
        "concat('Column: id, Status: ', CASE WHEN c_custkey % 5 = 0 THEN 'NOT_UNIQUE' WHEN c_custkey % 7 = 0 THEN 'failed'"
        " ELSE 'unique' END, ', Duplicates: ', c_custkey % 5)",
    ),
    ("uniqueness", "c_custkey % 3 <> 0", "concat('Column: day, Status: unique, Note: a:b', c_custkey % 2)"),
    (
        "not_null",
        "c_custkey % 14 = 0",
        "concat('Column: phase, Result: ', CASE WHEN c_custkey % 6 = 0 THEN 'NULLs Exist' WHEN c_custkey % 7 = 1"
        " THEN 'nulls exist' WHEN c_custkey % 11 = 1 THEN 'check failed' ELSE 'No NULLs' END, ',Count: ', c_custkey % 6)",
    ),
    ("ingestion", "c_custkey % 3 = 0", "concat(' loaded ', c_name)"),
]


def _choose(values: list[str]) -> str:
    return "CASE k " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values, 1)) + " END"


_PIPELINE_COMMENTS = f"""SELECT k * {OLD} + c_custkey AS seq,
       CASE WHEN {_choose([missing for _, missing, _ in _COMMENTS])} THEN {CUSTOMER_BATCH} - {OLD} ELSE {CUSTOMER_BATCH} END AS batch_id,
       {_choose([f"'{kind}'" for kind, _, _ in _COMMENTS])} AS validation_type,
       {_choose([text for _, _, text in _COMMENTS])} AS comment
FROM (SELECT c_custkey, c_name, explode(sequence(1, {len(_COMMENTS)})) AS k FROM customer) c"""

_DATA_COMMENTS = f"""SELECT 10 * {OLD} + o_orderkey AS seq, {older("o_custkey % 4 = 0", "1000 + o_custkey")} AS batch_id,
       'data' AS validation_type,
       CASE WHEN o_orderkey % 37 = 0 THEN concat('unknown tag||', o_orderkey)
            WHEN o_orderkey % 41 = 0 THEN 'present_only_in_source'
            WHEN o_orderkey % 2 = 0
            THEN concat('present_only_in_source||{{"o_orderkey":"', o_orderkey, '","o_orderstatus":"', o_orderstatus,
                        '","row_hash":"', repeat('a', 64), '"}}')
            ELSE concat('present_only_in_destination||', o_orderkey, ',', o_orderstatus, '||', repeat('0F', 32)) END AS comment
FROM orders"""

# A third of the runs share the validation workflow of supplier 0.
_CHILD = "CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey END"

_PARENT_NODES = f"""SELECT s_suppkey AS workflow_orch_id, {older("(s_suppkey + k) % 5 = 0", "5000 + s_suppkey")} AS batch_id,
       s_suppkey * 10 + k AS node_id, 90000000000000000 + s_suppkey * 10 + k AS node_batch_id,
       CASE WHEN (s_suppkey + k) % 6 = 0 THEN 'FAILED' WHEN (s_suppkey + k) % 11 = 0 THEN 'RUNNING' ELSE 'SUCCESS' END AS status
FROM (SELECT s_suppkey, explode(sequence(1, 5)) AS k FROM supplier) p"""

_CHILD_NODES = f"""SELECT -1 - ({_CHILD}) AS workflow_orch_id,
       {older("(s_suppkey + k) % 7 = 0", "90000000000000000 + s_suppkey * 10 + 2")} AS batch_id,
       -10 - ({_CHILD}) * 10 - k AS node_id, 1000 + s_suppkey * 10 + k AS node_batch_id,
       CASE WHEN (s_suppkey + k) % 4 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM (SELECT s_suppkey, explode(sequence(1, 6)) AS k FROM supplier) c"""

SPARK_VIEWS = {
    # Source and target: moved keys (every 97th), other prices (89th), null priorities (83rd), doubled rows (79th).
    "fx_source": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS o_orderday
FROM orders""",
    "fx_target": """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CAST(o_orderdate AS DATE) AS o_orderday
FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE)
FROM orders WHERE o_orderkey % 79 = 0""",
    "fx_run": """
SELECT c_custkey AS seq, 5000 + CAST(floor(c_custkey / 15) AS BIGINT) AS dataflow_batch_id, c_custkey AS pipeline_id,
       1000 + c_custkey AS batch_id,
       concat('load ', c_name, CASE WHEN c_custkey % 5 = 0 THEN ': v1/2?' ELSE '' END) AS pipeline_name,
       CASE WHEN c_custkey % 10 = 0 THEN 'FAILED' WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'success'
            ELSE 'SUCCESS' END AS status,
       CASE WHEN c_custkey % 9 = 0 THEN 'FAILED' WHEN c_custkey % 19 = 0 THEN 'RUNNING' ELSE 'SUCCESS' END AS ingestion_status,
       concat('ing ', c_mktsegment) AS ingestion_name
FROM customer""",
    "fx_flow_status": f"""
SELECT o_orderkey AS flow_id, o_custkey AS data_movement_id, 1000 + o_custkey - {OLD} * (o_orderkey % 3) AS batch_id,
       CASE WHEN o_orderkey % 7 < 3 THEN 3 WHEN o_orderkey % 7 < 5 THEN 25 ELSE 4 END AS job_type_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 12 WHEN '2-HIGH' THEN 13 WHEN '5-LOW' THEN 29 ELSE 14 END AS status_code_id,
       CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE o_orderdate END AS flow_ts
FROM orders""",
    "fx_object": """
SELECT object_id, workspace_pipeline_id,
       CASE WHEN nm IS NULL
            THEN concat('{"config":{"description":"step ', idx, '"},"nodeTypeId":"', object_id % 30, '"}')
            ELSE concat('{"config":{"nodeName":"', nm, '","description":"step ', idx, '"},"nodeTypeId":"', object_id % 30, '"}')
       END AS object_info,
       CASE WHEN object_id % 7 = 0 THEN '2024-01-31 00:00:00.000' ELSE '9999-12-31 00:00:00.000' END AS valid_to_ts
FROM (
  SELECT object_id, workspace_pipeline_id, idx,
         CASE idx WHEN 0 THEN 'Rest API Source' WHEN 1 THEN 'Get Body' WHEN 2 THEN 'Fetching Source Schema'
                  WHEN 3 THEN 'Fetching Target Schema' WHEN 4 THEN 'Schema Validator' WHEN 5 THEN 'Saving Schema Validation Result'
                  WHEN 6 THEN 'Data Validation' WHEN 7 THEN 'Saving Data Validation Result' WHEN 8 THEN 'Row Count Validator'
                  WHEN 9 THEN 'Uniqueness Validator' WHEN 10 THEN 'Saving Uniqueness Validation' WHEN 11 THEN 'NOT NULL Validator'
                  WHEN 12 THEN 'Target' ELSE NULL END AS nm
  FROM (SELECT o_orderkey AS object_id, o_custkey AS workspace_pipeline_id, o_orderkey % 14 AS idx FROM orders) a
) b""",
    "fx_node_status": f"""
SELECT o_orderkey AS node_id, o_custkey AS data_movement_id, {older("o_orderkey % 11 = 0", "1000 + o_custkey")} AS batch_id,
       CASE WHEN o_orderkey % 53 = 0 THEN 'ERROR' WHEN o_orderkey % 31 = 0 THEN 'PROGRESS' WHEN o_orderkey % 17 = 0 THEN 'COMPLETED'
            WHEN o_orderkey % 37 = 0 THEN 'SKIPPED' WHEN o_orderkey % 41 = 0 THEN 'Success' WHEN o_orderkey % 43 = 0 THEN 'Failed' WHEN o_orderkey % 59 = 0 THEN NULL ELSE 'SUCCESS' END AS status,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderdate END AS start_time,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderdate END AS end_time
FROM orders""",
    "fx_node_type": "SELECT n_nationkey AS node_type_id, n_name AS node_type_name FROM nation",
    "fx_validation_result": f"{_PIPELINE_COMMENTS}\nUNION ALL\n{_DATA_COMMENTS}",
    "fx_workflow": f"""
SELECT s_suppkey AS workflow_orch_id,
       concat('{{"workflowJson":{{"nodeDataArray":[',
              CASE WHEN s_suppkey % 13 = 5 THEN '' ELSE concat('{{"nodeId":"', s_suppkey * 10 + 1,
                   '","config":{{"name":"Ingestion pipeline","data_movement_name":"ing ', s_suppkey,
                   '","data_movement_id":"', s_suppkey, '"}}}},') END,
              '{{"nodeId":"', s_suppkey * 10 + 2, '","config":{{"name":"Validation dataflow","workflow_orch_name":"val ', s_suppkey,
              '","workflow_orch_id":"', -1 - ({_CHILD}), '"}}}},',
              '{{"nodeId":"', s_suppkey * 10 + 3, '","config":{{"name":"Target crawler"}}}},',
              CASE WHEN s_suppkey % 5 <> 0 THEN '' ELSE concat('{{"nodeId":"', s_suppkey * 10 + 5,
                   '","config":{{"name":"Ingestion pipeline","data_movement_name":"again ', s_suppkey,
                   '","data_movement_id":"', s_suppkey, '"}}}},') END,
              '{{"nodeId":"', s_suppkey * 10 + 4, '","config":{{"name":"', CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'Notify' END,
              '"}}}}]}}}}') AS workflow_orch_json
FROM supplier
UNION ALL
SELECT -1 - s_suppkey,
       CASE WHEN s_suppkey % 25 = 7 THEN '{{"workflowJson":{{}}}}' ELSE
       concat('{{"workflowJson":{{"nodeDataArray":[',
              '{{"nodeId":"', -11 - s_suppkey * 10, '","config":{{"name":"Modify validation pipelines"}}}},',
              '{{"nodeId":"', -12 - s_suppkey * 10, '","config":{{"name":"Target crawler"}}}},',
              '{{"nodeId":"', -13 - s_suppkey * 10, '","config":{{"name":"Validate orders","data_movement_name":"orders ', s_suppkey,
              '","data_movement_id":"', s_suppkey * 3, '"}}}},',
              '{{"nodeId":"', -14 - s_suppkey * 10, '","config":{{"name":"Validate lines","data_movement_name":"lines ', s_suppkey,
              '","data_movement_id":"', s_suppkey * 3 + 1, '"}}}},',
              '{{"nodeId":"', -15 - s_suppkey * 10, '","config":{{}}}},',
              '{{"nodeId":"', -16 - s_suppkey * 10, '","config":{{"name":"Validate parts","data_movement_name":"parts ', s_suppkey,
              '","data_movement_id":"', s_suppkey * 3 + 2, '"}}}}]}}}}') END
FROM supplier""",
    "fx_workflow_node": f"{_PARENT_NODES} UNION ALL {_CHILD_NODES}",
    "fx_workspace_pipeline": """
SELECT CASE WHEN c_custkey % 20 = 0 THEN -1 - c_custkey ELSE c_custkey END AS workspace_pipeline_id, c_custkey % 12 AS workspace_id,
       CASE WHEN c_custkey % 21 = 0 THEN '{"pipelineJson":{}}' ELSE
       concat('{"pipelineJson":{"pipeline_config":{"flow_details":{"user_variables":{"user_variables_details":[',
              CASE WHEN c_custkey % 6 = 0 THEN '' ELSE concat('{"variable":"source_obj_name","value":"', c_name, '"},') END,
              CASE WHEN c_custkey % 7 = 0 THEN '{"variable":"target_obj_name","value":""},'
                   ELSE concat('{"variable":"target_obj_name","value":"', c_mktsegment, '"},') END,
              '{"variable":"other","value":"x"}]}}}}}') END AS workspace_pipeline_json
FROM customer""",
    "fx_init_flow": """
SELECT user_id AS job_schedule_id, 5000 + CAST(floor(event_id / 100) AS BIGINT) AS batch_id,
       CASE WHEN event_type = 'signup' THEN 12 ELSE 13 END AS status_code_id, ts AS valid_from_ts
FROM events""",
    "fx_schedule": "SELECT c_custkey AS job_schedule_id, concat(c_name, '@example.org') AS cru_by FROM customer",
    "fx_version": """
SELECT p_partkey AS data_movement_id, p_name AS data_movement_name,
       CASE WHEN p_partkey % 3 = 0 THEN '2024-01-31 00:00:00.000' ELSE '9999-12-31 00:00:00.000' END AS valid_to_ts
FROM part""",
    "fx_wanted_name": """
SELECT CASE WHEN p_partkey % 9 = 0 THEN concat(p_name, ' (gone)') ELSE p_name END AS data_movement_name FROM part""",
}

ORACLE_VIEWS: dict[str, str] = {}


def with_views(sql: str, views: dict[str, str] | None = None) -> str:
    """``sql`` with the views it uses in front, each once and after those it builds on; for DuckDB unless ``views`` are given."""
    if views is None:
        both = {**SPARK_VIEWS, **ORACLE_VIEWS}
        views = {name: text.replace("explode(sequence(", "unnest(generate_series(") for name, text in both.items()}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:fx|ox)_\w+", text):
            if name in views and name not in order:
                visit(views[name])
                order.append(name)

    visit(sql)
    if not order:
        return sql
    chain = ",\n".join(f"{name} AS ({views[name].strip()})" for name in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {chain},\n{body[5:]}"
    return f"WITH {chain}\n{body}"
