"""Validators, the suite, and the verdicts that follow from it."""

from __future__ import annotations

from dataclasses import replace

from loadwitness.operators import checks
from loadwitness.plans import suite
from loadwitness.registry import query
from loadwitness.registry.inputs import SCALES, TEXT_TO_DATE, mappings, object_of
from loadwitness.registry.oracle_views import PAIR_COLUMNS
from loadwitness.sources.objects import load_target
from loadwitness.sources.specs import specs_frame

_TYPE = "CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' END"


def _schema_rows() -> str:
    rows = []
    for i, c in enumerate(PAIR_COLUMNS):
        bad = f"{c} IS NOT NULL AND TRY_CAST({c} AS DATE) IS NULL" if c == "o_orderday" else "false"
        rows.append(
            f"""SELECT '{c}' AS column_name, (SELECT any_value({_TYPE.format(c=c)}) FROM fx_source) AS source_type,
       (SELECT any_value({_TYPE.format(c=c)}) FROM fx_target) AS target_type, {i} AS source_pos, {i} AS target_pos,
       (SELECT count(*) FILTER ({bad}) FROM fx_source) AS unconvertible"""
        )
    return "\nUNION ALL ".join(rows)


@query(
    "schema_check",
    f"""SELECT *, source_type = target_type OR (source_type = 'string' AND target_type IN ('date', 'timestamp') AND unconvertible = 0)
       AS fits FROM ({_schema_rows()}) x""",
)
def schema_check(d):
    return checks.schema_pairs(d.source, d.target, TEXT_TO_DATE)


def _quoted(c: str) -> str:
    """``concat`` skips nulls, so the quotes must go with the value."""
    return f"CASE WHEN {c} IS NULL THEN 'null' ELSE concat('\"', {c}, '\"') END"


def _data_rows() -> str:
    parts = ", ".join(f"""'{"," if i else ""}"{c}":', {_quoted(c)}""" for i, c in enumerate(PAIR_COLUMNS))
    row = f"""concat('{{', {parts}, ',"row_hash":"', row_hash, '"}}')"""
    return f"""SELECT 'data' AS validation_type, CAST(NULL AS VARCHAR) AS column_name, 'failed' AS status,
       concat('present_only_in_source||', {row}) AS comment FROM ox_hashed_source WHERE row_hash NOT IN (SELECT row_hash FROM ox_hashed_target)
UNION ALL SELECT 'data', NULL, 'failed', concat('present_only_in_destination||', {row})
FROM ox_hashed_target WHERE row_hash NOT IN (SELECT row_hash FROM ox_hashed_source)"""


BASE = ["validation_type", "column_name", "status", "comment"]


@query("data_check", _data_rows())
def data_check(d):
    return checks.check_data(d.source, d.target, scales=SCALES).select(*BASE)


def _count_row(source: str, target: str) -> str:
    return f"""SELECT 'row_count' AS validation_type, CAST(NULL AS VARCHAR) AS column_name,
       CASE WHEN s = t THEN 'passed' ELSE 'failed' END AS status,
       concat('Source Row Count: ', s, ', Target: ', t, ', Difference: ', abs(s - t)) AS comment
FROM (SELECT (SELECT count(*) FROM {source}) AS s, (SELECT count(*) FROM {target}) AS t) x"""


@query("row_count_check", _count_row("fx_source", "fx_target"))
def row_count_check(d):
    return checks.check_row_count(d.source, d.target).select(*BASE)


def _unique_row(table: str, c: str, label: str | None = None) -> str:
    return f"""SELECT 'uniqueness' AS validation_type, '{label or c}' AS column_name,
       CASE WHEN n = 0 THEN 'passed' ELSE 'failed' END AS status,
       concat('Column: {label or c}, Status: ', CASE WHEN n = 0 THEN 'UNIQUE' ELSE 'NOT_UNIQUE' END, ', Duplicates: ', r) AS comment
FROM (SELECT count(*) AS n, CAST(coalesce(sum(k), 0) AS BIGINT) AS r
      FROM (SELECT count(*) AS k FROM {table} GROUP BY {c} HAVING count(*) > 1) y) x"""


@query(
    "uniqueness_check",
    " UNION ALL ".join(
        [
            _unique_row("fx_target", "o_orderkey"),
            _unique_row("lineitem", "l_orderkey"),
            _unique_row("lineitem", "l_orderkey, l_linenumber", "l_orderkey + l_linenumber"),
        ]
    ),
)
def uniqueness_check(d):
    single = checks.check_unique(d.target, ["o_orderkey"]).unionByName(checks.check_unique(d.lineitem, ["l_orderkey"]))
    return single.unionByName(checks.check_unique(d.lineitem, ["l_orderkey", "l_linenumber"], composite=True)).select(*BASE)


def _null_row(table: str, c: str) -> str:
    return f"""SELECT 'not_null' AS validation_type, '{c}' AS column_name, CASE WHEN n = 0 THEN 'passed' ELSE 'failed' END AS status,
       concat('Column: {c}, Result: ', CASE WHEN n = 0 THEN 'No NULLs' ELSE 'NULLs Exist' END, ', Count: ', n) AS comment
FROM (SELECT count(*) - count({c}) AS n FROM {table}) x"""


@query("not_null_check", " UNION ALL ".join([_null_row("fx_target", "o_orderkey"), _null_row("fx_target", "o_orderpriority")]))
def not_null_check(d):
    return checks.check_not_null(d.target, ["o_orderkey", "o_orderpriority"]).select(*BASE)


# Schemas of the given tables.
_ORDERS = "o_orderkey: bigint, o_custkey: bigint, o_orderstatus: string, o_totalprice: double, "
_SCHEMAS = {
    "fx_source": f"[{_ORDERS}o_orderpriority: string, o_orderday: string]",
    "fx_target": f"[{_ORDERS}o_orderpriority: string, o_orderday: date]",
    "orders": f"[{_ORDERS}o_orderdate: timestamp_ntz, o_orderpriority: string]",
    "lineitem": "[l_orderkey: bigint, l_partkey: bigint, l_suppkey: bigint, l_linenumber: int, l_quantity: double, "
    "l_extendedprice: double, l_discount: double, l_tax: double, l_returnflag: string, l_linestatus: string, "
    "l_shipdate: timestamp_ntz]",
}


def _suite() -> str:
    out = []
    for m in mappings():
        s, t = m.source_object, m.target_object
        both = f"Source Schema: {_SCHEMAS[s]} Target Schema: {_SCHEMAS[t]}"
        rows = [
            f"SELECT 'schemas' AS validation_type, CAST(NULL AS VARCHAR) AS column_name, 'passed' AS status, '{both}' AS comment",
            _count_row(s, t),
            *[_unique_row(t, c) for c in m.uniqueness_columns],
            *[_unique_row(t, ", ".join(key), " + ".join(key)) for key in m.unique_keys],
            *[_null_row(t, c) for c in m.not_null_columns],
        ]
        if m.mapping_id == "m1":
            rows.append(_data_rows())
        out.append(f"SELECT '{m.mapping_id}' AS mapping_id, {m.batch_id} AS batch_id, x.* FROM ({' UNION ALL '.join(rows)}) x")
    return " UNION ALL ".join(out)


def run_all(d):
    return suite.run_suite(
        d.spark, mappings(), lambda _, m: object_of(d, m.source_object), lambda _, m: object_of(d, m.target_object)
    )


@query("validation_suite", _suite())
def validation_suite(d):
    return run_all(d).select("mapping_id", "batch_id", *BASE)


def _load_verdicts() -> str:
    return f"""WITH all_rows AS ({_suite()})
SELECT batch_id - 1000 AS pipeline_id, batch_id, 1 AS step_id, 'ingestion' AS validation_type, 'NA' AS verdict
FROM all_rows GROUP BY batch_id
UNION ALL SELECT batch_id - 1000, batch_id, 2, 'schema', CASE WHEN count(*) FILTER (validation_type = 'schema') > 0 THEN 'Fail' ELSE 'Pass' END
FROM all_rows GROUP BY batch_id
UNION ALL SELECT batch_id - 1000, batch_id, 3, 'data', CASE WHEN count(*) FILTER (validation_type = 'data') > 0 THEN 'Fail' ELSE 'Pass' END
FROM all_rows GROUP BY batch_id
UNION ALL SELECT batch_id - 1000, batch_id, step_id, k, CASE WHEN count(*) FILTER (status = 'failed') > 0 THEN 'Fail' ELSE 'Pass' END
FROM all_rows JOIN (VALUES (4, 'row_count'), (5, 'uniqueness'), (6, 'not_null')) t(step_id, k) ON k = validation_type GROUP BY batch_id, step_id, k"""


@query("load_verdicts", _load_verdicts())
def load_verdicts(d):
    """Did these loads arrive intact? All checks of all mappings, written down and judged."""
    judged = suite.suite_verdicts(run_all(d), specs_frame(d.spark, mappings()))
    return judged.select("pipeline_id", "batch_id", "step_id", "validation_type", "verdict")


def _shared_batch() -> str:
    steps = "(VALUES (1, 'ingestion'), (2, 'schema'), (3, 'data'), (4, 'row_count'), (5, 'uniqueness'), (6, 'not_null')) t(step_id, k)"
    return f"""WITH all_rows AS ({_suite()})
SELECT m.mapping_id, CASE m.mapping_id WHEN 'm3' THEN 2 ELSE 1 END AS pipeline_id, 1001 AS batch_id, t.step_id,
       t.k AS validation_type, CASE WHEN t.step_id = 1 THEN 'NA' WHEN EXISTS (SELECT 1 FROM all_rows r
           WHERE r.mapping_id = m.mapping_id AND r.validation_type = t.k AND r.status = 'failed') THEN 'Fail' ELSE 'Pass' END AS verdict
FROM (SELECT DISTINCT mapping_id FROM all_rows) m CROSS JOIN {steps}
UNION ALL SELECT 'm4', 1, 1001, step_id, k, 'NA' FROM {steps}"""


@query("load_verdicts_shared_batch", _shared_batch())
def load_verdicts_shared_batch(d):
    """Several mappings in one batch, the same batch number in two pipelines, and a mapping that cannot be read."""
    specs = [replace(m, pipeline_id=2 if m.mapping_id == "m3" else 1, batch_id=1001) for m in mappings()]
    specs.append(replace(specs[0], mapping_id="m4", target_object="no_such_table"))

    def target(_, spec):
        if spec.mapping_id == "m4":
            return load_target(d.spark, f"{d.folder}/{spec.target_object}.parquet", "parquet")
        return object_of(d, spec.target_object)

    found = suite.run_suite(d.spark, specs, lambda _, m: object_of(d, m.source_object), target)
    judged = suite.suite_verdicts(found, specs_frame(d.spark, specs))
    return judged.select("mapping_id", "pipeline_id", "batch_id", "step_id", "validation_type", "verdict")
