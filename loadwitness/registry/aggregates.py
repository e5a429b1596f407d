"""Aggregations, windows, orders and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadwitness.operators import checks, compare, lookups, results, status
from loadwitness.plans import report, suite
from loadwitness.registry import query
from loadwitness.registry.inputs import SCALES, mappings, objects_of, wide_status
from loadwitness.registry.joins import spread

BY = ["data_movement_id"]


def execution(d):
    return status.node_execution(d.node_status, d.object, d.node_type)


@query("status_counts", "SELECT data_movement_id, status, count(*) AS n FROM ox_execution WHERE status IS NOT NULL GROUP BY 1, 2")
def status_counts(d):
    return status.status_counts(execution(d), BY)


@query(
    "status_summary",
    """SELECT data_movement_id, string_agg(concat(status, ': ', n), ' | ' ORDER BY n DESC, status) AS status_summary
FROM (SELECT data_movement_id, status, count(*) AS n FROM ox_execution WHERE status IS NOT NULL GROUP BY 1, 2) x GROUP BY 1""",
)
def status_summary(d):
    return status.status_summary(execution(d), BY)


@query("total_records", "SELECT data_movement_id, count(*) AS total_records FROM ox_execution GROUP BY 1")
def total_records(d):
    return status.total_records(execution(d), BY)


@query("variable_pivot", "SELECT pipeline_id, source_obj_name, target_obj_name FROM ox_names")
def variable_pivot(d):
    return lookups.object_names(d.workspace_pipeline)


@query("step_status_rollup", "SELECT pipeline_id, batch_id, validation_type, step_status FROM ox_step_status")
def step_status_rollup(d):
    return status.step_status_rows(wide_status(d))


_COUNTS = """SELECT batch_id, count(*) FILTER (side = 'present_only_in_source') AS source_only,
       count(*) FILTER (side = 'present_only_in_destination') AS target_only{total} FROM ox_data GROUP BY batch_id"""


@query("discrepancy_counts", _COUNTS.replace("{total}", ""))
def discrepancy_counts(d):
    return results.discrepancy_counts(results.discrepancies(d.validation_result)).drop("total")


@query("discrepancy_total", _COUNTS.replace("{total}", ", count(*) AS total"))
def discrepancy_total(d):
    return results.discrepancy_counts(results.discrepancies(d.validation_result))


@query(
    "any_match_verdict",
    """SELECT f.batch_id, f.n_not_unique > 0 AS not_unique, f.n_nulls > 0 AS nulls_exist, o.n_not_unique > 0 AS not_unique_r1,
       o.n_nulls > 0 AS nulls_exist_r1 FROM ox_facts_r3 f JOIN ox_facts_r1 o USING (batch_id)""",
)
def any_match_verdict(d):
    facts = results.step_facts(d.validation_result)
    return facts.select(
        "batch_id",
        F.col("not_unique_r3").alias("not_unique"),
        F.col("nulls_exist_r3").alias("nulls_exist"),
        "not_unique_r1",
        "nulls_exist_r1",
    )


@query(
    "pick_schemas_comment",
    "SELECT batch_id, arg_max(comment, seq) AS comment FROM fx_validation_result WHERE validation_type = 'schemas' GROUP BY 1",
)
def pick_schemas_comment(d):
    return results.last_schemas_comment(d.validation_result)


@query(
    "pick_row_count_comment",
    "SELECT batch_id, arg_min(comment, seq) AS comment FROM fx_validation_result WHERE validation_type = 'row_count' GROUP BY 1",
)
def pick_row_count_comment(d):
    return results.first_row_count_comment(d.validation_result)


@query(
    "row_count",
    """SELECT s AS source_rows, t AS target_rows, abs(s - t) AS difference
FROM (SELECT (SELECT count(*) FROM fx_source) AS s, (SELECT count(*) FROM fx_target) AS t) x""",
)
def row_count(d):
    return compare.row_count(d.source, d.target)


@query("duplicate_groups", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_groups(d):
    return checks.duplicate_groups(d.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "null_counts",
    """SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS nulls, count(*) AS total_rows FROM fx_target
UNION ALL SELECT 'o_orderpriority', count(*) - count(o_orderpriority), count(*) FROM fx_target""",
)
def null_counts(d):
    return checks.null_counts(d.target, ["o_orderkey", "o_orderpriority"])


@query(
    "batch_rollup",
    """SELECT r.dataflow_batch_id, r.seq, v.pipeline_id, v.step_id, v.verdict,
       v.step_id = 6 AND r.seq < max(r.seq) OVER (PARTITION BY r.dataflow_batch_id) AS break_after
FROM ox_verdict_r3 v JOIN fx_run r USING (pipeline_id, batch_id)""",
)
def batch_rollup(d):
    rows = report.batch_report(d.run, d.validation_result, wide_status(d))
    return rows.select("dataflow_batch_id", "seq", "pipeline_id", "step_id", "verdict", "break_after")


@query("latest_flow_status", "SELECT data_movement_id, batch_id, status_code_id FROM ox_latest")
def latest_flow_status(d):
    return status.latest_status(d.flow_status)


@query(
    "discrepancy_preview",
    """SELECT batch_id, seq, CASE WHEN total <= 10 THEN line_no END AS line_no, total, total <= 10 AS inline, side, text FROM (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY seq) AS line_no, count(*) OVER (PARTITION BY batch_id) AS total
  FROM ox_data) x""",
)
def discrepancy_preview(d):
    found = results.readable(results.preview(results.discrepancies(d.validation_result)))
    return found.select("batch_id", "seq", F.col("line_no").cast("bigint").alias("line_no"), "total", "inline", "side", "text")


@query("order_by_type", "SELECT validation_type, seq, batch_id, comment FROM fx_validation_result ORDER BY validation_type, seq")
def order_by_type(d):
    return results.order_by_type(d.validation_result).select("validation_type", "seq", "batch_id", "comment")


@query("order_by_start", "SELECT node_id, batch_id, status, start_time FROM ox_execution ORDER BY start_time NULLS LAST, node_id")
def order_by_start(d):
    return status.order_by_start(execution(d)).select("node_id", "batch_id", "status", "start_time")


@query(
    "first_row",
    """SELECT batch_id, job_schedule_id, status_code_id, valid_from_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY valid_from_ts, job_schedule_id) AS rn FROM fx_init_flow) x WHERE rn = 1""",
)
def first_row(d):
    columns = ["job_schedule_id", "status_code_id", "valid_from_ts"]
    return lookups.first_row(d.init_flow, ["batch_id"], ["valid_from_ts", "job_schedule_id"], columns)


@query(
    "step_order",
    """SELECT r.dataflow_batch_id, r.seq, v.step_id, v.validation_type FROM ox_verdict_r3 v JOIN fx_run r USING (pipeline_id, batch_id)
ORDER BY 1, 2, 3""",
)
def step_order(d):
    kinds = report.report_step(d.run, d.validation_result, wide_status(d)).withColumn(
        "validation_type", F.element_at(F.array(*[F.lit(t) for t in report.STEP_TYPES.values()]), F.col("step_id"))
    )
    return report.step_order(kinds).select("dataflow_batch_id", "seq", "step_id", "validation_type")


_PAIR = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderday"


@query(
    "symmetric_difference",
    f"""SELECT 'present_only_in_source' AS side, row_hash, copies, {_PAIR} FROM ox_hashed_source
WHERE row_hash NOT IN (SELECT row_hash FROM ox_hashed_target)
UNION ALL SELECT 'present_only_in_destination', row_hash, copies, {_PAIR} FROM ox_hashed_target
WHERE row_hash NOT IN (SELECT row_hash FROM ox_hashed_source)""",
)
def symmetric_difference(d):
    return spread(compare.compare(d.source, d.target, scales=SCALES))


@query(
    "symmetric_difference_multiset",
    f"""SELECT CASE WHEN coalesce(s.copies, 0) > coalesce(t.copies, 0) THEN 'present_only_in_source' ELSE 'present_only_in_destination'
       END AS side, row_hash, abs(coalesce(s.copies, 0) - coalesce(t.copies, 0)) AS copies,
       {", ".join(f"coalesce(s.{c}, t.{c}) AS {c}" for c in _PAIR.split(", "))}
FROM ox_hashed_source s FULL JOIN ox_hashed_target t USING (row_hash) WHERE coalesce(s.copies, 0) <> coalesce(t.copies, 0)""",
)
def symmetric_difference_multiset(d):
    return spread(compare.compare(d.source, d.target, multiset=True, scales=SCALES))


@query(
    "union_results",
    """SELECT 'm1' AS mapping_id, 'row_count' AS validation_type, concat('Source Row Count: ', s, ', Target: ', t, ', Difference: ',
       abs(s - t)) AS comment FROM (SELECT (SELECT count(*) FROM fx_source) AS s, (SELECT count(*) FROM fx_target) AS t) x
UNION ALL SELECT 'm2', 'row_count', concat('Source Row Count: ', n, ', Target: ', n, ', Difference: 0') FROM (SELECT count(*) AS n FROM orders) x
UNION ALL SELECT 'm3', 'row_count', concat('Source Row Count: ', n, ', Target: ', n, ', Difference: 0') FROM (SELECT count(*) AS n FROM lineitem) x""",
)
def union_results(d):
    return suite.union_results(
        [
            checks.check_row_count(*objects_of(d, m)).select(F.lit(m.mapping_id).alias("mapping_id"), "validation_type", "comment")
            for m in mappings()
        ]
    )


@query(
    "symmetric_difference_third",
    """WITH t AS (SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS o_custkey, o_orderpriority FROM orders),
s AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM orders)
SELECT 'present_only_in_source' AS side, count(*) AS copies, o_orderkey, o_custkey, o_orderpriority FROM s
WHERE o_orderkey % 3 = 0 GROUP BY ALL
UNION ALL SELECT 'present_only_in_destination', count(*), o_orderkey, o_custkey, o_orderpriority FROM t
WHERE o_orderkey % 3 = 0 GROUP BY ALL""",
)
def symmetric_difference_third(d):
    """A load in which every third row differs."""
    source = d.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    moved = F.col("o_custkey") + F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(0)
    rows = compare.compare(source, source.withColumn("o_custkey", moved))
    return rows.select(
        "side",
        "copies",
        F.col("data.o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("data.o_custkey").cast("bigint").alias("o_custkey"),
        F.col("data.o_orderpriority").alias("o_orderpriority"),
    )
