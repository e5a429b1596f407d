"""Sources, sinks and the mapping declaration."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadwitness.functions import scalars as S
from loadwitness.operators import checks
from loadwitness.operators.results import discrepancies
from loadwitness.operators.skew import counted_join
from loadwitness.plans.report import report_step
from loadwitness.plans.suite import union_results
from loadwitness.registry import query
from loadwitness.registry.inputs import mappings, objects_of, wide_status
from loadwitness.scratch import fresh_path, written
from loadwitness.sources import metadata, objects, sinks, specs


@query("jdbc_scan", "SELECT event_id, user_id, event_type, ts FROM events")
def jdbc_scan(d):
    """Parquet stands in for the database; the JDBC options have tests of their own."""
    return metadata.load_meta(d.spark, "events", d.folder).select("event_id", "user_id", "event_type", "ts")


@query(
    "csv_source_scan",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority,
       o_orderday, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, CASE o_orderkey % 5 WHEN 0 THEN 'say "hi", now'
       WHEN 1 THEN concat('two', chr(10), 'lines') WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'plain' END AS note FROM fx_source""",
)
def csv_source_scan(d):
    """Values with quotes, commas and line breaks, empty ones and nulls."""
    path = fresh_path(d.spark, "csv_source")
    kind = F.col("o_orderkey") % 5
    note = F.when(kind == 0, 'say "hi", now').when(kind == 1, "two\nlines").when(kind == 2, "").when(kind == 4, "plain")
    d.source.withColumn("note", note).write.option("header", True).option("escape", '"').csv(path)
    return objects.load_source(d.spark, path).withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


@query("target_table_scan", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem")
def target_table_scan(d):
    found = objects.load_target(d.spark, f"{d.folder}/lineitem.parquet", "parquet")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")


@query(
    "mapping_spec",
    """SELECT 'm1' AS mapping_id, 'o_orderkey' AS uniqueness_columns, 'o_orderkey,o_orderpriority' AS not_null_columns,
       'string->date,timestamp' AS compatible_types, (SELECT count(*) FROM fx_source) AS source_rows,
       (SELECT count(*) FROM fx_target) AS target_rows
UNION ALL SELECT 'm2', 'o_orderkey,o_custkey', 'o_orderkey,o_custkey,o_orderstatus', 'string->date,timestamp',
       (SELECT count(*) FROM orders), (SELECT count(*) FROM orders)
UNION ALL SELECT 'm3', 'l_orderkey,l_linenumber', 'l_partkey,l_suppkey', '',
       (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem)""",
)
def mapping_spec(d):
    """The declaration, next to what a validator driven by it finds."""
    declared = mappings()
    frame = specs.specs_frame(d.spark, declared)
    counted = union_results(
        [
            checks.row_count(*objects_of(d, m)).select(F.lit(m.mapping_id).alias("mapping_id"), "source_rows", "target_rows")
            for m in declared
        ]
    )
    compat = F.transform(
        F.map_entries("compatible_types"), lambda e: F.concat(e["key"], F.lit("->"), F.array_join(e["value"], ","))
    )
    return frame.join(counted, "mapping_id").select(
        "mapping_id",
        F.array_join("uniqueness_columns", ",").alias("uniqueness_columns"),
        F.array_join("not_null_columns", ",").alias("not_null_columns"),
        F.array_join(compat, ";").alias("compatible_types"),
        "source_rows",
        "target_rows",
    )


@query("validation_result_sink", "SELECT batch_id, seq, validation_type, comment FROM fx_validation_result")
def validation_result_sink(d):
    path = fresh_path(d.spark, "validation_result")
    sinks.save_results(d.validation_result, path)
    return d.spark.read.parquet(path).select("batch_id", "seq", "validation_type", "comment")


@query("validation_result_replaced", "SELECT batch_id, seq, validation_type, comment FROM fx_validation_result")
def validation_result_replaced(d):
    """Saved three times: whole, an altered half, whole again."""
    path = fresh_path(d.spark, "validation_replaced")
    sinks.replace_results(d.validation_result, path)
    half = d.validation_result.where(F.col("batch_id") % 2 == 0).withColumn("comment", F.lit("superseded"))
    sinks.replace_results(half, path)
    sinks.replace_results(d.validation_result, path)
    return sinks.load_results(d.spark, path).select("batch_id", "seq", "validation_type", "comment")


EXPORTED = """SELECT r.pipeline_id, x.batch_id, x.side AS discrepancy_type, x.payload AS data_content
FROM ox_data x JOIN fx_run r USING (batch_id) WHERE x.side <> 'other'"""


def _of_pipelines(d):
    return counted_join(discrepancies(d.validation_result), d.run.select("batch_id", "pipeline_id"), ["batch_id"], ["seq"])


@query("discrepancy_csv_sink", EXPORTED)
def discrepancy_csv_sink(d):
    path = fresh_path(d.spark, "discrepancies")
    found = _of_pipelines(d)
    sinks.export_discrepancies(found, path)
    # The files are read by Python tasks, once: what they hold is stored.
    read = written(sinks.load_discrepancy_folders(d.spark, path), "discrepancies-read")
    return read.withColumn("data_content", F.coalesce("data_content", F.lit("")))


@query("discrepancy_csv_ranges", EXPORTED)
def discrepancy_csv_ranges(d):
    path = fresh_path(d.spark, "discrepancy_ranges")
    found = _of_pipelines(d)
    sinks.export_discrepancy_ranges(found, path)
    return sinks.load_discrepancies(d.spark, path).withColumn("data_content", F.coalesce("data_content", F.lit("")))


@query(
    "report_sink",
    """SELECT r.dataflow_batch_id, v.pipeline_id, v.batch_id, v.step_id, v.execution_status, v.verdict
FROM ox_verdict_r3 v JOIN fx_run r USING (pipeline_id, batch_id)""",
)
def report_sink(d):
    path = fresh_path(d.spark, "report")
    sinks.save_report(report_step(d.run, d.validation_result, wide_status(d)), path)
    return written(sinks.load_reports(d.spark, path), "report-read").select(
        "dataflow_batch_id", "pipeline_id", "batch_id", "step_id", "execution_status", "verdict"
    )


@query(
    "report_name",
    """SELECT pipeline_id, batch_id, concat('Data_Validation_Report_',
       regexp_replace(replace(pipeline_name, ' ', '_'), '[\\\\/:*?"<>|]', '', 'g'), '_Batch_', batch_id) AS report FROM fx_run""",
)
def report_name(d):
    return d.run.select("pipeline_id", "batch_id", S.report_name(F.col("pipeline_name"), F.col("batch_id")).alias("report"))
