"""All checks of all mappings, in one table."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwitness.operators.checks import RESULT_COLUMNS, check_keys, check_sides
from loadwitness.operators.status import KEYWORDS
from loadwitness.plans.verdict import verdicts
from loadwitness.scratch import fresh_path, shared_dir
from loadwitness.sources.objects import load_source, load_target
from loadwitness.sources.specs import MappingSpec

Loader = Callable[[SparkSession, MappingSpec], DataFrame]

RESULT_SCHEMA = """
  mapping_id string, pipeline_id bigint, batch_id bigint, seq bigint, validation_type string, column_name string,
  status string, metrics map<string,bigint>, comment string
"""

# One row per mapping that a named suite has finished; the driver reads as many as it was given declarations.
MANIFEST_SCHEMA = "name string, path string"

# What tells the results of one load from those of another: several mappings may share a pipeline and batch.
LOAD = ["mapping_id", "pipeline_id", "batch_id"]


def _source(spark: SparkSession, spec: MappingSpec) -> DataFrame:
    return load_source(spark, spec.source_object, spec.source_format, spec.source_schema, spec.source_options)


def _target(spark: SparkSession, spec: MappingSpec) -> DataFrame:
    return load_target(spark, spec.target_object, spec.target_format)


def union_results(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def check_mapping(source: DataFrame, target: DataFrame, spec: MappingSpec) -> DataFrame:
    """The rows of all checks for one mapping. Uniqueness reads the target once more, its key columns only."""
    not_null = spec.not_null_columns or ()
    frames = [
        check_sides(source, target, spec.compatible_types, spec.columns, spec.multiset, spec.scales, not_null)
    ]
    keys = [[c] for c in spec.uniqueness_columns or ()] + [list(key) for key in spec.unique_keys or ()]
    if keys:
        frames.append(check_keys(target, keys))
    return union_results(frames)


def _failed(spark: SparkSession, error: Exception) -> DataFrame:
    said = str(getattr(error, "java_exception", None) or error).splitlines() or [type(error).__name__]
    row = [("suite", None, "error", {}, said[0])]
    return spark.createDataFrame(
        row, "validation_type string, column_name string, status string, metrics map<string,bigint>, comment string"
    )


def _declared(specs: Sequence[MappingSpec]) -> list[str]:
    """A name for each mapping that depends on its declaration; equal declarations are numbered."""
    seen: Counter[str] = Counter()
    names = []
    for spec in specs:
        text = json.dumps(asdict(spec), sort_keys=True, default=list)
        digest = hashlib.sha256(text.encode()).hexdigest()[:32]
        seen[digest] += 1
        names.append(f"{digest}-{seen[digest]}")
    return names


def _finished(spark: SparkSession, folder: str) -> dict[str, str]:
    """Names of the mappings that an earlier start of the suite finished, each with the folder of its rows."""
    manifest = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True)
    try:
        return {r.name: r.path for r in manifest.parquet(f"{folder}/finished").collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def run_suite(
    spark: SparkSession,
    specs: Sequence[MappingSpec],
    source_of: Loader = _source,
    target_of: Loader = _target,
    parallel: int = 4,
    run: str | None = None,
) -> DataFrame:
    """The result table: ``mapping_id, pipeline_id, batch_id, seq`` with the result columns, for all mappings.

    Each mapping is checked and written by itself, ``parallel`` at a time, so a plan is as large as one mapping's. A
    mapping that cannot be read or compared, be it found out only while its rows are read, gives one row of status
    ``error`` in place of all others; the other mappings go on. ``seq`` tells the rows of a mapping apart.

    A suite with a name (``run``) may be started again under it, in the same shared folder, after its driver was lost:
    mappings that it had finished, by the same declaration, are not checked again. A mapping that gave an error is.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/suite-{run}" if run else fresh_path(spark, "suite")
    finished = _finished(spark, folder) if run else {}

    def write(rows: DataFrame, spec: MappingSpec, path: str) -> str:
        rows.select(
            F.lit(spec.mapping_id).alias("mapping_id"),
            F.lit(spec.pipeline_id).cast("bigint").alias("pipeline_id"),
            F.lit(spec.batch_id).cast("bigint").alias("batch_id"),
            F.monotonically_increasing_id().alias("seq"),
            *RESULT_COLUMNS,
        ).write.parquet(path)
        return path

    def results_of(keyed: tuple[str, MappingSpec]) -> str:
        key, spec = keyed
        if key in finished:
            return finished[key]
        attempt = f"{key}-{uuid.uuid4().hex}"
        try:
            rows = check_mapping(source_of(spark, spec), target_of(spark, spec), spec)
            path = write(rows, spec, f"{folder}/mapping-{attempt}")
        except (PySparkException, Py4JJavaError, ValueError) as error:
            return write(_failed(spark, error), spec, f"{folder}/error-{attempt}")
        if run:
            done = spark.createDataFrame([(key, path)], MANIFEST_SCHEMA)
            done.coalesce(1).write.mode("append").parquet(f"{folder}/finished/{attempt}")
        return path

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        written = list(pool.map(results_of, zip(_declared(specs), specs)))
    if not written:
        return spark.createDataFrame([], RESULT_SCHEMA)
    return spark.read.schema(RESULT_SCHEMA).parquet(*written)


def suite_verdicts(results: DataFrame, specs: DataFrame, rules: str = "r3") -> DataFrame:
    """Verdicts of each mapping from a suite's results: ``mapping_id`` and the columns of ``verdicts``.

    A step counts as executed if the mapping declares it and no error kept it from being checked: a mapping with an error
    row has no Pass at all. The suite does not run the ingestion, so its step is not judged.
    """
    errors = results.where(F.col("status") == "error").select(*LOAD).distinct().withColumn("broken", F.lit(True))
    declared = {
        "uniqueness": (F.size("uniqueness_columns") > 0) | (F.size("unique_keys") > 0),
        "not_null": F.size("not_null_columns") > 0,
        "ingestion": F.lit(False),
    }
    done = {k: F.when(declared.get(k, F.lit(True)) & F.col("broken").isNull(), F.lit("Success")) for k in KEYWORDS}
    state = specs.join(errors, LOAD, "left")
    runs = state.select(
        *LOAD,
        F.when(F.col("broken").isNull(), "SUCCESS").otherwise("FAILED").alias("status"),
        F.lit("NA").alias("ingestion_status"),
    )
    return verdicts(results, state.withColumns(done).select(*LOAD, *KEYWORDS), runs, rules, keys=LOAD)
