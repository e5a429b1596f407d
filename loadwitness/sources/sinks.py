"""Writers of results, discrepancies and reports."""

from __future__ import annotations

import csv
import io
import time
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import islice
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loadwitness.operators.skew import by_shuffle
from loadwitness.sources.folders import HELD_ROWS, read_folders, write_folders

# What one load is told from another by, as far as results have the columns.
LOAD_COLUMNS = ("mapping_id", "pipeline_id", "batch_id")

EXPORT_KEYS = ["pipeline_id", "batch_id"]
EXPORT_SCHEMA = "pipeline_id bigint, batch_id bigint, discrepancy_type string, data_content string"
EXPORT_COLUMNS = ["discrepancy_type", "data_content"]
EXPORT_CSV = {"header": True, "escape": '"'}


def _spread(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Neighbouring folders together, so that there are at most as many files as folders and tasks; the hash splits a
    folder that holds much of the data."""
    return df.repartitionByRange(*keys, F.xxhash64(*by)).sortWithinPartitions(*keys)


def _by_batch(df: DataFrame) -> DataFrame:
    ranged = df.repartitionByRange("batch_id", F.xxhash64("validation_type", "comment"))
    return ranged.sortWithinPartitions("batch_id", "validation_type")


def save_results(df: DataFrame, target: str, mode: str = "append") -> None:
    """Validation results, to a path (with a slash) or a table, in ranges of batches.

    Files hold neighbouring batches in order, so a filter on ``batch_id`` skips the others by their statistics, and
    there is no folder per batch. The second range key splits a batch that holds much of the data.
    """
    writer = _by_batch(df).write.mode(mode)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def replace_results(
    df: DataFrame, path: str, by: Sequence[str] | None = None, loads: DataFrame | None = None
) -> None:
    """Validation results under ``path``, in place of those saved there before for the same loads.

    A load is what ``by`` tells apart (of ``LOAD_COLUMNS`` those that ``df`` has), null being a value like others. ``loads``
    names loads that are replaced even if ``df`` has no row of them. Rows go into a folder of this save, then one row per
    load into the manifest. A save takes effect as a whole when its part of the manifest is committed: one that is lost
    before is as if it had not been, and no earlier file is touched. Read with ``load_results``.
    """
    spark, keys = df.sparkSession, list(by or [c for c in LOAD_COLUMNS if c in df.columns])
    if not keys or not set(keys) <= set(df.columns):
        raise ValueError(f"results need columns that tell loads apart, such as {LOAD_COLUMNS}")
    # Saves are ordered by their names.
    save = f"save=s{time.time_ns():020d}-{uuid.uuid4().hex}"
    _by_batch(df).write.parquet(f"{path}/results/{save}")
    saved = spark.read.schema(df.schema).parquet(f"{path}/results/{save}").select(*keys)
    if loads is not None:
        saved = saved.union(loads.select(*[F.col(c).cast(df.schema[c].dataType) for c in keys]))
    saved.distinct().write.parquet(f"{path}/saves/{save}")


def load_results(spark: SparkSession, path: str) -> DataFrame:
    """Of every load the rows of its last save by ``replace_results``."""
    saves = spark.read.parquet(f"{path}/saves")
    keys = [c for c in saves.columns if c != "save"]
    last = saves.groupBy(*[F.col(c).alias(f"_{c}") for c in keys]).agg(F.max("save").alias("_save"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys] + [F.col("save") == F.col("_save")]
    return spark.read.parquet(f"{path}/results").join(by_shuffle(last), reduce(and_, same), "left_semi").drop("save")


def export_discrepancies(discrepancies: DataFrame, path: str, mode: str = "append") -> None:
    """Raw discrepancies as CSV, a folder per pipeline and batch (``export_discrepancy_ranges``: fewer files).

    ``discrepancies`` has ``pipeline_id, batch_id, seq, side, payload``; rows of unknown side are not written. Read whole exports
    with ``load_discrepancy_folders``.
    """
    line = F.to_csv(F.struct(*EXPORT_COLUMNS), {"escape": EXPORT_CSV["escape"]}).alias("line")
    write_folders(_discrepancy_rows(discrepancies).select(*EXPORT_KEYS, line), path, EXPORT_KEYS, ".csv", _Lines, mode)


def load_discrepancy_folders(spark: SparkSession, path: str) -> DataFrame:
    """``pipeline_id, batch_id, discrepancy_type, data_content`` of all that ``export_discrepancies`` wrote."""
    columns = StructType([StructField(c, StringType()) for c in EXPORT_COLUMNS])
    return read_folders(spark, path, _read_lines, columns)


class _Lines:
    """Lines of one CSV file, after its header."""

    def __init__(self, stream, schema):
        self.stream = stream
        stream.write((",".join(EXPORT_COLUMNS) + "\n").encode())

    def write_batch(self, batch) -> None:
        self.stream.write("".join([f"{line}\n" for line in batch.column(0).to_pylist()]).encode())

    def close(self) -> None:
        pass


def _read_lines(stream, schema) -> Iterator:
    import pyarrow as pa

    rows = csv.reader(io.TextIOWrapper(stream, "utf-8", newline=""))
    next(rows)
    while some := list(islice(rows, HELD_ROWS)):
        # An empty value is null, as when Spark reads the file.
        yield pa.RecordBatch.from_pylist([{c: v or None for c, v in zip(EXPORT_COLUMNS, row, strict=True)} for row in some], schema=schema)


def _discrepancy_rows(discrepancies: DataFrame) -> DataFrame:
    rows = discrepancies.filter(F.col("side") != "other").select(
        *EXPORT_KEYS, "seq", F.col("side").alias("discrepancy_type"), F.col("payload").alias("data_content")
    )
    return _spread(rows, EXPORT_KEYS, ["seq"]).drop("seq")


def export_discrepancy_ranges(discrepancies: DataFrame, path: str) -> None:
    """Raw discrepancies as CSV in ranges of pipelines and batches, added to earlier exports under ``path``.

    There are as many files as tasks however many batches there are, and an index: which file holds how many rows of
    which pipeline and batch. An export takes effect as a whole when its index is committed; the files of one that is lost
    before are not read. Takes what ``export_discrepancies`` takes; read with ``load_discrepancies``.
    """
    spark, files = discrepancies.sparkSession, f"{path}/files/{uuid.uuid4().hex}"
    _discrepancy_rows(discrepancies).write.options(**EXPORT_CSV).csv(files)
    written = _read_export(spark, [files]).select(*EXPORT_KEYS, F.col("_metadata.file_path").alias("file"))
    index = written.groupBy(*EXPORT_KEYS, "file").agg(F.count("*").alias("rows"))
    ordered = index.repartitionByRange(*EXPORT_KEYS, "file").sortWithinPartitions(*EXPORT_KEYS, "file")
    ordered.write.mode("append").parquet(f"{path}/index")


def load_discrepancies(
    spark: SparkSession, path: str, pipeline_id: int | None = None, batch_id: int | None = None
) -> DataFrame:
    """``pipeline_id, batch_id, discrepancy_type, data_content`` of what ``export_discrepancy_ranges`` wrote: everything, or
    one pipeline's, one batch's. Files without such rows are not opened; the driver gets the names of the others."""
    asked = [F.col(k) == v for k, v in zip(EXPORT_KEYS, (pipeline_id, batch_id), strict=True) if v is not None]
    wanted = reduce(and_, asked, F.lit(True))
    files = [r.file for r in spark.read.parquet(f"{path}/index").where(wanted).select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], EXPORT_SCHEMA)
    return _read_export(spark, sorted(files)).where(wanted)


def _read_export(spark: SparkSession, files: list[str]) -> DataFrame:
    # Payloads may hold line breaks; a file is one task's when written and when read.
    return spark.read.schema(EXPORT_SCHEMA).options(**EXPORT_CSV, multiLine=True).csv(files)


def save_report(df: DataFrame, path: str, mode: str = "append") -> None:
    """Report rows, a folder per dataflow batch. Read whole reports with ``load_reports``."""
    spread = _spread(df, ["dataflow_batch_id"], ["pipeline_id", "batch_id"])
    write_folders(spread, path, ["dataflow_batch_id"], ".parquet", _parquet_writer, mode)


def load_reports(spark: SparkSession, path: str) -> DataFrame:
    """All rows that ``save_report`` wrote."""
    return read_folders(spark, path, _read_parquet)


def _parquet_writer(stream, schema):
    import pyarrow.parquet as pq

    return pq.ParquetWriter(stream, schema)


def _read_parquet(stream, schema) -> Iterator:
    import pyarrow.parquet as pq

    return pq.ParquetFile(stream).iter_batches(HELD_ROWS)
