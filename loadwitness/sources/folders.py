"""A folder per value of some columns, made and read by tasks.

``partitionBy`` leaves every folder to the driver: it gathers their names, renames their files one after the other, and lists
them all when they are read back. Here the files of a write are staged in one hidden folder; once all tasks have ended,
tasks move them to their places, named as ``partitionBy`` names them, and an index of the files is committed. Spark reads the
folders by their path as before (hidden names are left out); ``read_folders`` goes by the index, so nothing is listed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loadwitness.scratch import file_store

INDEX, SCHEMA = "_index", "_schema"
# What Spark calls the folder of a null, and the characters that it writes as their codes.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")
# Rows that a task holds of the files that it reads, or of their index; files that it moves or opens, where there are many.
HELD_ROWS, TASK_FILES = 10_000, 500


def folder_name(key: str, value: str | None) -> str:
    if not value:
        return f"{key}={NO_VALUE}"
    return f"{key}=" + _ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", value)


def _runs(batch, n_keys: int) -> Iterator[tuple[tuple, int, int]]:
    """Neighbouring rows with the same values in the first columns: values, first row, number."""
    values = list(zip(*[batch.column(i).to_pylist() for i in range(n_keys)], strict=True))
    at = 0
    for i in range(1, len(values) + 1):
        if i == len(values) or values[i] != values[at]:
            yield values[at], at, i - at
            at = i


def _dealt(index: DataFrame) -> DataFrame:
    """Files dealt to tasks. Their number is stated, else the few bytes of an index would be put together in one task."""
    files = index.count()
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-files // TASK_FILES))
    return index.repartition(max(1, min(files, tasks)), "file")


def write_folders(df: DataFrame, path: str, keys: list[str], suffix: str, opened: Callable, mode: str = "append") -> None:
    """Rows of ``df``, whose partitions are ordered by ``keys``, in a folder per value of these.

    ``opened(stream, schema)`` gives a writer, with ``write_batch`` and ``close``, of one file's rows without the keys. A write
    whose tasks do not all end leaves nothing but hidden folders; its files count once its part of the index is committed.
    """
    files, base = file_store(path)
    if mode == "ignore" and files.get_file_info(base).type.name != "NotFound":
        return
    spark, write, n = df.sparkSession, uuid.uuid4().hex, len(keys)
    staged, listed = f"{path}/_staged-{write}", f"{path}/_listed-{write}"
    rest = [c for c in df.columns if c not in keys]
    if mode != "append":
        df.limit(0).write.mode(mode).partitionBy(*keys).parquet(path)
    df.select(*keys, *rest).limit(0).write.mode("append").parquet(f"{path}/{SCHEMA}")
    index = StructType.fromDDL("file string, folder string, rows bigint")
    for key in keys:
        index = index.add(df.schema[key])

    def stage(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        files, base = file_store(staged)
        files.create_dir(base, recursive=True)
        # A task that is tried again writes files of its own.
        part = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        kinds, made, count, now, stream, writer = to_arrow_schema(index), [], 0, None, None, None
        for batch in batches:
            held = batch.select(range(2 * n, batch.num_columns))
            for value, at, rows in _runs(batch, 2 * n):
                if writer is None or value != now:
                    if writer is not None:
                        writer.close()
                        stream.close()
                    if len(made) == HELD_ROWS:
                        yield pa.RecordBatch.from_pylist(made, schema=kinds)
                        made = []
                    name, count, now = f"{part}-{count:07d}{suffix}", count + 1, value
                    folder = "/".join(map(folder_name, keys, value[:n]))
                    made.append({"file": name, "folder": folder, "rows": 0} | dict(zip(keys, value[n:], strict=True)))
                    stream = files.open_output_stream(f"{base}/{name}", compression=None)
                    writer = opened(stream, held.schema)
                writer.write_batch(held.slice(at, rows))
                made[-1]["rows"] += rows
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pylist(made, schema=kinds)

    def move(batches):
        (files, base), (_, source) = file_store(path), file_store(staged)
        for batch in batches:
            for file, folder in zip(batch.column("file").to_pylist(), batch.column("folder").to_pylist(), strict=True):
                files.create_dir(f"{base}/{folder}", recursive=True)
                try:
                    files.move(f"{source}/{file}", f"{base}/{folder}/{file}")
                except OSError:
                    # An earlier try of this task may have moved it.
                    if files.get_file_info(f"{base}/{folder}/{file}").type.name != "File":
                        raise
            yield batch

    texts = [F.col(k).cast("string").alias(f"_text_{k}") for k in keys]
    df.select(*texts, *keys, *rest).mapInArrow(stage, index).write.parquet(listed)
    made = _dealt(spark.read.schema(index).parquet(listed))
    made.mapInArrow(move, index).write.mode("append").parquet(f"{path}/{INDEX}")
    for hidden in (staged, listed):
        files, base = file_store(hidden)
        if files.get_file_info(base).type.name == "Directory":
            files.delete_dir(base)


def read_folders(spark: SparkSession, path: str, read: Callable, columns: StructType | None = None) -> DataFrame:
    """What ``write_folders`` wrote under ``path``, keys first; tasks get the files from the index and open them.

    ``read(stream, schema)`` gives record batches of ``columns`` (unless stated, those that were written) of one file.
    """
    index = spark.read.parquet(f"{path}/{INDEX}")
    keys = [f for f in index.schema if f.name not in ("file", "folder", "rows")]
    if columns is None:
        written = spark.read.parquet(f"{path}/{SCHEMA}").schema
        columns = StructType([f for f in written if f.name not in {k.name for k in keys}])
    found = StructType([*keys, *columns])

    def run(batches):
        import pyarrow as pa

        files, base = file_store(path)
        kinds, own = to_arrow_schema(found), to_arrow_schema(columns)
        held, rows = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(f"{base}/{row['folder']}/{row['file']}") as stream:
                    for some in read(stream, own):
                        values = [pa.repeat(pa.scalar(row[k.name], kinds.field(k.name).type), some.num_rows) for k in keys]
                        held.append(pa.RecordBatch.from_arrays([*values, *some.cast(own).columns], schema=kinds))
                        rows += some.num_rows
                        if rows >= HELD_ROWS:
                            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                            held, rows = [], 0
        if rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return _dealt(index).mapInArrow(run, found)
