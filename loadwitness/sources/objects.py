"""The objects that are compared: source files and target tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loadwitness.sources.quoted import read_split, splits

CORRUPT = "_corrupt_record"


# CSV as RFC 4180 has it: quotes inside quotes are doubled, quoted values may hold line breaks. An empty value is null unless
# it is quoted; the mark for null is one that no text holds.
CSV_OPTIONS = {"header": "true", "mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": "true", "nullValue": "\u0000"}


def load_source(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A source file. CSV has a header (``CSV_OPTIONS``, which ``options`` override); without a schema all its columns
    are text.

    With a schema, lines that do not fit it are kept whole in ``_corrupt_record``. Files are read in parallel, also where
    quoted values hold line breaks (``sources.quoted``), unless options change quotes, line ends or encoding.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if fmt != "csv":
        reader = spark.read.format(fmt).options(**(options or {}))
        return (reader if schema is None else reader.schema(schema)).load(path)
    options = {**CSV_OPTIONS, **(options or {})}
    reader = spark.read.options(**options)
    if schema is None:
        plain = reader.option("inferSchema", False).csv(path)
        return read_split(spark, path, plain.schema, options) if splits(options) else plain
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options["columnNameOfCorruptRecord"] = CORRUPT
    if splits(options):
        return read_split(spark, path, with_corrupt, options)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).schema(with_corrupt).csv(path)


def load_target(spark: SparkSession, name: str, fmt: str | None = None) -> DataFrame:
    """A target table: by its catalog name, or with a format (``iceberg``, ``parquet``) by name or path."""
    return spark.table(name) if fmt is None else spark.read.format(fmt).load(name)
