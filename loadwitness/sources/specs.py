"""What is validated: one row per source and target pair."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

SPEC_SCHEMA = """
  mapping_id string, pipeline_id bigint, batch_id bigint, source_object string, target_object string,
  source_format string, target_format string, uniqueness_columns array<string>, not_null_columns array<string>,
  compatible_types map<string,array<string>>, scales map<string,int>,
  unique_keys array<array<string>>, columns array<string>, multiset boolean, source_schema string,
  source_options map<string,string>,
  ingestion_name string, compute_engine string, workflow_engine string, workspace string,
  credential string, connection string, is_first_ingestion boolean
"""


@dataclass(frozen=True)
class MappingSpec:
    """Source, target and what is asked of the target.

    ``uniqueness_columns`` are unique each, ``unique_keys`` are composite keys. Rows are compared by ``columns`` (all that
    both sides have), by their numbers of copies too with ``multiset``. ``source_schema`` is DDL. The fields after
    ``source_options`` are carried, not used.
    """

    mapping_id: str
    pipeline_id: int
    batch_id: int
    source_object: str
    target_object: str
    source_format: str = "csv"
    target_format: str | None = None
    uniqueness_columns: Sequence[str] = ()
    not_null_columns: Sequence[str] = ()
    compatible_types: dict[str, Sequence[str]] = field(default_factory=dict)
    scales: dict[str, int] = field(default_factory=dict)
    unique_keys: Sequence[Sequence[str]] = ()
    columns: Sequence[str] | None = None
    multiset: bool = False
    source_schema: str | None = None
    source_options: dict[str, str] = field(default_factory=dict)
    ingestion_name: str | None = None
    compute_engine: str | None = None
    workflow_engine: str | None = None
    workspace: str | None = None
    credential: str | None = None
    connection: str | None = None
    is_first_ingestion: bool | None = None


def specs_frame(spark: SparkSession, specs: Sequence[MappingSpec]) -> DataFrame:
    """The declaration as a table."""
    rows = []
    for spec in specs:
        row = asdict(spec)
        row["uniqueness_columns"] = list(spec.uniqueness_columns)
        row["not_null_columns"] = list(spec.not_null_columns)
        row["unique_keys"] = [list(key) for key in spec.unique_keys]
        row["columns"] = None if spec.columns is None else list(spec.columns)
        row["compatible_types"] = {s: list(t) for s, t in spec.compatible_types.items()}
        rows.append(row)
    return spark.createDataFrame(rows, SPEC_SCHEMA)
