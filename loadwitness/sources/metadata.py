"""Run metadata, from a database over JDBC, a folder of parquet files or the catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    source: str,
    *,
    user: str,
    password: str,
    driver: str = "org.postgresql.Driver",
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a table or a query. With a partition column the read is split over ``partitions`` tasks.

    Spark refuses ``query`` together with a partition column, so a query then goes in as a derived table.
    """
    is_query = " " in source.strip()
    options = {"url": url, "user": user, "password": password, "driver": driver, "fetchsize": str(fetch_size)}
    if partition_column is None:
        return {**options, ("query" if is_query else "dbtable"): source}
    if lower is None or upper is None or partitions is None:
        raise ValueError("a partition column needs lower, upper and partitions")
    return {
        **options,
        "dbtable": f"({source}) AS part" if is_query else source,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def load_meta(spark: SparkSession, name: str, source: Mapping[str, str] | str | None = None) -> DataFrame:
    """Metadata table ``name``: by JDBC options, from ``<folder>/<name>.parquet``, or from the catalog."""
    if source is None:
        return spark.table(name)
    if isinstance(source, str):
        return spark.read.parquet(f"{source.rstrip('/')}/{name}.parquet")
    options = dict(source)
    if "query" not in options:
        options.setdefault("dbtable", name)
    return spark.read.format("jdbc").options(**options).load()
