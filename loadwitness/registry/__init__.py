"""One query per operator over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loadwitness.registry import oracle_views  # noqa: F401
from loadwitness.registry.views import SPARK_VIEWS, TABLES, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Schemas of files read before, so that their footers are read once.
SCHEMAS: dict[str, StructType] = {}


class Data:
    """Tables and derived inputs of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            path = f"{self.folder}/{name}.parquet"
            known = SCHEMAS.get(path)
            self._read[name] = (self.spark.read.schema(known) if known else self.spark.read).parquet(path)
            SCHEMAS[path] = self._read[name].schema
            self._read[name].createOrReplaceTempView(name)
        return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        view = f"fx_{name}"
        if view not in SPARK_VIEWS:
            raise AttributeError(name)
        if view not in self._read:
            sql = with_views(f"SELECT * FROM {view}", SPARK_VIEWS)
            for table in TABLES:
                if re.search(rf"\bFROM {table}\b", sql):
                    self.table(table)
            self._read[view] = self.spark.sql(sql)
        return self._read[view]


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``build(data) -> DataFrame`` under ``name``; ``sql`` may use every view of ``registry.views``."""

    def add(build: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Data(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return add


from loadwitness.registry import aggregates, checks, joins, predicates, reports, scans, texts, verdicts  # noqa: E402, F401
