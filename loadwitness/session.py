"""Session settings the plans were written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Skewed sort-merge joins are split at run time even when that costs one more shuffle; session time is UTC so that
# instants render alike everywhere; call sites are not traced, as that doubles the time to build a plan of many Columns.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = 8, app: str = "loadwitness", **settings: str) -> SparkSession:
    """A ``local[cores]`` session for tests and the benchmark; on a cluster pass SETTINGS to spark-submit."""
    settings = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="loadwitness-"), **settings}
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
