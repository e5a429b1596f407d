"""Where intermediate tables go, and how a plan is cut so that a lost executor does not cost the whole lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Mappings are compared by several threads; the folder is chosen once.
_CHOOSING = threading.Lock()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode, where it is unset."""
    with _CHOOSING:
        return _shared_dir(spark)


def _shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loadwitness-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there, however often it is used afterwards."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """As ``materialise``, but as a table whose size Spark knows: a small one is then broadcast instead of shuffled."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_store(path: str):
    """File system and path of a folder that executors share, a local mount or an object store."""
    from pyarrow import fs

    uri = path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:") else f"file://{path}"
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
