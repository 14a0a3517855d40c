"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Times without an offset are UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.parquet.compression.codec": "snappy",
}


def shuffle_partitions(input_bytes: int, cores: int, target_mb: int = 128) -> int:
    """Shuffle count for an input of ``input_bytes``; AQE merges what is too small."""
    return max(cores, math.ceil(input_bytes / (target_mb * 1024 * 1024)))


def spark_session(app: str, **extra: str) -> SparkSession:
    """Session with :data:`SETTINGS`; master and sizes come from the submit command."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. A temporary
    folder of this machine is used only where that is unset and Spark is local.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`scratch_dir`; nothing is created yet."""
    return os.path.join(scratch_dir(spark), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: a plain scan, which
    is computed once, survives lost executors and lets AQE split hot join keys."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
