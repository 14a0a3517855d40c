"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of an Arrow batch where each holds a text or a set.
LONG_ROWS = 1000
#: A word is a run of anything but the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z; every other letter stays as it is."""
    return F.translate(column, UPPER, LOWER)


def stored(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    What is read is a plain file scan: its lineage is cut, lost executors cost
    one task, and AQE can split its hot keys. ``batch_rows`` bounds the Arrow
    batches of this one write, for rows that hold whole texts or sets; the session's
    own setting is back before the call returns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_BATCH)
    try:
        if batch_rows:
            spark.conf.set(_BATCH, str(batch_rows))
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def in_slices(function: Callable, rows: int = LONG_ROWS) -> Callable:
    """``function`` over Arrow batches of at most ``rows`` rows each: texts are long,
    and what a task derives from one batch has to stay small. The session's own
    batch size is left alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return function(b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows))

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
