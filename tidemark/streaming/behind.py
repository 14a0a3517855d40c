"""Rows behind the watermark, kept in a table of their own.

Spark's watermark drops rows that come too late and leaves a counter. Here each
micro-batch is split by a watermark that is stored with it: the largest time of the
batches before, less the delay. Newer rows go to ``in-time``, older ones to ``behind``,
each below the batch's number, and the batch's own largest time to ``marks``. A batch
that is run again sees the same marks before it and replaces exactly what it wrote, so every
row is in one of the two tables once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import plus_seconds
from tidemark.schemas import LATE_THRESHOLD_SECONDS, TRIGGER_INTERVAL


def _put(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def split_batch(root: str, delay_seconds: int = LATE_THRESHOLD_SECONDS, time: str = "effective_time") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for :func:`start_split`. Rows without a time are in time."""
    root = root.rstrip("/")

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        marks = spark.read.schema("mark timestamp, batch_id int").parquet(f"{root}/marks") if batch_id else spark.createDataFrame([], "mark timestamp, batch_id int")
        before = marks.where(F.col("batch_id") < batch_id).agg(F.max("mark").alias("mark"))
        mark = before.select(plus_seconds(F.col("mark"), F.lit(-delay_seconds)).alias("mark")).first()["mark"]
        late = F.coalesce(F.col(time) < F.lit(mark).cast("timestamp"), F.lit(False)) if mark else F.lit(False)
        _put(rows.where(late), f"{root}/behind", batch_id)
        _put(rows.where(~late), f"{root}/in-time", batch_id)
        _put(rows.agg(F.max(time).alias("mark")), f"{root}/marks", batch_id)

    return write


def start_split(
    events: DataFrame, root: str, checkpoint: str, delay_seconds: int = LATE_THRESHOLD_SECONDS, available_now: bool = False,
) -> StreamingQuery:
    writer = events.writeStream.foreachBatch(split_batch(root, delay_seconds)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER_INTERVAL)
    return writer.start()
