"""Where each decoded event of a micro-batch goes.

All events go to the event store, late ones also to the late store, lines that
do not parse to quarantine with a reason. Late events never reach the session
state; the state query filters them in its own plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.events import late_events
from tidemark.operators.quarantine import events_of, parse_lines
from tidemark.schemas import TRIGGER_INTERVAL
from tidemark.sinks.files import write_events


def route_batch(root: str, fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function. Each target is written below the batch id, so
    a batch that is run again overwrites its own files and nothing else."""
    root = root.rstrip("/")

    def write(lines: DataFrame, batch_id: int) -> None:
        parsed = parse_lines(lines).persist()
        try:
            events = events_of(parsed)
            write_events(events, f"{root}/events", fmt, batch_id)
            write_events(late_events(events), f"{root}/late-arrivals", fmt, batch_id)
            parsed.filter(F.col("malformed")).select(
                "raw_line", F.lit("not_json").alias("reason"), F.lit(batch_id).alias("batch_id")
            ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("batch_id").json(f"{root}/quarantine")
        finally:
            parsed.unpersist()

    return write


def start_routing(
    lines: DataFrame, root: str, checkpoint: str, fmt: str = "json", available_now: bool = False
) -> StreamingQuery:
    counted = lines.observe("routing", F.count(F.lit(1)).alias("records"))
    writer = counted.writeStream.foreachBatch(route_batch(root, fmt)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER_INTERVAL)
    return writer.start()
