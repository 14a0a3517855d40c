"""Streaming job: route raw lines to the stores and keep the session state.

    python -m tidemark.plans.live --input ... --root ... --checkpoints ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.events import canonical_events, timed_events
from tidemark.operators.quarantine import events_of, parse_lines
from tidemark.schemas import CANONICAL_EVENT, TRIGGER_INTERVAL
from tidemark.session import spark_session
from tidemark.sinks.files import write_snapshot
from tidemark.streaming.counters import counted
from tidemark.streaming.routing import start_routing
from tidemark.streaming.sessionizer import session_updates
from tidemark.streaming.source import file_lines
from tidemark.streaming.state_table import COMPACT_EVERY, current_state, start_upserts
from tidemark.streaming.windows import dedup_stream


def once_delivered(lines: DataFrame) -> DataFrame:
    """Lines to canonical events without repeats. Events without a session id
    stay; the session state keeps them under one placeholder id."""
    return dedup_stream(counted(timed_events(canonical_events(events_of(parse_lines(lines))))))


def start_dedup(lines: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    writer = once_delivered(lines).writeStream.format("parquet").option("path", path) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER_INTERVAL)
    return writer.start()


def start(
    spark: SparkSession, source: str, root: str, checkpoints: str,
    max_files: int | None = None, available_now: bool = False, compact_every: int = COMPACT_EVERY,
) -> list[StreamingQuery]:
    """Three queries that fail and restart on their own.

    Routing keeps every line whatever its age. Removing repeats and folding
    sessions each have a watermark of their own, so a small table lies between
    them; what falls behind those watermarks is left to the batch answer.
    """
    root, checkpoints = root.rstrip("/"), checkpoints.rstrip("/")
    routing = start_routing(
        file_lines(spark, source, max_files), root, f"{checkpoints}/routing", available_now=available_now)
    once = f"{root}/delivered-once"
    dedup = start_dedup(file_lines(spark, source, max_files), once, f"{checkpoints}/dedup", available_now)
    if available_now:
        dedup.awaitTermination()
    events = spark.readStream.schema(CANONICAL_EVENT).parquet(once)
    state = start_upserts(
        session_updates(events), f"{root}/session-state", f"{checkpoints}/state", available_now=available_now,
        compact_every=compact_every)
    return [routing, dedup, state]


def export_snapshot(spark: SparkSession, root: str, day: str | None = None) -> None:
    """Last state of the sessions that began on the day, as all-text snapshot.
    Without a day, each session goes to the day on which it began."""
    root = root.rstrip("/")
    state = current_state(spark, f"{root}/session-state")
    if day:
        state = state.filter(F.col("date_partition") == day)
    write_snapshot(state, f"{root}/realtime-sessions", day)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--root", required=True)
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--max-files", type=int)
    parser.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    parser.add_argument("--snapshot", metavar="DAY", help="export the state and leave")
    args = parser.parse_args()
    spark = spark_session("live")
    if args.snapshot:
        export_snapshot(spark, args.root, args.snapshot)
        return
    for query in start(spark, args.input, args.root, args.checkpoints, args.max_files, args.available_now):
        query.awaitTermination()


if __name__ == "__main__":
    main()
