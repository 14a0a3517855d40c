"""Job after the stitch: compare the day's sessions with the speed snapshot.

    python -m tidemark.plans.audit --date 2024-10-15 --batch-path ... --realtime-path ... --output-path ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.reconcile import restatement_audit, restatement_breakdown, restatement_stats, session_deltas
from tidemark.session import spark_session
from tidemark.sinks.files import write_audit, write_restatement_detail, write_summary
from tidemark.sources.files import (
    day_path,
    snapshot_text,
    snapshot_typed,
    speed_from_snapshot,
    stored_links,
)


def run(
    spark: SparkSession, batch_path: str, realtime_path: str, output_path: str, day: str, flip_first: bool = False
) -> DataFrame:
    """Simple audit (beside the sessions), detail and summary are written; the breakdown
    by kind is returned.

    The summary reads the written detail, so the joins run once and a lost
    executor costs a read, not a recomputation.
    """
    links = stored_links(spark, f"{batch_path.rstrip('/')}-links", day).drop("year", "month", "day")
    text = snapshot_text(spark, f"{realtime_path.rstrip('/')}/realtime-sessions", day)
    speed = speed_from_snapshot(snapshot_typed(text))
    write_audit(restatement_audit(speed, links), batch_path, day)
    write_restatement_detail(session_deltas(links, speed, flip_first=flip_first), output_path, day)
    deltas = spark.read.parquet(day_path(output_path, day))
    write_summary(restatement_stats(deltas), output_path, day)
    return restatement_breakdown(deltas)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--date", required=True)
    parser.add_argument("--batch-path", required=True)
    parser.add_argument("--realtime-path", required=True)
    parser.add_argument("--output-path", required=True)
    parser.add_argument("--flip-first", action="store_true")
    args = parser.parse_args()
    spark = spark_session("audit")
    run(spark, args.batch_path, args.realtime_path, args.output_path, args.date, args.flip_first).show(truncate=False)


if __name__ == "__main__":
    main()
