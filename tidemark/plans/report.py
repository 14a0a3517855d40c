"""Comparison of both answers for one day, as rows and as a CSV.

    python -m tidemark.plans.report --date 2024-10-15 --batch-path ... --realtime-path ... --audit-path ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import report
from tidemark.operators.reconcile import restatement_stats
from tidemark.session import spark_session
from tidemark.sinks.files import write_metric_csv
from tidemark.sources.files import day_path, snapshot_text, snapshot_typed, speed_from_snapshot, stored_sessions


def layers(spark: SparkSession, batch_path: str, realtime_path: str, day: str) -> tuple[DataFrame, DataFrame]:
    text = snapshot_text(spark, f"{realtime_path.rstrip('/')}/realtime-sessions", day)
    return speed_from_snapshot(snapshot_typed(text)), stored_sessions(spark, batch_path, day)


def run(
    spark: SparkSession, batch_path: str, realtime_path: str, audit_path: str, day: str, output: str | None = None
) -> DataFrame:
    """The report numbers as one row; with ``output``, the metric CSV as well."""
    speed, batch = layers(spark, batch_path, realtime_path, day)
    fast, whole = report.speed_totals(speed, day), report.batch_totals(batch, day)
    if output:
        write_metric_csv(report.metric_comparison(fast, whole), output)
    deltas = spark.read.parquet(day_path(audit_path, day))
    return report.report_metrics(fast, whole, restatement_stats(deltas))


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--date", required=True)
    parser.add_argument("--batch-path", required=True)
    parser.add_argument("--realtime-path", required=True)
    parser.add_argument("--audit-path", required=True)
    parser.add_argument("--output")
    args = parser.parse_args()
    spark = spark_session("report")
    run(spark, args.batch_path, args.realtime_path, args.audit_path, args.date, args.output) \
        .show(truncate=False, vertical=True)


if __name__ == "__main__":
    main()
