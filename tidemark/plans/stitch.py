"""Nightly job: raw events of a day to batch sessions and their links.

    python -m tidemark.plans.stitch --date 2024-10-15 --raw-path ... --output-path ...
"""

from __future__ import annotations

import argparse
from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.events import canonical_events, dedup_events, timed_events, valid_events
from tidemark.operators.stitch import id_chunks_of, links_of, sessions_of, stitched_ids
from tidemark.plans import nightly
from tidemark.schemas import SESSION_TIMEOUT_SECONDS
from tidemark.session import scratch_path, spark_session
from tidemark.sinks.files import write_links, write_parquet, write_sessions
from tidemark.sources.files import days_around, raw_events, readable


def events_near(spark: SparkSession, raw_path: str, day: str, before_hours: int, after_hours: int) -> DataFrame:
    """Events of the day and of the hours next to it. The day folders are
    listed by name; the hours are a filter on partition columns."""
    rows = readable(raw_events(spark, raw_path, days_around(day, before_hours, after_hours)))
    hour = F.make_timestamp("year", "month", "day", "hour", F.lit(0), F.lit(0))
    midnight = F.lit(day).cast("date").cast("timestamp")
    return rows.filter(
        (hour >= midnight - F.make_dt_interval(hours=F.lit(before_hours)))
        & (hour < midnight + F.make_dt_interval(hours=F.lit(24 + after_hours)))
    )


def stored_days(spark: SparkSession, base: str) -> list[Date]:
    """Days that have a folder below ``base``, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/year=*/month=*/day=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    parts = [[int(p.split("=")[1]) for p in status.getPath().toString().split("/")[-3:]] for status in found]
    return sorted({Date(*p) for p in parts})


def clean_events(rows: DataFrame) -> DataFrame:
    return dedup_events(timed_events(valid_events(canonical_events(rows))))


def stored_rows(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_day(events: DataFrame, output_path: str, day: str, timeout: int) -> None:
    """Write the sessions of ``events`` that start on ``day``."""
    rows = stored_rows(stitched_ids(events, timeout), "stitched")
    stitched = rows.filter(F.col("session_date") == F.lit(day).cast("date"))
    write_sessions(sessions_of(stitched), output_path, day)
    write_links(links_of(stitched), f"{output_path.rstrip('/')}-links", day)
    write_links(id_chunks_of(stitched), f"{output_path.rstrip('/')}-ids", day)


def run(
    spark: SparkSession,
    raw_path: str,
    output_path: str,
    day: str,
    timeout: int = SESSION_TIMEOUT_SECONDS,
    before_hours: int | None = None,
    after_hours: int | None = None,
) -> None:
    """Take in what arrived on ``day`` and in the first two hours behind it, and write
    every output day that changes (:mod:`tidemark.plans.nightly`): an event that arrives
    late joins the session it belongs to, however old that is. With hours given, just
    those are read around the day and no other day is touched; with both at 0 the day
    is cut out of time as it stands.
    """
    if before_hours is not None or after_hours is not None:
        near = events_near(spark, raw_path, day, 1 if before_hours is None else before_hours, 2 if after_hours is None else after_hours)
        write_day(clean_events(near), output_path, day, timeout)
        return
    nightly.run(spark, raw_path, output_path, [day], timeout, after_hours=2)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--date", required=True)
    parser.add_argument("--raw-path", required=True)
    parser.add_argument("--output-path", required=True)
    parser.add_argument("--before-hours", type=int)
    parser.add_argument("--after-hours", type=int)
    args = parser.parse_args()
    spark = spark_session("stitch")
    run(spark, args.raw_path, args.output_path, args.date,
        before_hours=args.before_hours, after_hours=args.after_hours)


if __name__ == "__main__":
    main()
