"""Catalog tables over the stored layouts."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.schemas import BATCH_SESSION, RAW_EVENT, SPEED_SNAPSHOT
from tidemark.sources.files import day_path, days_from_to

RESTATEMENT_AUDIT = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("batch_session_id", T.StringType()),
    T.StructField("rt_cart_total", T.DoubleType()),
    T.StructField("batch_cart_total", T.DoubleType()),
    T.StructField("cart_total_delta", T.DoubleType()),
    T.StructField("cart_total_abs_delta", T.DoubleType()),
    T.StructField("rt_event_count", T.LongType()),
    T.StructField("batch_event_count", T.LongType()),
    T.StructField("event_count_delta", T.LongType()),
    T.StructField("rt_converted", T.BooleanType()),
    T.StructField("batch_converted", T.BooleanType()),
    T.StructField("conversion_flipped", T.BooleanType()),
    T.StructField("had_restatement", T.BooleanType()),
    T.StructField("late_arrival_count", T.LongType()),
    T.StructField("restatement_type", T.StringType()),
])

_HOURS = (("year", "INT"), ("month", "INT"), ("day", "INT"), ("hour", "INT"))
_DAYS = _HOURS[:3]

# table -> (format, columns, partition columns, folder below the root)
LAYOUTS = {
    "raw_events": ("json", RAW_EVENT, _HOURS, "events"),
    "late_arrivals": ("json", RAW_EVENT, _HOURS, "late-arrivals"),
    "batch_sessions": ("parquet", BATCH_SESSION, _DAYS, "sessions"),
    "realtime_sessions_raw": ("json", SPEED_SNAPSHOT, (("date_partition", "STRING"),), "realtime-sessions"),
    "restatement_audit": ("parquet", RESTATEMENT_AUDIT, _DAYS, "restatement-audit"),
}


# Stores that the streaming job writes: a folder per batch inside each hour.
ROUTED = ("raw_events", "late_arrivals")


def create_table(
    spark: SparkSession, name: str, root: str, database: str = "default", batches: bool = False, days: tuple[str, str] | None = None,
) -> None:
    """External table over a stored layout; its partitions are registered from
    the folders, so that a query on them lists only what it reads, or with a range of
    ``days`` by name, without any listing. ``batches`` is for stores of the streaming
    and replay jobs, whose hours hold batches."""
    fmt, columns, partitions, folder = LAYOUTS[name]
    if batches and name in ROUTED:
        partitions = (*partitions, ("batch_id", "BIGINT"))
    keys = {key for key, _ in partitions}
    declared = [f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields if f.name not in keys]
    declared += [f"`{key}` {kind}" for key, kind in partitions]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({', '.join(declared)}) USING {fmt} "
        f"PARTITIONED BY ({', '.join(key for key, _ in partitions)}) "
        f"LOCATION '{root.rstrip('/')}/{folder}'"
    )
    if days is not None:
        add_days(spark, name, root, *days, database)
        return
    refresh_partitions(spark, name, database)


def refresh_partitions(spark: SparkSession, name: str, database: str = "default") -> None:
    spark.sql(f"ALTER TABLE `{database}`.`{name}` RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE `{database}`.`{name}`")


def add_days(spark: SparkSession, name: str, root: str, first: str, last: str, database: str = "default") -> None:
    """Registers the day (or hour) partitions of a range by name: paths follow from the
    range, so the store is not listed; days without a folder read as empty."""
    _, _, partitions, folder = LAYOUTS[name]
    hours = range(24) if partitions == _HOURS else (None,)
    clauses = []
    for day in days_from_to(first, last):
        path = day_path(f"{root.rstrip('/')}/{folder}", day) if partitions != LAYOUTS["realtime_sessions_raw"][2] else f"{root.rstrip('/')}/{folder}/date_partition={day}"
        year, month, number = (int(p) for p in day.split("-"))
        for hour in hours:
            spec = f"date_partition='{day}'" if partitions == LAYOUTS["realtime_sessions_raw"][2] else f"year={year}, month={month}, day={number}"
            spec, place = (spec, path) if hour is None else (f"{spec}, hour={hour}", f"{path}/hour={hour:02d}")
            clauses.append(f"PARTITION ({spec}) LOCATION '{place}'")
    for i in range(0, len(clauses), 1000):
        spark.sql(f"ALTER TABLE `{database}`.`{name}` ADD IF NOT EXISTS {' '.join(clauses[i:i + 1000])}")
    spark.sql(f"REFRESH TABLE `{database}`.`{name}`")


def create_tables(spark: SparkSession, root: str, database: str = "default", batches: bool = False) -> None:
    for name in LAYOUTS:
        create_table(spark, name, root, database, batches)
