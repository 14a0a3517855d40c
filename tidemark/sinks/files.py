"""Writers. A day is replaced as a whole; running a job twice leaves one copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import RAW_EVENT
from tidemark.sources.files import day_path

# Upper bound per file; AQE sizes the partitions below it.
MAX_RECORDS_PER_FILE = 2_000_000


def sized(df: DataFrame) -> DataFrame:
    """Even partitions of the advisory size: small ones merged and large ones
    split by AQE, without counting the rows first."""
    return df.hint("rebalance")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (
        sized(df).write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .parquet(path)
    )


def write_sessions(sessions: DataFrame, base: str, day: str) -> None:
    write_parquet(sessions, day_path(base, day))


def write_links(links: DataFrame, base: str, day: str) -> None:
    write_parquet(links, day_path(base, day))


def write_audit(audit: DataFrame, base: str, day: str) -> None:
    write_parquet(audit, day_path(f"{base.rstrip('/')}-audit", day))


def write_restatement_detail(deltas: DataFrame, base: str, day: str) -> None:
    write_parquet(deltas, day_path(base, day))


def write_summary(stats: DataFrame, base: str, day: str) -> None:
    """The one summary row as one JSON file."""
    stats.coalesce(1).write.mode("overwrite").json(day_path(f"{base.rstrip('/')}-summary", day))


def write_metric_csv(metrics: DataFrame, path: str) -> None:
    """The few metric rows as one CSV file with a header."""
    metrics.select("metric", "speed_layer", "batch_layer").coalesce(1).sortWithinPartitions("metric") \
        .write.mode("overwrite").option("header", True).csv(path)


def padded_hours(at: Column) -> dict[str, Column]:
    """Hour partition columns with the leading zeros of the folder names."""
    return {
        "year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM"),
        "day": F.date_format(at, "dd"), "hour": F.date_format(at, "HH"),
    }


HOUR_KEYS = ("year", "month", "day", "hour")


def raw_text(events: DataFrame, more: list[Column] | None = None) -> DataFrame:
    """Events in the stored 13-column form, times as ISO text in UTC."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    kinds = dict(events.dtypes)
    return events.select(*[
        F.date_format(f.name, iso).alias(f.name) if kinds[f.name].startswith("timestamp")
        else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in RAW_EVENT.fields
    ], *(more or []))


def columnar_text(events: DataFrame, more: list[Column] | None = None) -> DataFrame:
    """The stored form with every required member filled: empty text for a
    missing id or time, 0 for a missing price, false for a missing flag."""
    required = ("event_id", "arrival_time", "event_type", "product_id", "user_id", "session_id")
    return raw_text(events, more).withColumns({
        **{name: F.coalesce(name, F.lit("")) for name in required},
        "price": F.coalesce(F.nanvl("price", F.lit(0.0)), F.lit(0.0)),
        "is_late_arrival": F.coalesce("is_late_arrival", F.lit(False)),
    })


def write_events(
    events: DataFrame, base: str, fmt: str = "json", batch_id: int | Column | None = None, resize: bool = False
) -> None:
    """Events into hour folders by arrival time.

    With ``batch_id`` (a number, or a column of ``events`` for several batches)
    the rows go to a folder of that batch inside each hour, and a retried batch
    replaces exactly what its first attempt wrote.

    Every task writes its own rows, so nothing is shuffled and a busy hour is
    written by all tasks that read it. ``resize`` adds a shuffle that evens
    out file sizes, for bulk loads from many small inputs.
    """
    batch = [] if batch_id is None else [F.lit(batch_id).alias("batch_id")]
    rows = columnar_text(events, batch) if fmt == "parquet" else raw_text(events, batch)
    rows = rows.withColumns(padded_hours(F.try_to_timestamp("arrival_time")))
    keys = [*HOUR_KEYS, *(["batch_id"] if batch else [])]
    if resize:
        rows = rows.hint("rebalance", *HOUR_KEYS)
    writer = rows.write.partitionBy(*keys).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic") if batch_id is not None \
        else writer.mode("append")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.format(fmt).save(base)


def write_snapshot(state: DataFrame, base: str, day: str | None = None) -> None:
    """Speed sessions as all-text NDJSON, one folder per day.

    With ``day`` every row goes to that day (the day of the export); without,
    each row goes to its own ``date_partition``.
    """
    text = state.select(
        "session_id", "user_id",
        *[F.col(c).cast("string").alias(c) for c in (
            "event_count", "cart_total", "conversion_value", "converted", "duration_seconds",
        )],
        *[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(c) for c in ("session_start", "last_event_time")],
        (F.lit(day) if day else F.col("date_partition")).alias("date_partition"),
    )
    sized(text).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("date_partition").json(base)


