"""Scans of the stored layouts. All schemas are given; nothing is inferred
except the partition columns of the folder names."""

from __future__ import annotations

from datetime import date as Date
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.events import canonical_events
from tidemark.schemas import (
    BATCH_SESSION,
    RAW_EVENT,
    SESSION_LINK,
    SHOP_CSV,
    SPEED_SNAPSHOT,
)

CORRUPT = "_corrupt_record"


def day_path(base: str, day: str) -> str:
    """Folder of one day, as the sinks write it."""
    d = Date.fromisoformat(day)
    return f"{base.rstrip('/')}/year={d.year}/month={d.month:02d}/day={d.day:02d}"


def days_glob(base: str, days: list[str]) -> str:
    """One path pattern that lists the folders of these days and no others.
    Months and days match with and without a leading zero."""
    parts = []
    for day in days:
        d = Date.fromisoformat(day)
        month = f"{{{d.month},{d.month:02d}}}" if d.month < 10 else str(d.month)
        number = f"{{{d.day},{d.day:02d}}}" if d.day < 10 else str(d.day)
        parts.append(f"year={d.year}/month={month}/day={number}")
    return f"{base.rstrip('/')}/{{{','.join(parts)}}}"


def days_from_to(first: str, last: str) -> list[str]:
    begin, end = Date.fromisoformat(first), Date.fromisoformat(last)
    return [(begin + timedelta(days=i)).isoformat() for i in range((end - begin).days + 1)]


def events_between(spark: SparkSession, base: str, first: str, last: str) -> DataFrame:
    """NDJSON events of a range of days whose paths follow from the range: each day's
    folder is asked for by name, none is looked for; missing days are empty."""
    system = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    there = [p for p in (day_path(base, d) for d in days_from_to(first, last)) if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p))]
    if not there:
        return spark.createDataFrame([], T.StructType([*RAW_EVENT.fields, *[T.StructField(k, T.IntegerType()) for k in ("year", "month", "day", "hour")]]))
    return readable(json_lines(spark, base, there, RAW_EVENT))


def days_around(day: str, before_hours: int, after_hours: int) -> list[str]:
    """The day itself plus the days its look-back and look-ahead reach into."""
    d = Date.fromisoformat(day)
    first = d - timedelta(days=-(-before_hours // 24))
    last = d + timedelta(days=-(-after_hours // 24))
    return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def json_lines(spark: SparkSession, base: str, path: str | list[str], schema: T.StructType) -> DataFrame:
    """NDJSON with fixed fields, plus the partition columns of the folders.

    Lines that are no JSON keep their text in ``_corrupt_record``. The lines
    are parsed by an expression, not by the JSON reader: the reader refuses
    queries that need nothing but the corrupt column, such as a count.
    """
    parsed = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    text = spark.read.option("basePath", base).text(path)
    keys = [c for c in text.columns if c != "value"]
    event = F.from_json("value", parsed, {"columnNameOfCorruptRecord": CORRUPT})
    # the fields leave a generator, below which no filter is pushed: one parse per line
    return text.filter(F.length("value") > 0).select(F.inline(F.array(event)), *keys)


def readable(df: DataFrame) -> DataFrame:
    """Rows that parsed, without the corrupt-record column. A field of the
    wrong type is null and does not remove its row."""
    keys = {"year", "month", "day", "hour", "date_partition", "batch_id", CORRUPT}
    read = [F.col(c).cast("string") for c in df.columns if c not in keys]
    return df.filter(F.col(CORRUPT).isNull() | F.coalesce(*read).isNotNull()).drop(CORRUPT)


def raw_events(spark: SparkSession, base: str, days: list[str] | None = None) -> DataFrame:
    """NDJSON events of the given days, all hours, late ones included."""
    return json_lines(spark, base, base if days is None else days_glob(base, days), RAW_EVENT)


def raw_events_parquet(spark: SparkSession, base: str, days: list[str] | None = None) -> DataFrame:
    reader = spark.read.schema(RAW_EVENT).option("basePath", base)
    return reader.parquet(base if days is None else days_glob(base, days))


def stored_sessions(spark: SparkSession, base: str, day: str | None = None) -> DataFrame:
    reader = spark.read.schema(BATCH_SESSION).option("basePath", base)
    return reader.parquet(base if day is None else days_glob(base, [day]))


def stored_links(spark: SparkSession, base: str, day: str | None = None) -> DataFrame:
    reader = spark.read.schema(SESSION_LINK).option("basePath", base)
    return reader.parquet(base if day is None else days_glob(base, [day]))


def snapshot_text(spark: SparkSession, base: str, day: str | None = None) -> DataFrame:
    """Speed snapshot as stored: every column text, one folder per day."""
    fields = T.StructType([f for f in SPEED_SNAPSHOT.fields if f.name != "date_partition"])
    path = base if day is None else f"{base.rstrip('/')}/date_partition={day}"
    return readable(json_lines(spark, base, path, fields)).withColumn(
        "date_partition", F.col("date_partition").cast("string")
    )


def snapshot_typed(text: DataFrame) -> DataFrame:
    """Numbers and flags of the snapshot under ``rt_`` names; text that is no
    number becomes null."""
    return text.select(
        "session_id",
        "session_start",
        "last_event_time",
        "date_partition",
        F.col("event_count").try_cast("bigint").alias("rt_event_count"),
        F.col("cart_total").try_cast("double").alias("rt_cart_total"),
        F.col("conversion_value").try_cast("double").alias("rt_conversion_value"),
        F.col("converted").try_cast("boolean").alias("rt_converted"),
        F.col("duration_seconds").try_cast("bigint").alias("rt_duration_seconds"),
    )


def speed_from_snapshot(typed: DataFrame) -> DataFrame:
    """Typed snapshot under the names of the speed operators."""
    return typed.select(
        "session_id",
        F.col("rt_cart_total").alias("cart_total"),
        F.col("rt_conversion_value").alias("conversion_value"),
        F.col("rt_event_count").alias("event_count"),
        F.col("rt_converted").alias("converted"),
        F.col("rt_duration_seconds").alias("duration_seconds"),
        "session_start",
        "last_event_time",
        "date_partition",
    )


def shop_csv(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """Shop log CSV as canonical events; with ``first``, the earliest N."""
    rows = canonical_events(spark.read.schema(SHOP_CSV).option("header", True).csv(path))
    if first is None:
        return rows
    return rows.orderBy("effective_time", "event_id").limit(first)


def merged_parquet(spark: SparkSession, base: str) -> DataFrame:
    """Files of older and newer layouts as one table with all columns."""
    return spark.read.option("mergeSchema", "true").parquet(base)
