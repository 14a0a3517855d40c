"""Built-in streaming operators: duplicates within the watermark and closed
gap sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import as_double, price_if
from tidemark.schemas import LATE_DELAY_MAX_SECONDS, LATE_THRESHOLD_SECONDS, SESSION_TIMEOUT_SECONDS


def dedup_stream(events: DataFrame, delay_seconds: int = LATE_DELAY_MAX_SECONDS) -> DataFrame:
    """One row per event id. Copies further apart than the delay pass and are
    removed by the batch operator, which has the last word."""
    return events.withWatermark("arrival_time", f"{delay_seconds} seconds").dropDuplicatesWithinWatermark(["event_id"])


def closed_window_sessions(
    events: DataFrame,
    timeout: int = SESSION_TIMEOUT_SECONDS,
    delay_seconds: int = LATE_THRESHOLD_SECONDS,
) -> DataFrame:
    """Gap sessions per user that the watermark has closed (``append`` mode)."""
    cart = as_double(F.sum(price_if("event_type = 'cart'")))
    return (
        events.withWatermark("effective_time", f"{delay_seconds} seconds")
        .groupBy("user_id", F.session_window("effective_time", f"{timeout} seconds").alias("span"))
        .agg(F.count(F.lit(1)).alias("event_count"), cart.alias("cart_total"),
             F.max(F.col("event_type") == "purchase").alias("converted"))
        .select("user_id", F.col("span.start").alias("session_start"), F.col("span.end").alias("window_end"),
                "event_count", "cart_total", "converted")
    )
