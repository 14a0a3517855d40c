"""Rates, lags and alarms per time window of the arrival clock.

Every result has at most one row per window, so the shuffles carry partial
aggregates only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import percent
from tidemark.functions.times import seconds_between
from tidemark.operators.events import is_late
from tidemark.schemas import (
    ERROR_ALARM_MINUTES,
    ERROR_ALARM_PCT,
    LAG_ALARM_MINUTES,
    LAG_ALARM_MS,
    THROUGHPUT_WINDOW_SECONDS,
)


def late_rate_by_hour(events: DataFrame) -> DataFrame:
    """Events, late events and late share per hour of day, in order."""
    late = F.sum(is_late().cast("int"))
    return (
        events.groupBy(F.hour("arrival_time").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            late.alias("late_count"),
            F.round(late * 100.0 / F.count(F.lit(1)), 2).alias("late_pct"),
        )
        .orderBy("hour")
    )


def throughput_by_window(records: DataFrame, seconds: int = THROUGHPUT_WINDOW_SECONDS) -> DataFrame:
    """Sent, failed and late records per window and the rate per second.

    ``records`` has ``arrival_time``, ``is_late_arrival`` and ``malformed``.
    """
    malformed = F.coalesce(F.col("malformed"), F.lit(False))
    return records.groupBy(F.window("arrival_time", f"{seconds} seconds").alias("w")).agg(
        F.count_if(~malformed).alias("sent"),
        F.count_if(malformed).alias("failed"),
        F.count_if(is_late() & ~malformed).alias("late"),
        F.round(F.count_if(~malformed) / F.lit(float(seconds)), 2).alias("per_second"),
    ).select(F.col("w.start").alias("window_start"), "sent", "failed", "late", "per_second")


def lag_by_minute(events: DataFrame) -> DataFrame:
    """Arrival minus event time per arrival minute, in milliseconds.

    Percentiles are exact: lags are whole seconds, so the frequencies that
    Spark combines for them are few however many events a minute has.
    """
    lag = seconds_between(F.col("arrival_time"), F.col("effective_time"))
    rows = events.select(F.date_trunc("minute", "arrival_time").alias("minute"), (lag * 1000).alias("lag_ms"))
    return rows.groupBy("minute").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.max("lag_ms").alias("max_lag_ms"),
        F.avg("lag_ms").alias("avg_lag_ms"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY lag_ms)").alias("p50_lag_ms"),
        F.expr("percentile_disc(0.99) WITHIN GROUP (ORDER BY lag_ms)").alias("p99_lag_ms"),
    )


def consecutive_breaches(minutes: DataFrame, breach: Column, needed: int) -> DataFrame:
    """Adds ``alarm``: true where the minute and the ``needed - 1`` minutes
    before it all breach. A missing minute does not breach.

    Each breaching minute votes for itself and the minutes after it; a minute
    with all votes is in alarm. Votes are grouped by minute like any other
    key, so the minutes never pass through one global window.
    """
    votes = (
        minutes.filter(breach)
        .select(F.explode(F.sequence(F.lit(0), F.lit(needed - 1))).alias("ahead"), "minute")
        .select(F.timestamp_seconds(F.unix_seconds("minute") + F.col("ahead") * 60).alias("minute"))
        .groupBy("minute")
        .agg((F.count(F.lit(1)) == needed).alias("voted"))
    )
    return minutes.join(votes, "minute", "left").withColumn(
        "alarm", F.coalesce("voted", F.lit(False))
    ).drop("voted")


def lag_alarm(lags: DataFrame, limit_ms: int = LAG_ALARM_MS, minutes: int = LAG_ALARM_MINUTES) -> DataFrame:
    rows = lags.select("minute", "max_lag_ms")
    return consecutive_breaches(rows, F.col("max_lag_ms") > limit_ms, minutes)


def error_rate_alarm(
    records: DataFrame, limit_pct: float = ERROR_ALARM_PCT, minutes: int = ERROR_ALARM_MINUTES
) -> DataFrame:
    """Share of malformed records per arrival minute, with the alarm."""
    malformed = F.coalesce(F.col("malformed"), F.lit(False))
    rates = records.groupBy(F.date_trunc("minute", "arrival_time").alias("minute")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(malformed).alias("errors"),
        F.round(percent(F.count_if(malformed), F.count(F.lit(1))), 2).alias("error_pct"),
    )
    return consecutive_breaches(rates, percent(F.col("errors"), F.col("records")) > limit_pct, minutes)
