"""Summaries of both answers and the numbers of the comparison report.

Distinct sessions per day are counted in two steps (per id, then per day).
Both steps combine map-side, and no row is multiplied for a second DISTINCT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import amount, beyond, exact_part, percent, percent_or_zero, total_of
from tidemark.functions.times import duration_label, partition_date
from tidemark.schemas import BATCH_LATENCY_LABEL, SPEED_LATENCY_LABEL


def realtime_sessions_view(snapshot: DataFrame) -> DataFrame:
    """Typed rows of the text snapshot that belong to a day."""
    return snapshot.filter(F.col("date_partition").isNotNull()).select(
        "session_id",
        F.col("event_count").try_cast("bigint").alias("event_count"),
        F.col("cart_total").try_cast("double").alias("cart_total"),
        F.col("conversion_value").try_cast("double").alias("conversion_value"),
        F.col("converted").try_cast("boolean").alias("converted"),
        "session_start",
        F.col("last_event_time").alias("session_end"),
        F.col("duration_seconds").try_cast("double").alias("duration_seconds"),
        "date_partition",
    )


def batch_sessions_view(sessions: DataFrame) -> DataFrame:
    """Stored sessions with rounded money; the day is that of the partition."""
    shown = [c for c in sessions.columns if c not in ("cart_total", "conversion_value", "session_date")]
    return sessions.select(
        *shown,
        amount(F.col("cart_total")).alias("cart_total"),
        amount(F.col("conversion_value")).alias("conversion_value"),
        partition_date(F.col("year"), F.col("month"), F.col("day")).alias("session_date"),
    )


# Digits behind the point that sums of stored amounts carry.
DIGITS = 6


def _money(column: str, name: str) -> list[Column]:
    value = F.col(column)
    return [F.sum(exact_part(value, DIGITS)).alias(name), F.sum(beyond(value, DIGITS)).alias(f"{name}_beyond")]


def _money_total(name: str) -> Column:
    return total_of(F.sum(name), F.sum(f"{name}_beyond"))


def _per_session(rows: DataFrame, day: str, key: str, extra: list[Column]) -> DataFrame:
    return rows.groupBy(F.col(day).alias("date"), F.col(key).alias("id")).agg(
        F.max("converted").alias("converted"),
        *_money("cart_total", "cart"),
        *_money("conversion_value", "revenue"),
        F.sum("event_count").alias("events"),
        F.sum("duration_seconds").alias("duration"),
        F.count("duration_seconds").alias("durations"),
        *extra,
    )


def _totals(prefix: str) -> list[Column]:
    return [
        F.count("id").alias(f"{prefix}total_sessions"),
        _money_total("cart").alias(f"{prefix}total_cart_value"),
        _money_total("revenue").alias(f"{prefix}total_revenue"),
        F.sum("events").alias(f"{prefix}total_events"),
        F.count_if(F.col("converted") & F.col("id").isNotNull()).alias(f"{prefix}converted_sessions"),
        (F.sum("duration").cast("double") / F.nullif(F.sum("durations"), F.lit(0)))
        .alias(f"{prefix}avg_duration_seconds"),
    ]


def speed_summary(speed: DataFrame) -> DataFrame:
    """One row per day of the speed answer."""
    return _per_session(speed, "date_partition", "session_id", []).groupBy("date").agg(*_totals("rt_"))


def batch_summary(batch: DataFrame) -> DataFrame:
    """One row per day of the batch answer, with restated and late totals."""
    extra = [
        F.count_if("had_restatement").alias("restated"),
        F.sum("late_arrival_count").alias("late"),
    ]
    return _per_session(batch, "session_date", "batch_session_id", extra).groupBy("date").agg(
        *_totals("batch_"),
        F.sum("restated").alias("sessions_restated"),
        F.sum("late").alias("total_late_arrivals"),
    )


def accuracy_comparison(speed: DataFrame, batch: DataFrame) -> DataFrame:
    """Both answers per day, newest first: counts, revenue error, conversion,
    durations, restated share."""
    left = speed_summary(speed)
    right = batch_summary(batch).withColumn("date", F.col("date").cast("string"))
    revenue_change = F.col("batch_total_revenue") - F.col("rt_total_revenue")
    return (
        left.join(right, "date", "outer")
        .select(
            "date",
            "rt_total_sessions",
            "batch_total_sessions",
            (F.col("batch_total_sessions") - F.col("rt_total_sessions")).alias("session_count_delta"),
            F.round("rt_total_revenue", 2).alias("rt_revenue"),
            F.round("batch_total_revenue", 2).alias("batch_revenue"),
            F.round(revenue_change, 2).alias("revenue_delta"),
            F.round(percent(F.abs(revenue_change), F.col("batch_total_revenue")), 2).alias("revenue_error_pct"),
            F.round(percent(F.col("rt_converted_sessions"), F.col("rt_total_sessions")), 2)
            .alias("rt_conversion_rate_pct"),
            F.round(percent(F.col("batch_converted_sessions"), F.col("batch_total_sessions")), 2)
            .alias("batch_conversion_rate_pct"),
            F.round("rt_avg_duration_seconds", 0).alias("rt_avg_duration_seconds"),
            F.round("batch_avg_duration_seconds", 0).alias("batch_avg_duration_seconds"),
            "sessions_restated",
            F.round(percent(F.col("sessions_restated"), F.col("batch_total_sessions")), 2)
            .alias("pct_sessions_restated"),
            "total_late_arrivals",
            F.lit(SPEED_LATENCY_LABEL).alias("speed_layer_latency"),
            F.lit(BATCH_LATENCY_LABEL).alias("batch_layer_latency"),
        )
        .orderBy(F.desc("date"))
    )


def _layer_totals(per_session: DataFrame) -> DataFrame:
    return per_session.agg(*_totals("")).withColumnRenamed(
        "avg_duration_seconds", "avg_session_duration_seconds"
    )


def speed_totals(speed: DataFrame, date: str) -> DataFrame:
    """Totals of one day of the speed answer."""
    day = speed.filter(F.col("date_partition") == date)
    return _layer_totals(_per_session(day, "date_partition", "session_id", []))


def batch_totals(batch: DataFrame, date: str) -> DataFrame:
    """Totals of one day of the batch answer. On stored sessions the predicate
    is on the integer partition columns, so that only that day is read."""
    if {"year", "month", "day"} <= set(batch.columns):
        year, month, day = (int(part) for part in date.split("-"))
        rows = batch.filter((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))
    else:
        rows = batch.filter(F.col("session_date") == F.lit(date).cast("date"))
    return _layer_totals(_per_session(rows.withColumn("of_day", F.lit(date)), "of_day", "batch_session_id", []))


METRICS = (
    "total_sessions", "total_cart_value", "total_revenue", "total_events",
    "converted_sessions", "avg_session_duration_seconds",
)


def metric_comparison(speed_totals_row: DataFrame, batch_totals_row: DataFrame) -> DataFrame:
    """``metric, speed_layer, batch_layer``, one row per metric."""
    def long_form(row: DataFrame, name: str) -> DataFrame:
        doubles = row.select(*[F.col(m).cast("double").alias(m) for m in METRICS])
        return doubles.unpivot([], list(METRICS), "metric", name)

    return long_form(speed_totals_row, "speed_layer").join(
        long_form(batch_totals_row, "batch_layer"), "metric", "outer"
    )


def report_metrics(speed_row: DataFrame, batch_row: DataFrame, stats_row: DataFrame) -> DataFrame:
    """The derived numbers of the report as one row; a zero base gives 0."""
    left = speed_row.select(*[F.col(m).alias(f"rt_{m}") for m in METRICS])
    right = batch_row.select(*[F.col(m).alias(f"batch_{m}") for m in METRICS])
    one = left.withColumn("k", F.lit(1)).join(right.withColumn("k", F.lit(1)), "k").join(
        stats_row.withColumn("k", F.lit(1)), "k"
    )
    restated = percent_or_zero(F.col("sessions_restated"), F.col("total_sessions_compared"))
    error = percent_or_zero(
        F.abs(F.col("batch_total_revenue") - F.col("rt_total_revenue")), F.col("batch_total_revenue")
    )

    def rounded(value: Column) -> Column:
        return F.round(value, 2)

    return one.select(
        rounded(percent_or_zero(F.col("rt_converted_sessions"), F.col("rt_total_sessions")))
        .alias("rt_conversion_rate_pct"),
        rounded(percent_or_zero(F.col("batch_converted_sessions"), F.col("batch_total_sessions")))
        .alias("batch_conversion_rate_pct"),
        duration_label(F.coalesce("rt_avg_session_duration_seconds", F.lit(0.0))).alias("rt_duration_label"),
        duration_label(F.coalesce("batch_avg_session_duration_seconds", F.lit(0.0))).alias("batch_duration_label"),
        rounded(restated).alias("restatement_pct"),
        rounded(F.lit(100.0) - restated).alias("accuracy_pct"),
        rounded(error).alias("revenue_error_pct"),
        F.concat(F.lit("$"), F.format_number(F.coalesce("rt_total_revenue", F.lit(0.0)), 2)).alias("rt_revenue_label"),
        F.concat(F.lit("$"), F.format_number(F.coalesce("batch_total_revenue", F.lit(0.0)), 2))
        .alias("batch_revenue_label"),
    )
