"""The speed answer, replayed in batch: state per source session id from
on-time events only, cut at gaps above the timeout (to the microsecond).

As in :mod:`tidemark.operators.stitch`, cells are aggregated before the
per-session window, so a session id shared by a third of all events costs one
row per cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.money import amount, as_double, as_double_sql, price_if
from tidemark.functions.times import micros_between, plus_seconds, time_cell
from tidemark.operators import scan
from tidemark.operators.events import on_time_events, unknown_session_filled
from tidemark.operators.stitch import combined_measures, event_measures
from tidemark.schemas import EVENT_TYPES, SESSION_TIMEOUT_SECONDS, STATE_TTL_SECONDS


# State beyond the session measures; all of it combines by max().
_STATE = {
    "conversion_time": "max(CASE WHEN event_type = 'purchase' THEN effective_time END)",
    **{f"seen_{kind}": f"max(event_type = '{kind}')" for kind in sorted(EVENT_TYPES)},
}


def session_users(events: DataFrame) -> DataFrame:
    """The user of each session id (of several, the one sorted last)."""
    pairs = unknown_session_filled(on_time_events(events)).select("session_id", "user_id").distinct()
    return pairs.groupBy("session_id").agg(F.max("user_id").alias("user_id"))


def speed_segments(
    events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS, with_user: bool = True
) -> DataFrame:
    """Every uninterrupted stretch of each source session id, in order.

    ``last_segment`` is what the live state ends with; the others were closed.

    The user is looked up beside the measures: a maximum over text among them
    would turn the hash aggregation of all events into a sort, and a grouping
    by user would let a session id that many users share grow without bound.
    Comparisons that need no user leave the lookup out.
    """
    kept = unknown_session_filled(on_time_events(events))
    cells = kept.groupBy(
        "session_id", time_cell(F.col("effective_time"), timeout).alias("cell")
    ).agg(*event_measures(), *[F.expr(f"{how} AS {name}") for name, how in _STATE.items()])
    by_time = Window.partitionBy("session_id").orderBy("cell")
    gap = micros_between(F.col("first_time"), F.lag("last_time").over(by_time))
    numbered = cells.withColumn(
        "opens", F.when(gap > timeout * 1_000_000, 1).otherwise(0)
    ).withColumn("segment", F.sum("opens").over(by_time))
    # Sorted by session id already, so this window needs no new sort.
    numbered = numbered.withColumn("last_segment", F.expr("segment = max(segment) OVER (PARTITION BY session_id)"))
    segments = numbered.groupBy("session_id", "segment", "last_segment").agg(
        *combined_measures(), *[F.expr(f"max({name}) AS {name}") for name in _STATE]
    )
    if with_user:
        segments = segments.join(session_users(events), "session_id")
    seen = ", ".join(f"CASE WHEN seen_{kind} THEN '{kind}' END" for kind in sorted(EVENT_TYPES))
    return segments.selectExpr(
        "session_id",
        "segment",
        "last_segment",
        *(["user_id"] if with_user else []),
        "event_count",
        f"round({as_double_sql('cart_sum')}, 2) AS cart_total",
        f"round({as_double_sql('purchase_sum')}, 2) AS conversion_value",
        "converted",
        "first_time AS session_start",
        "last_time AS last_event_time",
        "conversion_time",
        "unix_seconds(last_time) - unix_seconds(first_time) AS duration_seconds",
        f"array_compact(array({seen})) AS event_types_seen",
        "date_format(first_time, 'yyyy-MM-dd') AS date_partition",
    )


def speed_sessions(
    events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS, with_user: bool = True
) -> DataFrame:
    """Final state per source session id: the stretch after its last gap."""
    return speed_segments(events, timeout, with_user).filter("last_segment").drop("segment", "last_segment")


def closed_speed_sessions(events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS) -> DataFrame:
    """Stretches that a later gap closed."""
    return speed_segments(events, timeout).filter("NOT last_segment").drop("last_segment")


def cart_totals(events: DataFrame, key: str = "session_id", removal_types: tuple[str, ...] = ()) -> DataFrame:
    """Cart value per key; never below 0 when events may also remove.

    With removals the total after each event is max(0, total - price). In time
    order that equals S - min(0, smallest running sum), S being the signed sum.
    Running sums are taken inside ranges of (key, time, id) and shifted by the
    ranges before, so no key is ever sorted in one task.
    """
    added = price_if("event_type = 'cart'")
    if not removal_types:
        return events.groupBy(key).agg(amount(as_double(F.sum(added))).alias("cart_total"))
    removes = ", ".join(f"'{kind}'" for kind in removal_types)
    signed = added - price_if(f"event_type IN ({removes})")
    rows = scan.ranged(events.select(key, "effective_time", "event_id", signed.alias("signed")), key, "effective_time", "event_id")
    line = scan.inside(key, "effective_time", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = rows.withColumn("running", F.sum("signed").over(line)).groupBy(scan.PART, key).agg(
        F.sum("signed").alias("moved"), F.min("running").alias("lowest")
    )
    before = scan.across(key).rowsBetween(Window.unboundedPreceding, -1)
    shifted = ranges.withColumn(
        "lowest", F.col("lowest") + F.coalesce(F.sum("moved").over(before), F.lit(0))
    )
    return shifted.groupBy(key).agg(
        amount(as_double(F.sum("moved") - F.least(F.lit(0), F.min("lowest")))).alias("cart_total")
    )


def expires_at(last_write: Column, ttl_seconds: int = STATE_TTL_SECONDS) -> Column:
    return plus_seconds(last_write, F.lit(ttl_seconds))


def live_sessions(state: DataFrame, as_of: Column, ttl_seconds: int = STATE_TTL_SECONDS) -> DataFrame:
    """State rows that have not expired at the given time."""
    return state.filter(expires_at(F.col("last_event_time"), ttl_seconds) > as_of)


def session_by_id(state: DataFrame, session_id: str) -> DataFrame:
    return state.filter(F.col("session_id") == session_id)


def sessions_by_user(state: DataFrame, user_id: str) -> DataFrame:
    return state.filter(F.col("user_id") == user_id)
