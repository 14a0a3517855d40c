"""Speed answer against batch answer, one row per source session id and batch
session, and what changed.

The inputs are links (:func:`tidemark.operators.stitch.session_links`, or the
exploded id arrays of stored sessions) and speed sessions, unique by
``session_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import sum_of_doubles
from tidemark.operators.events import late_events, on_time_events
from tidemark.schemas import REVENUE_TOLERANCE, TOP_DETAIL, TOP_RESTATED
from tidemark.session import stored


def speed_side(speed: DataFrame) -> DataFrame:
    """Speed sessions under the names the comparison uses."""
    return speed.select(
        "session_id",
        F.col("cart_total").alias("rt_cart_total"),
        F.col("conversion_value").alias("rt_conversion_value"),
        F.col("event_count").alias("rt_event_count"),
        F.col("converted").alias("rt_converted"),
        F.col("duration_seconds").alias("rt_duration_seconds"),
        F.col("date_partition"),
    )


def outer_by_session(links: DataFrame, speed: DataFrame, batch_ids: DataFrame | None = None) -> DataFrame:
    """Full outer join on ``session_id``, in two parts that AQE can split.

    One id may stand in a large share of all links (a tracker that sends a
    fixed id). A full outer join cannot divide such a key; a left outer join
    and an anti join can, where both sides are stored tables: behind an
    aggregate or a window AQE splits nothing. ``batch_ids`` are the distinct session ids of the
    batch side, where they are cheaper to get than from ``links``.
    """
    ids = (links.select("session_id") if batch_ids is None else batch_ids.select("session_id")).distinct()
    both = links.join(speed, "session_id", "left")
    speed_only = speed.join(ids, "session_id", "left_anti")
    return both.unionByName(speed_only, allowMissingColumns=True)


def _or_zero(column: str, zero) -> Column:
    return F.coalesce(F.col(column), F.lit(zero))


def restatement_audit(speed: DataFrame, links: DataFrame, batch_ids: DataFrame | None = None) -> DataFrame:
    """Absolute discrepancy in cart value and event count; absent counts as 0."""
    left = speed_side(speed).select("session_id", "rt_cart_total", "rt_event_count", "rt_converted")
    right = links.select(
        "session_id", "batch_session_id", "batch_cart_total", "batch_event_count",
        "batch_converted", "had_restatement", "batch_session_date",
    )
    return outer_by_session(right, left, batch_ids).withColumns({
        "revenue_discrepancy": F.abs(_or_zero("batch_cart_total", 0.0) - _or_zero("rt_cart_total", 0.0)),
        "event_count_discrepancy": F.abs(_or_zero("batch_event_count", 0) - _or_zero("rt_event_count", 0)),
    })


def restatement_type(flip_first: bool = False) -> Column:
    """First rule that applies names the row.

    ``flip_first`` lets a changed conversion win over a changed event count.
    """
    count = (F.col("event_count_delta") != 0, "event_count_restatement")
    flip = (F.col("conversion_flipped"), "conversion_flip")
    rules = [
        (F.col("session_id").isNull(), "new_in_batch"),
        (F.col("rt_cart_total").isNull(), "missing_in_realtime"),
        (F.col("cart_total_abs_delta") > REVENUE_TOLERANCE, "revenue_restatement"),
        *([flip, count] if flip_first else [count, flip]),
    ]
    named = F.coalesce(*[F.when(applies, F.lit(name)) for applies, name in rules])
    return F.coalesce(named, F.lit("no_restatement"))


def session_deltas(
    links: DataFrame,
    speed: DataFrame,
    batch_ids: DataFrame | None = None,
    flip_first: bool = False,
) -> DataFrame:
    """Signed and absolute changes per row, and the kind of restatement.

    ``presence`` says on which side the session id was found.
    """
    joined = outer_by_session(links, speed_side(speed), batch_ids)
    delta = F.round(_or_zero("batch_cart_total", 0.0) - _or_zero("rt_cart_total", 0.0), 2)
    return (
        joined.withColumns({
            "cart_total_delta": delta,
            "cart_total_abs_delta": F.abs(delta),
            "event_count_delta": _or_zero("batch_event_count", 0) - _or_zero("rt_event_count", 0),
            "conversion_flipped": F.col("batch_converted") != F.col("rt_converted"),
            "presence": F.when(F.col("batch_session_id").isNull(), "speed_only")
            .when(F.col("rt_event_count").isNull(), "batch_only")
            .otherwise("both"),
        })
        .withColumn("restatement_type", restatement_type(flip_first))
    )


def restatement_stats(deltas: DataFrame) -> DataFrame:
    """One summary row. Money is added as decimals, so it is reproducible."""
    kind = F.col("restatement_type")
    total = sum_of_doubles(F.col("cart_total_abs_delta"))
    return deltas.agg(
        F.count(F.lit(1)).alias("total_sessions_compared"),
        F.count_if(kind != "no_restatement").alias("sessions_restated"),
        (total / F.count("cart_total_abs_delta")).alias("avg_revenue_discrepancy"),
        F.max("cart_total_abs_delta").alias("max_revenue_discrepancy"),
        total.alias("total_revenue_restated"),
        F.avg("event_count_delta").alias("avg_event_count_discrepancy"),
        F.count_if(kind == "conversion_flip").alias("conversion_flips"),
        F.count_if(kind == "new_in_batch").alias("new_sessions_in_batch"),
        F.count_if("conversion_flipped").alias("sessions_with_changed_conversion"),
    )


def restatement_breakdown(deltas: DataFrame) -> DataFrame:
    return (
        deltas.groupBy("restatement_type")
        .agg(
            F.count(F.lit(1)).alias("session_count"),
            sum_of_doubles(F.col("cart_total_abs_delta")).alias("total_revenue_impact"),
        )
        .orderBy(F.desc("session_count"), "restatement_type")
    )


def top_restated(deltas: DataFrame, limit: int = TOP_RESTATED) -> DataFrame:
    """Sessions with the largest change of cart value; ties by ids."""
    return (
        deltas.select(
            "session_id", "batch_session_id", "rt_cart_total", "batch_cart_total",
            "cart_total_delta", "restatement_type", "cart_total_abs_delta",
        )
        .orderBy(F.desc("cart_total_abs_delta"), "session_id", "batch_session_id")
        .limit(limit)
    )


def restatement_detail(
    links: DataFrame, speed: DataFrame, date: str | None = None, limit: int = TOP_DETAIL
) -> DataFrame:
    """Restated sessions side by side, largest change first.

    The membership of an id in a session is an equi join on the link rows.
    """
    left = speed_side(speed)
    if date is not None:
        left = left.filter(F.col("date_partition") == date)
    restated = links.filter("had_restatement")
    change = F.round(F.col("batch_cart_total") - F.col("rt_cart_total"), 2)
    return (
        restated.join(left, "session_id")
        .select(
            "session_id",
            "batch_session_id",
            F.round("rt_cart_total", 2).alias("rt_cart_total"),
            F.round("batch_cart_total", 2).alias("batch_cart_total"),
            change.alias("cart_delta"),
            "rt_event_count",
            "batch_event_count",
            "late_arrival_count",
            "had_restatement",
        )
        .orderBy(F.desc(F.abs("cart_delta")), "session_id", "batch_session_id")
        .limit(limit)
    )


def audit_totals(audit: DataFrame, date: str | None = None) -> DataFrame:
    """Totals of the audit rows, of one batch day when ``date`` is given."""
    rows = audit if date is None else audit.filter(F.col("batch_session_date") == F.lit(date).cast("date"))
    total = sum_of_doubles(F.col("revenue_discrepancy"))
    return rows.agg(
        F.count(F.lit(1)).alias("total_sessions_compared"),
        F.count_if("had_restatement").alias("sessions_restated"),
        (total / F.count("revenue_discrepancy")).alias("avg_revenue_discrepancy"),
        F.max("revenue_discrepancy").alias("max_revenue_discrepancy"),
        total.alias("total_revenue_restated"),
        F.avg("event_count_discrepancy").alias("avg_event_count_discrepancy"),
    )


def late_event_match(events: DataFrame) -> DataFrame:
    """Late events against the on-time sessions with the same id and user:
    do they restate an existing session or open a new one. The known pairs are
    stored first, so that AQE can split a pair with many late events."""
    known = stored(on_time_events(events).select("session_id", "user_id").distinct(), "known").withColumn("known", F.lit(True))
    return late_events(events).join(known, ["session_id", "user_id"], "left").select(
        "event_id",
        "session_id",
        "user_id",
        "effective_time",
        F.when(F.col("known"), "existing_session").otherwise("new_session").alias("match"),
        F.when(F.col("event_type") == "cart", F.col("price")).otherwise(F.lit(0.0)).alias("revenue_delta"),
    )
