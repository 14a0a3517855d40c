"""Nightly job: the events that arrived, whatever their age, into all-time sessions.

    python -m tidemark.plans.nightly --date 2024-10-15 --raw-path ... --output-path ...

State lies beside the output (``<output>-state``): sessions as mergeable intervals
by start day, the source ids of each, the open sessions by the later days they reach
into, and the ids of the events taken in by event day. A run reads the folders
of the arrival days it is given, drops events it has seen, and touches only the
start days of sessions that change. All of that becomes visible with one manifest; a
run that was lost starts over, one that is repeated finds nothing new. The days of the
output that changed are then written anew, whole; a run that was lost in between does
that first.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import intervals as iv
from tidemark.operators.events import canonical_events, dedup_events, timed_events, valid_events
from tidemark.operators.stitch import _session_columns, id_chunks_of, links_of, sessions_of
from tidemark.schemas import SESSION_TIMEOUT_SECONDS
from tidemark.session import spark_session, stored
from tidemark.sinks.files import write_links, write_sessions
from tidemark.sinks.manifest import RunStore
from tidemark.sources.files import days_around, raw_events, readable

SEEN = T.StructType([T.StructField("event_id", T.StringType())])


def arrived_events(spark: SparkSession, raw_path: str, days: list[str], after_hours: int = 0) -> DataFrame:
    """Clean events of the arrival days and of the first hours behind each, repeats included."""
    folders = sorted({d for day in days for d in days_around(day, 0, after_hours)})
    rows = readable(raw_events(spark, raw_path, folders))
    hour = F.make_timestamp("year", "month", "day", "hour", F.lit(0), F.lit(0))
    near = F.lit(False)
    for day in days:
        midnight = F.lit(day).cast("date").cast("timestamp")
        near |= (hour >= midnight) & (hour < midnight + F.make_dt_interval(hours=F.lit(24 + after_hours)))
    return timed_events(valid_events(canonical_events(rows.where(near))))


def _texts(df: DataFrame) -> list[str]:
    """The few values of a one-column frame (days)."""
    return sorted(r[0] for r in df.distinct().collect())


def take_in(spark: SparkSession, state: RunStore, events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS) -> RunStore:
    """Adds the events that the state has not seen; returns the state after its commit."""
    day = iv.day_of(F.col("effective_time"))
    came = stored(events.select("event_id", "arrival_time", "user_id", "session_id", "event_type", "price", "is_late_arrival", "effective_time"), "came")
    seen = state.read("seen", SEEN, _texts(came.select(day)))
    fresh = stored(dedup_events(came).join(seen, "event_id", "left_anti"), "fresh")
    if fresh.isEmpty():
        return state
    new, new_ids = iv.event_intervals(fresh, timeout)
    new, new_ids = stored(new, "intervals"), stored(new_ids, "interval-ids")
    users = new.select("user_id").distinct()
    opened = state.read("open", iv.OPEN, _texts(new.select(iv.day_of(F.col("first_time"))))).join(users, "user_id", "left_semi")
    days = _texts(iv.days_touched(new, timeout)) + _texts(opened.select(iv.day_of(F.col("first_time"))))
    known = state.read("sessions", iv.INTERVAL, days).join(users, "user_id", "left_semi")
    groups = stored(iv.grouped(known, new, timeout), "groups")
    sessions = stored(iv.merged(groups), "merged")
    gone = groups.where("NOT fresh").select(*iv.INTERVAL.names)
    keys = gone.select("user_id", "first_time")
    first_day = iv.day_of(F.col("first_time"))

    change = state.change()
    touched = _texts(gone.select(first_day).union(sessions.select(first_day)))
    kept = state.read("sessions", iv.INTERVAL, touched).join(keys, ["user_id", "first_time"], "left_anti")
    change.replace("sessions", kept.select(*iv.INTERVAL.names).unionByName(sessions), first_day, touched)

    moved = groups.select("user_id", "first_time", "start").distinct()
    ids = state.read("ids", iv.INTERVAL_ID, touched).unionByName(new_ids).join(moved, ["user_id", "first_time"], "left")
    ids = ids.select("user_id", F.coalesce("start", "first_time").alias("first_time"), "session_id").distinct()
    change.replace("ids", ids, first_day, touched)

    was, now = iv.open_rows(gone, timeout), iv.open_rows(sessions, timeout)
    reached = _texts(was.select("open_day").union(now.select("open_day")))
    kept = state.read("open", iv.OPEN, reached).join(keys, ["user_id", "first_time"], "left_anti")
    change.replace("open", kept.select(*iv.OPEN.names).unionByName(now), F.col("open_day"), reached)
    change.add("seen", fresh.select("event_id", day.alias("event_day")), F.col("event_day"))
    return change.commit()


def session_rows(state: RunStore, days: list[str] | None = None) -> DataFrame:
    """Sessions that start on ``days`` (all), a row per source id, as :func:`stitched_ids`
    has them; ids of sessions hold user and start, so they are unique over days."""
    sessions = state.read("sessions", iv.INTERVAL, days)
    ids = state.read("ids", iv.INTERVAL_ID, days)
    counts = ids.groupBy("user_id", "first_time").agg(F.count(F.lit(1)).alias("id_bound"))
    name = F.concat_ws("_", "user_id", F.unix_micros("first_time").cast("string")).alias("batch_session_id")
    return sessions.join(counts, ["user_id", "first_time"], "left").join(ids, ["user_id", "first_time"], "left").select(
        "session_id", F.coalesce("id_bound", F.lit(0)).alias("id_bound"), name, *_session_columns()[1:])


def publish(state: RunStore, output_path: str, days: list[str]) -> None:
    """Writes sessions, links and id chunks of these start days, each day whole."""
    for day in days:
        rows = stored(session_rows(state, [day]), "published")
        write_sessions(sessions_of(rows), output_path, day)
        write_links(links_of(rows), f"{output_path.rstrip('/')}-links", day)
        write_links(id_chunks_of(rows), f"{output_path.rstrip('/')}-ids", day)


def run(
    spark: SparkSession, raw_path: str, output_path: str, days: list[str],
    timeout: int = SESSION_TIMEOUT_SECONDS, after_hours: int = 0, outputs: bool = True,
) -> RunStore:
    """Takes in the events that arrived on ``days`` and rewrites the output days that
    changed, here or in a run that was lost before it had written them. Without
    ``outputs`` only the state is kept."""
    state = RunStore(spark, f"{output_path.rstrip('/')}-state")
    state = take_in(spark, state, arrived_events(spark, raw_path, days, after_hours), timeout)
    if outputs:
        publish(state, output_path, sorted({*days, *state.changed_since(state.published(), "sessions")}))
        state.mark_published()
    return state


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--date", required=True, action="append", dest="days")
    parser.add_argument("--raw-path", required=True)
    parser.add_argument("--output-path", required=True)
    args = parser.parse_args()
    run(spark_session("nightly"), args.raw_path, args.output_path, args.days)


if __name__ == "__main__":
    main()
