"""Live session state per source session id.

Events are combined per (session, cell) inside each Arrow batch before the
shuffle to the state, as in the batch operators: a session id that carries a
third of the stream reaches its state task as a few summary rows. The
processor then folds summaries in time order, closes a session at a gap above
the timeout, and drops it from state after two hours of event time. State is kept
per bucket of session ids, so Spark calls Python once per bucket and micro-batch,
not once per session.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.money import price_if
from tidemark.operators.events import on_time_events, unknown_session_filled
from tidemark.schemas import (
    EVENT_TYPES,
    LATE_DELAY_MAX_SECONDS,
    MONEY_TYPE,
    SESSION_TIMEOUT_SECONDS,
    STATE_TTL_SECONDS,
)

SEEN = [f"seen_{kind}" for kind in sorted(EVENT_TYPES)]

SUMMARY_SCHEMA = (
    "session_id string, cell bigint, user_id string, first_us bigint, last_us bigint, event_count bigint,"
    f" cart_sum {MONEY_TYPE}, purchase_sum {MONEY_TYPE}, conversion_us bigint, "
    + ", ".join(f"{name} boolean" for name in SEEN)
)
STATE_SCHEMA = SUMMARY_SCHEMA.removeprefix("session_id string, cell bigint, ")
OUTPUT_SCHEMA = (
    "session_id string, user_id string, status string, event_count bigint, cart_total double,"
    " conversion_value double, converted boolean, session_start timestamp, last_event_time timestamp,"
    " conversion_time timestamp, duration_seconds bigint, event_types_seen array<string>, date_partition string"
)
_STATE_FIELDS = [part.split()[0] for part in STATE_SCHEMA.split(", ")]
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), MONEY_TYPE: pa.decimal128(38, 6)}
_LAYOUT = pa.schema([(name, _ARROW[kind]) for name, kind in
                     (part.split() for part in f"session_id string, {STATE_SCHEMA}".split(", "))])
# Part of the state's layout: a checkpoint keeps the number it was made with.
STATE_BUCKETS = 512
# No conversion yet; kept out of the nullable range so that max() works.
_NEVER = -(2**62)

_HOW = {
    "user_id": "max", "first_us": "min", "last_us": "max", "event_count": "sum", "cart_sum": "sum",
    "purchase_sum": "sum", "conversion_us": "max", **{name: "max" for name in SEEN},
}


def _reduced(rows: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
    """One row per run of rows; ``first`` holds where each run begins."""
    how = {"min": np.minimum, "max": np.maximum, "sum": np.add}
    return pd.DataFrame({
        "session_id": rows["session_id"].to_numpy()[first],
        **{name: how[_HOW[name]].reduceat(rows[name].to_numpy(), first) for name in _STATE_FIELDS},
    })


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Summaries of the rows of each Arrow batch; associative, so how the rows
    were cut into batches does not matter."""
    for rows in batches:
        if len(rows):
            code, _ = pd.factorize(rows["session_id"])
            order = np.lexsort((rows["cell"], code))
            rows, code = rows.iloc[order], code[order]
            cell = rows["cell"].to_numpy()
            first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (cell[1:] != cell[:-1])])
            out = _reduced(rows, first)
            out.insert(1, "cell", cell[first])
            yield out


def summaries(events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS) -> DataFrame:
    """On-time events as summary rows per session and cell, not yet shuffled."""
    at = F.unix_micros("effective_time")
    kind = F.col("event_type")
    rows = unknown_session_filled(on_time_events(events)).filter(F.col("effective_time").isNotNull()).select(
        "session_id",
        F.floor(at / F.lit(timeout * 1_000_000)).alias("cell"),
        F.coalesce("user_id", F.lit("")).alias("user_id"),
        at.alias("first_us"),
        at.alias("last_us"),
        F.lit(1).cast("bigint").alias("event_count"),
        price_if("event_type = 'cart'").cast(MONEY_TYPE).alias("cart_sum"),
        price_if("event_type = 'purchase'").cast(MONEY_TYPE).alias("purchase_sum"),
        F.when(kind == "purchase", at).otherwise(F.lit(_NEVER)).alias("conversion_us"),
        *[F.coalesce(kind == k, F.lit(False)).alias(name) for k, name in zip(sorted(EVENT_TYPES), SEEN)],
    )
    return rows.mapInPandas(_combine, SUMMARY_SCHEMA)


def folded(held: pd.DataFrame, new: pd.DataFrame, timeout_us: int) -> tuple[pd.DataFrame, np.ndarray]:
    """Stretches of the sessions in ``new``, each behind what is ``held`` of it, and
    which of them a later stretch of the same session has closed."""
    rows = pd.concat([held[held["session_id"].isin(new["session_id"])], new[held.columns]], ignore_index=True)
    code, _ = pd.factorize(rows["session_id"])
    # What is held comes first, whatever the times of the new rows.
    order = np.lexsort((rows["first_us"], np.arange(len(rows)) >= len(rows) - len(new), code))
    rows, code = rows.iloc[order], code[order]
    # All rows before a gap end before it, so the latest end of the session so far will do.
    last = rows["last_us"].groupby(code).cummax().to_numpy()
    other = code[1:] != code[:-1]
    gap = rows["first_us"].to_numpy()[1:] - last[:-1] > timeout_us
    first = np.flatnonzero(np.r_[True, other | gap])
    return _reduced(rows, first), np.r_[code[first][1:] == code[first][:-1], False]


def _changes(sessions: pd.DataFrame, status: str | np.ndarray) -> pd.DataFrame:
    start = pd.to_datetime(sessions["first_us"], unit="us", utc=True)
    converted = sessions["conversion_us"] != _NEVER
    seen = sum(sessions[name] * (1 << i) for i, name in enumerate(SEEN))
    kinds = [[k for i, k in enumerate(sorted(EVENT_TYPES)) if code >> i & 1] for code in range(1 << len(SEEN))]
    return pd.DataFrame({
        "session_id": sessions["session_id"], "user_id": sessions["user_id"], "status": status,
        "event_count": sessions["event_count"],
        "cart_total": [round(float(x), 2) for x in sessions["cart_sum"]],
        "conversion_value": [round(float(x), 2) for x in sessions["purchase_sum"]],
        "converted": converted, "session_start": start,
        "last_event_time": pd.to_datetime(sessions["last_us"], unit="us", utc=True),
        "conversion_time": pd.to_datetime(sessions["conversion_us"].where(converted, 0), unit="us", utc=True).where(converted),
        "duration_seconds": sessions["last_us"] // 1_000_000 - sessions["first_us"] // 1_000_000,
        "event_types_seen": [kinds[code] for code in seen],
        "date_partition": start.dt.strftime("%Y-%m-%d"),
    })


class SessionProcessor(StatefulProcessor):
    """Live sessions of one bucket of ids, kept as one Arrow table and folded as columns;
    a call per session would cost more than the fold. One timer stands at the next
    expiry of the bucket. The argument names of the three handlers are given by
    Spark, which passes them by keyword."""

    def __init__(self, timeout: int, ttl: int):
        self.timeout_us = timeout * 1_000_000
        self.ttl_ms = ttl * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sessions", "held binary")

    def _held(self) -> pd.DataFrame:
        if not self.state.exists():
            return _LAYOUT.empty_table().to_pandas()
        with pa.ipc.open_stream(bytes(self.state.get()[0])) as held:
            return held.read_pandas()

    def _hold(self, sessions: pd.DataFrame) -> None:
        """Keeps the sessions, with the timer at the first of them to expire."""
        if not len(sessions):
            self.state.clear()
            return
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, _LAYOUT) as writer:
            writer.write_table(pa.Table.from_pandas(sessions, _LAYOUT, preserve_index=False))
        self.state.update((out.getvalue().to_pybytes(),))
        self.handle.registerTimer(int(self._expiry(sessions).min()))

    def _expiry(self, sessions: pd.DataFrame) -> pd.Series:
        return sessions["last_us"] // 1000 + self.ttl_ms + 1

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held, new = self._held(), pd.concat(list(rows), ignore_index=True)
        stretches, closed = folded(held, new, self.timeout_us)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        rest = held[~held["session_id"].isin(new["session_id"])]
        active = stretches[~closed]
        self._hold(pd.concat([rest, active], ignore_index=True) if len(rest) else active)
        yield _changes(stretches, np.where(closed, "closed", "active"))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        held = self._held()
        over = self._expiry(held) <= timerValues.getCurrentWatermarkInMs()
        self._hold(held[~over])
        if over.any():
            yield _changes(held[over], "expired")

    def close(self) -> None:
        pass


def session_updates(
    events: DataFrame,
    timeout: int = SESSION_TIMEOUT_SECONDS,
    ttl: int = STATE_TTL_SECONDS,
    delay_seconds: int = LATE_DELAY_MAX_SECONDS,
) -> DataFrame:
    """Changes of session state: ``active``, ``closed`` and ``expired`` rows.

    The watermark waits as long as an event can be held back, so rows that are
    old but not flagged late still reach their session.
    """
    rows = summaries(events, timeout).withColumn("seen_at", F.timestamp_micros("last_us"))
    return (
        rows.withWatermark("seen_at", f"{delay_seconds} seconds")
        .withColumn("bucket", F.pmod(F.xxhash64("session_id"), F.lit(STATE_BUCKETS)))
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=SessionProcessor(timeout, ttl),
            outputStructType=OUTPUT_SCHEMA,
            outputMode="Update",
            timeMode="eventTime",
        )
    )
