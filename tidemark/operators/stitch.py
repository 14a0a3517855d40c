"""Batch sessions: all events of a user, late ones included, cut at gaps.

A window over the raw events of a user would put the busiest user into one
task. Here time is first cut into cells no wider than the timeout. Two events
of one user in one cell are always closer than the timeout, so a cell never
holds a session boundary and can be aggregated before anything is sorted. What
is left per user is one row per cell and user, a number bounded by the time
range read, and only these rows go through the per-user window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.money import as_double_sql, price_if
from tidemark.functions.times import seconds_between, time_cell
from tidemark.operators import scan
from tidemark.schemas import INLINE_ID_LIMIT, SESSION_TIMEOUT_SECONDS

# Ids in one row of the id chunks, about.
CHUNK_IDS = 10_000


def event_measures() -> list[Column]:
    """Session measures over events; every one can be combined in parts."""
    return [
        F.expr("min(effective_time) AS first_time"),
        F.expr("max(effective_time) AS last_time"),
        F.expr("count(1) AS event_count"),
        F.sum(price_if("event_type = 'cart'")).alias("cart_sum"),
        F.sum(price_if("event_type = 'purchase'")).alias("purchase_sum"),
        F.expr("max(event_type = 'purchase') AS converted"),
        F.expr("count_if(is_late_arrival) AS late_count"),
    ]


# How each measure combines over rows that already carry it.
COMBINE = {
    "first_time": "min", "last_time": "max", "event_count": "sum", "cart_sum": "sum",
    "purchase_sum": "sum", "converted": "max", "late_count": "sum",
}


def combined_measures() -> list[Column]:
    return [F.expr(f"{how}({name}) AS {name}") for name, how in COMBINE.items()]


def _numbered_cells(cells: DataFrame, timeout: int) -> DataFrame:
    """Give every (user, cell) row the number of the session it belongs to."""
    by_time = Window.partitionBy("user_id").orderBy("cell")
    gap = seconds_between(F.col("first_time"), F.lag("last_time").over(by_time))
    opens = F.when(gap <= timeout, 0).otherwise(1)
    return cells.withColumn("opens", opens).withColumn(
        "user_session_seq", F.sum("opens").over(by_time)
    ).drop("opens")


def _session_id() -> Column:
    return F.concat_ws("_", F.col("user_id"), F.col("user_session_seq").cast("string"))


def _session_columns() -> list[Column]:
    return [F.expr(e) for e in (
        "concat_ws('_', user_id, CAST(user_session_seq AS string)) AS batch_session_id",
        "user_id",
        "first_time AS session_start",
        "last_time AS session_end",
        "event_count",
        f"{as_double_sql('cart_sum')} AS cart_total",
        f"{as_double_sql('purchase_sum')} AS conversion_value",
        "converted",
        "unix_seconds(last_time) - unix_seconds(first_time) AS duration_seconds",
        "late_count AS late_arrival_count",
        "late_count > 0 AS had_restatement",
        "to_date(first_time) AS session_date",
    )]


def batch_session_facts(events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS) -> DataFrame:
    """Session rows without their source ids.

    Two exchanges: partial aggregates by (user, cell), then the cell rows by
    user; the last grouping reuses the second one.
    """
    return (
        _numbered_cells(_cells(events, timeout, count_ids=False), timeout)
        .groupBy("user_id", "user_session_seq")
        .agg(*combined_measures())
        .select(*_session_columns())
    )


def _cells(events: DataFrame, timeout: int, count_ids: bool) -> DataFrame:
    """Measures per (user, cell). Counting distinct ids costs a second
    grouping, so only those who need the count ask for it."""
    cell = time_cell(F.col("effective_time"), timeout).alias("cell")
    if not count_ids:
        return events.groupBy("user_id", cell).agg(*event_measures())
    parts = events.groupBy("user_id", cell, "session_id").agg(*event_measures())
    return parts.groupBy("user_id", "cell").agg(*combined_measures(), F.count("session_id").alias("id_bound"))


def _session_totals_per_cell(events: DataFrame, timeout: int, count_ids: bool) -> DataFrame:
    """(user, cell) rows carrying the totals of the session they lie in; with
    ``id_bound``, an upper bound of that session's number of source ids."""
    whole = "OVER (PARTITION BY user_id, user_session_seq)"
    totals = {**COMBINE, "id_bound": "sum"} if count_ids else COMBINE
    return _numbered_cells(_cells(events, timeout, count_ids), timeout).selectExpr(
        "user_id", "cell", "user_session_seq",
        *[f"{how}({name}) {whole} AS {name}" for name, how in totals.items()],
    )


def stitched_ids(events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS, count_ids: bool = True) -> DataFrame:
    """One row per (user, cell, source id) with the columns of its session.

    Sessions and links are both plain groupings of these rows. A job that needs
    both writes them once and reads them twice.
    """
    ids = events.select(
        "user_id", time_cell(F.col("effective_time"), timeout).alias("cell"), "session_id"
    ).distinct()
    bound = ["id_bound"] if count_ids else []
    return ids.join(_session_totals_per_cell(events, timeout, count_ids), ["user_id", "cell"]).select(
        "session_id", *bound, *_session_columns()
    )


def sessions_of(rows: DataFrame, inline_limit: int = INLINE_ID_LIMIT) -> DataFrame:
    """Sessions out of :func:`stitched_ids`.

    ``original_session_ids`` is filled where the session cannot have more than
    ``inline_limit`` ids. Above that the column is null; the links hold the ids
    row by row and :func:`id_chunks_of` in bounded rows, both complete for every
    session: an id list of unknown length is never gathered into one row.
    """
    facts = [c for c in rows.columns if c not in ("session_id", "id_bound", "batch_session_id", "user_id")]
    inline = F.col("id_bound") <= inline_limit
    return (
        rows.groupBy("batch_session_id", "user_id")
        .agg(
            *[F.expr(f"max({c}) AS {c}") for c in facts],
            F.max("id_bound").alias("id_bound"),
            F.collect_set(F.when(inline, F.col("session_id"))).alias("ids"),
        )
        .withColumn("original_session_ids", F.when(inline, F.array_sort("ids")))
        .drop("ids", "id_bound")
    )


def batch_sessions(
    events: DataFrame,
    timeout: int = SESSION_TIMEOUT_SECONDS,
    inline_limit: int = INLINE_ID_LIMIT,
) -> DataFrame:
    """Sessions with the set of source session ids they were stitched from."""
    return sessions_of(stitched_ids(events, timeout), inline_limit)


def id_chunks_of(rows: DataFrame, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """The ids of every session, whatever their number, out of :func:`stitched_ids`:
    rows (batch_session_id, n_ids, chunk, ids). ``n_ids`` is the exact distinct count
    of the session; each chunk holds about ``chunk_ids`` ids, dealt out by hash, so
    no row grows with the session. Sessions without ids have no chunk."""
    ids = rows.where("session_id IS NOT NULL").select("batch_session_id", "session_id").distinct()
    counts = ids.groupBy("batch_session_id").agg(F.count(F.lit(1)).alias("n_ids"))
    chunk = F.pmod(F.xxhash64("session_id"), F.ceil(F.col("n_ids") / chunk_ids)).cast("int")
    return ids.join(counts, "batch_session_id").groupBy("batch_session_id", "n_ids", chunk.alias("chunk")).agg(
        F.array_sort(F.collect_set("session_id")).alias("ids")
    )


def session_id_chunks(events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    return id_chunks_of(stitched_ids(events, timeout, count_ids=False), chunk_ids)


# Session column -> its name on a link row.
LINK_COLUMNS = {
    "cart_total": "batch_cart_total",
    "conversion_value": "batch_conversion_value",
    "event_count": "batch_event_count",
    "converted": "batch_converted",
    "duration_seconds": "batch_duration_seconds",
    "late_arrival_count": "late_arrival_count",
    "had_restatement": "had_restatement",
    "session_date": "batch_session_date",
}


def links_of(rows: DataFrame) -> DataFrame:
    """One row per (source session id, batch session) with the batch values:
    the exploded form of the id set, built without ever making the set."""
    return rows.filter("session_id IS NOT NULL").groupBy("session_id", "batch_session_id").agg(
        *[F.expr(f"max({name}) AS {out}") for name, out in LINK_COLUMNS.items()]
    )


def session_links(events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS) -> DataFrame:
    return links_of(stitched_ids(events, timeout, count_ids=False))


def exploded_links(sessions: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """Links out of stored sessions. With the rows of :func:`id_chunks_of` they
    are complete for every session; without, ids come from the arrays of the
    session rows, and a session whose array is null for its size is an error."""
    facts = [f"{name} AS {out}" for name, out in LINK_COLUMNS.items()]
    if chunks is not None:
        ids = chunks.selectExpr("explode(ids) AS session_id", "batch_session_id")
        return ids.join(sessions.selectExpr("batch_session_id", *facts), "batch_session_id").select(
            "session_id", "batch_session_id", *LINK_COLUMNS.values())
    missing = "assert_true(original_session_ids IS NOT NULL, 'ids of large sessions are in the id chunks')"
    return sessions.where(F.expr(f"{missing} IS NULL")).selectExpr("explode(original_session_ids) AS session_id", "batch_session_id", *facts)


def with_stable_id(sessions: DataFrame) -> DataFrame:
    """Adds an id from user and start, which does not restart with each run."""
    return sessions.withColumn(
        "stable_session_id",
        F.concat_ws("_", F.col("user_id"), F.unix_micros("session_start").cast("string")),
    )


# --- operators that return every event ---------------------------------------
def scanned(events: DataFrame, key: str, tie: str, timeout: int) -> DataFrame:
    """Every event with the time before it, its session number and its place.

    Events are sorted inside ranges of (key, time, id); the last time, the number of
    sessions and the number of events of the ranges before come from a scan over
    the ranges' edges (:mod:`tidemark.operators.scan`).
    """
    def opens(before: Column) -> Column:
        return F.when(seconds_between(F.col("effective_time"), before) <= timeout, 0).otherwise(1)

    line = scan.inside(key, "effective_time", tie)
    rows = scan.ranged(events, key, "effective_time", tie).withColumns({
        "before": F.lag("effective_time").over(line), "place": F.row_number().over(line),
    })
    rows = rows.withColumn("later_opens", F.when(F.col("place") > 1, opens(F.col("before"))).otherwise(0))
    rows = rows.withColumn("opened", F.sum("later_opens").over(line))
    summary = rows.groupBy(scan.PART, key).agg(
        F.min("effective_time").alias("effective_time"), F.max("effective_time").alias("last"),
        F.count(F.lit(1)).alias("held"), F.sum("later_opens").alias("opened"),
    )
    over = scan.across(key)
    chain = scan.edges(summary, key).withColumn("carry_time", F.lag("last").over(over))
    chain = chain.withColumn("opened", F.col("opened") + opens(F.col("carry_time")))
    carried = chain.select(
        scan.PART, key, "carry_time", (F.sum("held").over(over) - F.col("held")).alias("carry_place"),
        (F.sum("opened").over(over) - F.col("opened")).alias("carry_opened"),
    )
    first = F.col("place") == 1
    known = scan.with_carry(rows, carried, key).withColumn("prev_event_time", F.when(first, F.col("carry_time")).otherwise(F.col("before")))
    # The first event of a range opens a session by what the range before tells.
    entry = F.when(seconds_between(F.first("effective_time").over(line), F.col("carry_time")) <= timeout, 0).otherwise(1)
    return known.withColumns({
        "is_session_start": F.when(first, opens(F.col("carry_time"))).otherwise(F.col("later_opens")),
        "session_seq": F.coalesce("carry_opened", F.lit(0)) + entry + F.col("opened"),
        "position": F.coalesce("carry_place", F.lit(0)) + F.col("place"),
    }).drop(scan.PART, "before", "place", "later_opens", "opened", "carry_time", "carry_place", "carry_opened")


def event_gaps(events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS) -> DataFrame:
    """Previous event of the same user and the whole seconds since it."""
    rows = scanned(events, "user_id", "event_id", timeout)
    return rows.withColumn(
        "gap_seconds", seconds_between(F.col("effective_time"), F.col("prev_event_time"))
    ).drop("session_seq", "position", "is_session_start")


def session_boundaries(events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS) -> DataFrame:
    rows = scanned(events, "user_id", "event_id", timeout)
    return rows.drop("session_seq", "position")


def sessionized_events(events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS) -> DataFrame:
    """Every event with ``user_session_seq`` and ``batch_session_id``."""
    rows = scanned(events, "user_id", "event_id", timeout)
    rows = rows.withColumnRenamed("session_seq", "user_session_seq").drop("position")
    return rows.withColumn("batch_session_id", _session_id())


def session_event_paths(events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS) -> DataFrame:
    """Events numbered in time order inside their source session."""
    rows = scanned(events, "session_id", "event_id", timeout)
    return rows.select("session_id", "position", "event_id", "event_type", "effective_time")


def session_window_sessions(events: DataFrame, timeout: int = SESSION_TIMEOUT_SECONDS) -> DataFrame:
    """Gap sessions through Spark's own session window (microsecond gaps).

    The window runs over cell rows: each opens an interval from its first
    event to ``timeout`` after its last, and overlapping intervals merge.
    """
    cells = _cells(events, timeout, count_ids=False)
    span = F.concat(
        (F.unix_micros("last_time") - F.unix_micros("first_time") + F.lit(timeout * 1_000_000)).cast("string"),
        F.lit(" microseconds"),
    )
    return (
        cells.groupBy("user_id", F.session_window("first_time", span).alias("span"))
        .agg(*combined_measures())
        .select(
            "user_id",
            F.col("first_time").alias("session_start"),
            F.col("last_time").alias("session_end"),
            "event_count",
            F.expr(f"{as_double_sql('cart_sum')} AS cart_total"),
            F.col("converted"),
        )
    )
