"""One function per registered query. Each reads whole tables; times leave as
microseconds since 1970 and days as text, so that engines agree on values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import inputs
from suite.inputs import SIX_HOURS
from tidemark.functions.money import decimals_in, lenient_number
from tidemark.functions.times import date_part, on_day
from tidemark.operators import events as ev
from tidemark.operators import health, quarantine, reconcile, report, speed, stitch
from tidemark.session import scratch_path, stored
from tidemark.sinks import files as sink
from tidemark.plans import nightly
from tidemark.plans.stitch import stored_days
from tidemark.sources import files as source
from tidemark.sources import tables
from tidemark.streaming import behind, sessionizer, state_table, windows
from tidemark.streaming.counters import counted
from tidemark.streaming.routing import start_routing
from tidemark.streaming.source import file_events, file_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

REPORT_DAY = "2024-01-15"
REPORT_USER = "42"


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return portable(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def portable(df: DataFrame) -> DataFrame:
    """Timestamps as microseconds, dates as text, arrays as sorted text."""
    def out(name: str, kind: str):
        if kind.startswith("timestamp"):
            return F.unix_micros(name).alias(name)
        if kind == "date":
            return F.col(name).cast("string").alias(name)
        if kind == "array<string>":
            return F.array_join(F.array_sort(name), ",").alias(name)
        return F.col(name)

    return df.select(*[out(name, kind) for name, kind in df.dtypes])


# --- sources ---------------------------------------------------------------------
@query
def raw_events_scan(spark, sf_dir):
    """NDJSON hour folders back to events: per day rows, late rows and value."""
    rows = source.readable(source.raw_events(spark, inputs.landed(spark, sf_dir, "events")))
    return rows.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("is_late_arrival").alias("late"),
        F.countDistinct("event_id").alias("ids"), F.sum(F.col("price").cast("decimal(18,4)")).cast("double").alias("value"),
    )


@query
def raw_events_day(spark, sf_dir):
    """The events of one arrival day; only that day's folders are listed."""
    base = inputs.landed(spark, sf_dir, "events")
    rows = source.readable(source.raw_events(spark, base, [REPORT_DAY]))
    return rows.select("event_id", "event_type", "price", "user_id", "session_id", "hour", "is_late_arrival")


@query
def late_arrivals_table(spark, sf_dir):
    base = inputs.landed(spark, sf_dir, "late-arrivals")
    rows = source.readable(source.raw_events(spark, base))
    return rows.select("event_id", "event_type", "user_id", "late_arrival_delay_seconds", "year", "month", "day", "hour")


@query
def realtime_snapshot_typed(spark, sf_dir):
    text = source.snapshot_text(spark, inputs.landed(spark, sf_dir, "snapshot"))
    return source.snapshot_typed(text).withColumns({
        "session_start": F.try_to_timestamp("session_start"),
        "last_event_time": F.try_to_timestamp("last_event_time"),
    })


@query
def csv_events_scan(spark, sf_dir):
    rows = source.shop_csv(spark, inputs.landed(spark, sf_dir, "shop-csv"))
    return rows.select("event_id", "event_time", "event_type", "product_id", "category_id", "brand", "price",
                       "user_id", "session_id", "is_late_arrival")


@query
def csv_first_events(spark, sf_dir):
    rows = source.shop_csv(spark, inputs.landed(spark, sf_dir, "shop-csv"), first=500)
    return rows.select("event_id", "event_time", "event_type", "price", "user_id")


@query
def columnar_events_scan(spark, sf_dir):
    """The 13-column Parquet form with its required members filled."""
    rows = source.raw_events_parquet(spark, inputs.landed(spark, sf_dir, "columnar"))
    return rows.select("event_id", "event_type", "category_id", "category_code", "brand", "price", "session_id",
                       "is_late_arrival", "late_arrival_delay_seconds")


@query
def malformed_split(spark, sf_dir):
    """Lines that parse and lines that do not, counted per kind."""
    lines = spark.read.text(inputs.landed(spark, sf_dir, "lines"))
    good, bad = quarantine.malformed_split(lines)
    return good.groupBy(F.col("event_type").alias("kind")).agg(F.count(F.lit(1)).alias("rows")).unionByName(
        bad.groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def quarantined_lines(spark, sf_dir):
    return quarantine.malformed_split(spark.read.text(inputs.landed(spark, sf_dir, "lines")))[1]


@query
def decode_records(spark, sf_dir):
    rows = quarantine.decode_records(inputs.stream_records(spark, sf_dir))
    return rows.select("event_id", F.try_to_timestamp("event_time").alias("event_time"), "event_type", "price",
                       "user_id", "session_id", "is_late_arrival", "sequence", "arrival")


@query
def undecodable_records(spark, sf_dir):
    return quarantine.undecodable_records(inputs.stream_records(spark, sf_dir)).select("sequence", "arrival", "reason")


@query
def dlq_decode(spark, sf_dir):
    rows = quarantine.dlq_decode(inputs.dead_letters(spark, sf_dir))
    return rows.select("message_id", "event_id", "event_type", "session_id", "is_late_arrival")


@query
def dlq_needs_refetch(spark, sf_dir):
    return quarantine.needs_refetch(inputs.dead_letters(spark, sf_dir))


@query
def dlq_replay_counts(spark, sf_dir):
    return quarantine.dlq_replay_counts(inputs.dead_letters(spark, sf_dir), dry_run=False)


@query
def dlq_replay_dry_run(spark, sf_dir):
    return quarantine.dlq_replay_counts(inputs.dead_letters(spark, sf_dir), dry_run=True)


@query
def typed_json_flatten(spark, sf_dir):
    flat = quarantine.typed_json_flatten(inputs.typed_items(spark, sf_dir))
    plain = ("session_id", "user_id", "event_count", "cart_total", "converted")
    return flat.select(*[F.col("scalars")[c].alias(c) for c in plain],
                       F.col("lists")["event_types_seen"].alias("event_types_seen"))


@query
def schema_merge(spark, sf_dir):
    rows = source.merged_parquet(spark, inputs.landed(spark, sf_dir, "two-layouts"))
    return rows.select("event_id", "brand", "price", "is_late_arrival", "late_arrival_delay_seconds")


# --- projections and filters -------------------------------------------------------
@query
def canonical_events(spark, sf_dir):
    return ev.canonical_events(inputs.dirty_events(spark, sf_dir))


@query
def effective_time(spark, sf_dir):
    return ev.add_effective_time(inputs.dirty_events(spark, sf_dir)).select("event_id", "effective_time")


@query
def valid_events(spark, sf_dir):
    return ev.valid_events(inputs.dirty_events(spark, sf_dir)).select("event_id", "user_id", "session_id", "event_type")


@query
def invalid_event_counts(spark, sf_dir):
    return ev.invalid_event_counts(inputs.dirty_events(spark, sf_dir))


@query
def event_type_domain(spark, sf_dir):
    return ev.keep_event_domain(inputs.dirty_events(spark, sf_dir)).select("event_id", "event_type")


@query
def schema_violations(spark, sf_dir):
    rows = ev.schema_violations(inputs.dirty_events(spark, sf_dir))
    return rows.select("event_id", "arrival_time", F.array_join("reasons", ",").alias("reasons"))


@query
def schema_conforming(spark, sf_dir):
    return ev.schema_conforming(inputs.dirty_events(spark, sf_dir)).select("event_id", "event_type", "price")


@query
def on_time_events(spark, sf_dir):
    return ev.on_time_events(inputs.dirty_events(spark, sf_dir)).select("event_id", "session_id")


@query
def late_events(spark, sf_dir):
    return ev.late_events(inputs.dirty_events(spark, sf_dir)).select("event_id", "session_id", "late_arrival_delay_seconds")


@query
def late_by_threshold(spark, sf_dir):
    rows = ev.flag_late_by_threshold(inputs.raw_events(spark, sf_dir))
    return ev.late_events(rows).select("event_id", "event_type", "late_arrival_delay_seconds")


@query
def safe_price(spark, sf_dir):
    from tidemark.functions.money import safe_price as cleaned

    return inputs.dirty_events(spark, sf_dir).select("event_id", cleaned("price").alias("price"))


@query
def realtime_sessions_view(spark, sf_dir):
    rows = report.realtime_sessions_view(source.snapshot_text(spark, inputs.landed(spark, sf_dir, "snapshot")))
    return rows.withColumns({
        "session_start": F.try_to_timestamp("session_start"), "session_end": F.try_to_timestamp("session_end"),
    })


@query
def batch_sessions_view(spark, sf_dir):
    return report.batch_sessions_view(source.stored_sessions(spark, inputs.landed(spark, sf_dir, "sessions")))


@query
def payload_size_filter(spark, sf_dir):
    """Events whose JSON form stays below a limit that cuts this data."""
    rows = sink.raw_text(inputs.raw_events(spark, sf_dir)).withColumn("bytes", ev.payload_bytes(inputs.raw_events(spark, sf_dir)))
    return ev.within_payload_limit(rows, 315).select("event_id", "bytes")


@query
def late_annotated_events(spark, sf_dir):
    rows = ev.mark_late(inputs.raw_events(spark, sf_dir), fraction=0.08, seed=7)
    return rows.select("event_id", "is_late_arrival", "late_arrival_delay_seconds", "arrival_time")


@query
def hour_partitions(spark, sf_dir):
    rows = ev.with_hour_partitions(inputs.raw_events(spark, sf_dir))
    return rows.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("events"))


@query
def stable_event_ids(spark, sf_dir):
    rows = inputs.raw_events(spark, sf_dir)
    made = ev.stable_event_id("event_id", "event_type", "user_id", "category_code")
    return rows.select("event_id", made.alias("stable_id"))


@query
def sessions_by_user(spark, sf_dir):
    state = speed.speed_sessions(inputs.shop_events(spark, sf_dir))
    return speed.sessions_by_user(state, REPORT_USER).drop("event_types_seen", "conversion_time")


@query
def live_sessions(spark, sf_dir):
    state = speed.speed_sessions(inputs.shop_events(spark, sf_dir), with_user=False)
    as_of = F.lit(f"{REPORT_DAY} 12:00:00").cast("timestamp")
    return speed.live_sessions(state, as_of).select("session_id", "last_event_time", "event_count")


# --- duplicates --------------------------------------------------------------------
@query
def dedup_events(spark, sf_dir):
    """Each id delivered again by every fiftieth row, a day later."""
    from tidemark.functions.times import plus_seconds

    rows = inputs.raw_events(spark, sf_dir)
    again = rows.filter(F.col("event_id").cast("bigint") % 50 == 0).withColumn(
        "arrival_time", plus_seconds(F.col("arrival_time"), F.lit(86400)))
    return ev.dedup_events(again.unionByName(rows)).select("event_id", "arrival_time", "event_type", "price", "session_id")


@query
def union_all_events(spark, sf_dir):
    """Event store and late store as one, no late event twice."""
    rows = inputs.raw_events(spark, sf_dir)
    return ev.union_all_events(rows, ev.late_events(rows)).select("event_id", "is_late_arrival", "price")


# --- batch sessions ------------------------------------------------------------------
@query
def batch_sessions(spark, sf_dir):
    return stitch.batch_sessions(inputs.shop_events(spark, sf_dir))


@query
def nightly_sessions(spark, sf_dir):
    """The store of late and repeated deliveries, taken in eleven arrival days at a time."""
    raw, out = inputs.landed(spark, sf_dir, "delayed"), scratch_path(spark, "nightly")
    days = [d.isoformat() for d in stored_days(spark, raw)]
    for i in range(0, len(days), 11):
        state = nightly.run(spark, raw, out, days[i:i + 11], SIX_HOURS, outputs=False)
    return stitch.sessions_of(nightly.session_rows(state))


@query
def session_id_chunks(spark, sf_dir):
    """The ids of every session in bounded rows, small ones here."""
    chunks = stitch.session_id_chunks(inputs.shop_events(spark, sf_dir), 7 * 86400, chunk_ids=3)
    return chunks.groupBy("batch_session_id", "n_ids").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum(F.size("ids")).alias("ids_held"),
        F.array_sort(F.flatten(F.collect_list("ids"))).alias("ids"),
    ).withColumn("chunks", (F.col("chunks") <= F.ceil(F.col("n_ids") / 3)).cast("int"))


@query
def batch_sessions_6h(spark, sf_dir):
    return stitch.batch_sessions(inputs.shop_events(spark, sf_dir), SIX_HOURS)


@query
def batch_session_facts(spark, sf_dir):
    return stitch.batch_session_facts(inputs.shop_events(spark, sf_dir))


@query
def session_links(spark, sf_dir):
    return stitch.session_links(inputs.shop_events(spark, sf_dir), SIX_HOURS)


@query
def event_gaps(spark, sf_dir):
    return stitch.event_gaps(inputs.shop_events(spark, sf_dir)).select(
        "event_id", "user_id", "effective_time", "prev_event_time", "gap_seconds")


@query
def session_boundaries(spark, sf_dir):
    return stitch.session_boundaries(inputs.shop_events(spark, sf_dir), SIX_HOURS).select(
        "event_id", "user_id", "is_session_start")


@query
def sessionized_events(spark, sf_dir):
    return stitch.sessionized_events(inputs.shop_events(spark, sf_dir)).select(
        "event_id", "user_id", "user_session_seq", "batch_session_id", "is_session_start")


@query
def session_event_paths(spark, sf_dir):
    return stitch.session_event_paths(inputs.shop_events(spark, sf_dir))


@query
def session_window_sessions(spark, sf_dir):
    return stitch.session_window_sessions(inputs.shop_events(spark, sf_dir))


# --- speed sessions -------------------------------------------------------------------
@query
def speed_sessions(spark, sf_dir):
    return speed.speed_sessions(inputs.shop_events(spark, sf_dir))


@query
def closed_speed_sessions(spark, sf_dir):
    return speed.closed_speed_sessions(inputs.shop_events(spark, sf_dir))


@query
def cart_totals(spark, sf_dir):
    return speed.cart_totals(inputs.shop_events(spark, sf_dir))


@query
def cart_totals_with_removals(spark, sf_dir):
    """Cart value per user where the error events take something out."""
    rows = ev.add_effective_time(inputs.raw_events(spark, sf_dir))
    return speed.cart_totals(rows, "user_id", removal_types=("error",))


# --- reconciliation --------------------------------------------------------------------
def _sides(spark, sf_dir, timeout):
    """Links and speed sessions, each stored once, as the jobs have them."""
    rows = inputs.shop_events(spark, sf_dir)
    links = stored(stitch.session_links(rows, timeout), "links")
    return links, stored(speed.speed_sessions(rows, timeout, with_user=False), "speed"), links


def _deltas(spark, sf_dir, timeout=1800, **options):
    links, state, ids = _sides(spark, sf_dir, timeout)
    return reconcile.session_deltas(links, state, ids, **options)


def _audit(spark, sf_dir, timeout=1800):
    links, state, ids = _sides(spark, sf_dir, timeout)
    return reconcile.restatement_audit(state, links, ids)


@query
def restatement_audit(spark, sf_dir):
    return _audit(spark, sf_dir)


@query
def restatement_audit_6h(spark, sf_dir):
    return _audit(spark, sf_dir, SIX_HOURS)


@query
def session_deltas(spark, sf_dir):
    return _deltas(spark, sf_dir)


@query
def session_deltas_6h(spark, sf_dir):
    return _deltas(spark, sf_dir, SIX_HOURS)


@query
def session_deltas_flip_first(spark, sf_dir):
    return _deltas(spark, sf_dir, SIX_HOURS, flip_first=True).select(
        "session_id", "batch_session_id", "conversion_flipped", "restatement_type")


@query
def restatement_stats(spark, sf_dir):
    return reconcile.restatement_stats(_deltas(spark, sf_dir))


@query
def restatement_stats_6h(spark, sf_dir):
    return reconcile.restatement_stats(_deltas(spark, sf_dir, SIX_HOURS))


@query
def restatement_breakdown(spark, sf_dir):
    return reconcile.restatement_breakdown(_deltas(spark, sf_dir))


@query
def restatement_breakdown_6h(spark, sf_dir):
    return reconcile.restatement_breakdown(_deltas(spark, sf_dir, SIX_HOURS))


@query
def top_restated(spark, sf_dir):
    return reconcile.top_restated(_deltas(spark, sf_dir))


@query
def restatement_detail(spark, sf_dir):
    links, state, _ = _sides(spark, sf_dir, 1800)
    return reconcile.restatement_detail(links, state)


@query
def restatement_detail_of_day(spark, sf_dir):
    links, state, _ = _sides(spark, sf_dir, 1800)
    return reconcile.restatement_detail(links, state, REPORT_DAY)


@query
def audit_totals(spark, sf_dir):
    return reconcile.audit_totals(_audit(spark, sf_dir))


@query
def audit_totals_of_day(spark, sf_dir):
    return reconcile.audit_totals(_audit(spark, sf_dir), REPORT_DAY)


@query
def late_event_match(spark, sf_dir):
    return reconcile.late_event_match(inputs.shop_events(spark, sf_dir))


# --- reports ---------------------------------------------------------------------------
def _layers(spark, sf_dir):
    rows = inputs.shop_events(spark, sf_dir)
    return speed.speed_sessions(rows, with_user=False), stitch.batch_session_facts(rows)


@query
def speed_summary(spark, sf_dir):
    return report.speed_summary(_layers(spark, sf_dir)[0])


@query
def batch_summary(spark, sf_dir):
    return report.batch_summary(_layers(spark, sf_dir)[1])


@query
def accuracy_comparison(spark, sf_dir):
    return report.accuracy_comparison(*_layers(spark, sf_dir))


@query
def speed_totals(spark, sf_dir):
    return report.speed_totals(_layers(spark, sf_dir)[0], REPORT_DAY)


@query
def batch_totals(spark, sf_dir):
    return report.batch_totals(_layers(spark, sf_dir)[1], REPORT_DAY)


@query
def metric_comparison(spark, sf_dir):
    fast, whole = _layers(spark, sf_dir)
    return report.metric_comparison(report.speed_totals(fast, REPORT_DAY), report.batch_totals(whole, REPORT_DAY))


@query
def report_metrics(spark, sf_dir):
    fast, whole = _layers(spark, sf_dir)
    return report.report_metrics(
        report.speed_totals(fast, REPORT_DAY), report.batch_totals(whole, REPORT_DAY),
        reconcile.restatement_stats(_deltas(spark, sf_dir).filter(F.col("batch_session_date") == F.lit(REPORT_DAY).cast("date"))),
    )


# --- health ------------------------------------------------------------------------------
@query
def late_rate_by_hour(spark, sf_dir):
    return health.late_rate_by_hour(inputs.raw_events(spark, sf_dir))


def _line_outcomes(spark, sf_dir):
    lines = quarantine.parse_lines(inputs.outcome_lines(spark, sf_dir))
    return lines.select(F.col("arrived").alias("arrival_time"), F.col("late").alias("is_late_arrival"), "malformed")


@query
def throughput_by_window(spark, sf_dir):
    return health.throughput_by_window(_line_outcomes(spark, sf_dir))


@query
def lag_by_minute(spark, sf_dir):
    return health.lag_by_minute(ev.add_effective_time(inputs.raw_events(spark, sf_dir)))


@query
def lag_alarm(spark, sf_dir):
    """Alarm where three minutes in a row had a lag above the limit."""
    rows = ev.add_effective_time(inputs.raw_events(spark, sf_dir))
    return health.lag_alarm(health.lag_by_minute(rows), limit_ms=999)


@query
def error_rate_alarm(spark, sf_dir):
    return health.error_rate_alarm(_line_outcomes(spark, sf_dir), minutes=1)


@query
def error_rate_alarm_five(spark, sf_dir):
    """Five minutes in a row, on a clock where six hours are a minute, so that minutes are full."""
    rows = _line_outcomes(spark, sf_dir)
    quick = F.timestamp_seconds(F.floor(F.unix_seconds("arrival_time") / 21600) * 60)
    return health.error_rate_alarm(rows.withColumn("arrival_time", quick), limit_pct=0.5)


# --- streams -------------------------------------------------------------------------------
def _drained(stream) -> None:
    """Wait for a bounded run; a failure of the query is raised here."""
    stream.awaitTermination()


def _shop_stream(spark, sf_dir):
    rows = file_events(spark, inputs.landed(spark, sf_dir, "events"))
    return ev.timed_events(ev.valid_events(ev.canonical_events(rows)))


def _state_history(spark, sf_dir):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    path = scratch_path(spark, "state")
    _drained(state_table.start_upserts(
        sessionizer.session_updates(_shop_stream(spark, sf_dir)), path, scratch_path(spark, "state-cp"),
        available_now=True))
    return state_table.state_changes(spark, path)


@query
def stream_session_state(spark, sf_dir):
    """State table after a bounded replay of the event store."""
    rows = state_table.latest_state(_state_history(spark, sf_dir))
    return rows.drop("status", "batch_id").withColumn("event_types_seen", F.array_sort("event_types_seen"))


@query
def state_after_compaction(spark, sf_dir):
    """The state read from its base and the batches behind it, compacted every second batch."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    path = scratch_path(spark, "state")
    rows = file_events(spark, inputs.landed(spark, sf_dir, "arrivals"), fmt="parquet", max_files=1)
    events = ev.timed_events(ev.valid_events(ev.canonical_events(rows)))
    _drained(state_table.start_upserts(
        sessionizer.session_updates(events), path, scratch_path(spark, "state-cp"), available_now=True, compact_every=2))
    rows = state_table.current_state(spark, path)
    return rows.drop("status", "batch_id").withColumn("event_types_seen", F.array_sort("event_types_seen"))


@query
def stream_closed_sessions(spark, sf_dir):
    rows = state_table.closed_rows(_state_history(spark, sf_dir))
    return rows.select("session_id", "session_start", "last_event_time", "event_count", "cart_total", "converted")


@query
def stream_window_sessions(spark, sf_dir):
    """Gap sessions the watermark has closed at the end of the replay."""
    path = scratch_path(spark, "windows")
    _drained(
        windows.closed_window_sessions(_shop_stream(spark, sf_dir)).writeStream.format("parquet")
        .option("path", path).option("checkpointLocation", scratch_path(spark, "windows-cp"))
        .outputMode("append").trigger(availableNow=True).start())
    return spark.read.parquet(path)


@query
def stream_dedup(spark, sf_dir):
    """Each event delivered twice on the stream, kept once."""
    rows = _shop_stream(spark, sf_dir)
    twice = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    path = scratch_path(spark, "dedup")
    _drained(
        windows.dedup_stream(twice).select("event_id", "event_type", "price", "session_id")
        .writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", scratch_path(spark, "dedup-cp"))
        .outputMode("append").trigger(availableNow=True).start())
    return spark.read.parquet(path)


@query
def stream_routing(spark, sf_dir):
    """Rows per target after routing the lines of the stream."""
    root = scratch_path(spark, "routed")
    lines = file_lines(spark, inputs.landed(spark, sf_dir, "lines"))
    _drained(start_routing(lines, root, scratch_path(spark, "routed-cp"), available_now=True))

    def counted(name, rows):
        return rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("target"), "rows")

    return counted("events", source.readable(source.raw_events(spark, f"{root}/events"))).unionByName(
        counted("late-arrivals", source.readable(source.raw_events(spark, f"{root}/late-arrivals")))
    ).unionByName(counted("quarantine", spark.read.json(f"{root}/quarantine")))


@query
def stream_cart_counters(spark, sf_dir):
    path = scratch_path(spark, "carts")
    _drained(state_table.start_upserts(
        state_table.cart_counters(_shop_stream(spark, sf_dir)), path, scratch_path(spark, "carts-cp"),
        available_now=True))
    rows = state_table.latest_rows(state_table.state_changes(spark, path), "session_id", ("batch_id",))
    return rows.select("session_id", "cart_total", "event_count")


@query
def stream_interval_trigger(spark, sf_dir):
    """Routing on the five-second trigger, stopped when all lines are through."""
    root = scratch_path(spark, "routed")
    lines = file_lines(spark, inputs.landed(spark, sf_dir, "lines"))
    stream = start_routing(lines, root, scratch_path(spark, "routed-cp"))
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    return source.readable(source.raw_events(spark, f"{root}/events")).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("batch_id").alias("batches")).withColumn("batches", (F.col("batches") > 0).cast("int"))


@query
def stream_batch_counts(spark, sf_dir):
    """Counters that came with the progress of each micro-batch, added up."""
    rows = file_events(spark, inputs.landed(spark, sf_dir, "arrivals"), fmt="parquet", max_files=1)
    stream = counted(ev.canonical_events(rows)).writeStream.format("noop") \
        .option("checkpointLocation", scratch_path(spark, "counts-cp")).trigger(availableNow=True).start()
    _drained(stream)
    seen = [p.observedMetrics["batch"].asDict() for p in stream.recentProgress if "batch" in p.observedMetrics]
    totals = {k: sum(s[k] or 0 for s in seen) for k in ("processed", "late_arrivals", "errors")}
    return spark.createDataFrame([tuple(totals.values())], "processed long, late_arrivals long, errors long")


@query
def stream_behind_watermark(spark, sf_dir):
    """Rows that came too late for the stream, and how many were in time."""
    root = scratch_path(spark, "split")
    rows = file_events(spark, inputs.landed(spark, sf_dir, "slow-arrivals"), fmt="parquet", max_files=1)
    _drained(behind.start_split(ev.timed_events(ev.canonical_events(rows)), root, scratch_path(spark, "split-cp"), available_now=True))
    late = spark.read.parquet(f"{root}/behind").select("event_id", F.lit("behind").alias("side"), F.lit(1).cast("bigint").alias("rows"))
    return late.unionByName(spark.read.parquet(f"{root}/in-time").groupBy(F.lit("in-time").alias("side")).agg(
        F.lit("").alias("event_id"), F.count(F.lit(1)).alias("rows")))


# --- written through a sink or job, and read back ---------------------------------------------
@query
def large_amounts(spark, sf_dir):
    """Totals per day where single amounts have seventeen digits."""
    return report.batch_summary(stitch.batch_sessions(inputs.large_events(spark, sf_dir)))


@query
def large_restatements(spark, sf_dir):
    rows = inputs.large_events(spark, sf_dir)
    links = stored(stitch.session_links(rows), "links")
    state = stored(speed.speed_sessions(rows, with_user=False), "speed")
    return reconcile.restatement_breakdown(reconcile.session_deltas(links, state, links))


@query
def stored_audit(spark, sf_dir):
    """Totals asked of the stored simple audit of one day."""
    base, day = scratch_path(spark, "sessions"), F.lit(REPORT_DAY).cast("date")
    sink.write_audit(_audit(spark, sf_dir).where(F.col("batch_session_date") == day), base, REPORT_DAY)
    return reconcile.audit_totals(spark.read.parquet(source.day_path(f"{base}-audit", REPORT_DAY)))


@query
def stored_detail(spark, sf_dir):
    base, day = scratch_path(spark, "detail"), F.lit(REPORT_DAY).cast("date")
    sink.write_restatement_detail(_deltas(spark, sf_dir).where(F.col("batch_session_date") == day), base, REPORT_DAY)
    return reconcile.restatement_breakdown(spark.read.parquet(source.day_path(base, REPORT_DAY)))


@query
def stored_summary(spark, sf_dir):
    base, stats = scratch_path(spark, "audit"), reconcile.restatement_stats(_deltas(spark, sf_dir))
    sink.write_summary(stats, base, REPORT_DAY)
    return spark.read.schema(stats.schema).json(source.day_path(f"{base}-summary", REPORT_DAY))


@query
def stored_parquet(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    sink.write_parquet(inputs.shop_events(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("price").cast("decimal(18,4)")).cast("double").alias("value"), F.max("effective_time").alias("last"))


@query
def columnar_store(spark, sf_dir):
    """Hour folders in columnar form, every required member filled."""
    path = scratch_path(spark, "columnar")
    sink.write_events(inputs.raw_events(spark, sf_dir).withColumn(
        "price", F.when(F.col("event_id").cast("bigint") % 3 > 0, F.col("price"))), path, fmt="parquet")
    return source.raw_events_parquet(spark, path).groupBy("year", "month", "day", "event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("price") == 0).alias("without_price"), F.count_if("is_late_arrival").alias("late"),
        F.count("brand").alias("branded"), F.sum("late_arrival_delay_seconds").alias("delay"))


def _catalog(spark, root, name, **options):
    database = f"shop_{root[-12:]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/database'")
    tables.create_table(spark, name, root, database, **options)
    return spark.table(f"{database}.{name}")


@query
def raw_events_table(spark, sf_dir):
    """The event store asked through the catalog, one day by its partition columns."""
    root = scratch_path(spark, "catalog")
    sink.write_events(inputs.raw_events(spark, sf_dir), f"{root}/events")
    rows = _catalog(spark, root, "raw_events").where(on_day(F.lit(REPORT_DAY)))
    return rows.groupBy("hour", "event_type").agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_late_arrival").alias("late"))


@query
def raw_events_projected(spark, sf_dir):
    """The same store with its partitions named from a range, which has days the store lacks."""
    root = scratch_path(spark, "catalog")
    sink.write_events(inputs.raw_events(spark, sf_dir), f"{root}/events")
    by_table = _catalog(spark, root, "raw_events", days=("2023-12-30", "2024-02-03")).groupBy("month", "day").agg(F.count(F.lit(1)).alias("rows"))
    by_path = source.events_between(spark, f"{root}/events", "2023-12-30", "2024-02-03").groupBy("month", "day").agg(F.count(F.lit(1)).alias("by_path"))
    return by_table.join(by_path, ["month", "day"], "full")


@query
def batch_sessions_table(spark, sf_dir):
    root = scratch_path(spark, "catalog")
    rows = ev.with_day_partitions(stitch.batch_sessions(inputs.shop_events(spark, sf_dir)), "session_start")
    rows.hint("rebalance", "year", "month", "day").write.partitionBy("year", "month", "day").parquet(f"{root}/sessions")
    return report.batch_summary(_catalog(spark, root, "batch_sessions"))


@query
def snapshot_table(spark, sf_dir):
    root = scratch_path(spark, "catalog")
    sink.write_snapshot(speed.speed_sessions(inputs.shop_events(spark, sf_dir)), f"{root}/realtime-sessions")
    return report.speed_summary(report.realtime_sessions_view(_catalog(spark, root, "realtime_sessions_raw")))


@query
def audit_table(spark, sf_dir):
    root = scratch_path(spark, "catalog")
    rows = ev.with_day_partitions(_deltas(spark, sf_dir).where("batch_session_date IS NOT NULL"), "batch_session_date")
    columns = [f.name for f in tables.RESTATEMENT_AUDIT.fields]
    rows.select(*columns, "year", "month", "day").write.partitionBy("year", "month", "day").parquet(f"{root}/restatement-audit")
    kept = _catalog(spark, root, "restatement_audit")
    return kept.groupBy("year", "month", "day", "restatement_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_count_delta").alias("events"), F.count_if("conversion_flipped").alias("flipped"))


# --- small operators -----------------------------------------------------------------------------
@query
def unknown_sessions(spark, sf_dir):
    rows = inputs.shop_events(spark, sf_dir).withColumn("session_id", F.when(F.col("event_id").cast("bigint") % 127 > 0, F.col("session_id")))
    return ev.unknown_session_filled(rows).groupBy("session_id").agg(F.count(F.lit(1)).alias("rows"))


@query
def date_parts(spark, sf_dir):
    """Year, month and day out of a text, some of which are none."""
    text = F.when(F.col("event_id").cast("bigint") % 31 == 0, F.lit("no-date")).otherwise(F.date_format("arrival_time", "yyyy-MM-dd"))
    return inputs.raw_events(spark, sf_dir).withColumn("text", text).select(
        "event_id", *[date_part(F.col("text"), i).alias(name) for i, name in enumerate(("year", "month", "day"), 1)])


@query
def lenient_numbers(spark, sf_dir):
    text = F.when(F.col("event_id").cast("bigint") % 7 == 0, F.lit("n/a")).when(F.col("event_id").cast("bigint") % 11 > 0, F.col("product_id"))
    return inputs.raw_events(spark, sf_dir).select("event_id", lenient_number(text).alias("number"))


@query
def nested_decimals(spark, sf_dir):
    """Every price in arrays, maps and structs as a decimal."""
    price = F.col("price")
    nested = inputs.raw_events(spark, sf_dir).select(
        "event_id", F.array(price, F.lit(None), F.lit(float("nan"))).alias("listed"), F.create_map(F.col("event_type"), price).alias("by_type"),
        F.struct(price.alias("own"), F.array(F.struct(price.alias("inner"), F.col("user_id"))).alias("parts")).alias("row"))
    return decimals_in(nested).select(
        "event_id", F.array_join(F.transform("listed", lambda x: x.cast("string")), ",", "-").alias("listed"),
        F.map_values("by_type")[0].cast("string").alias("by_type"), F.col("row.own").cast("string").alias("own"),
        F.col("row.parts")[0]["inner"].cast("string").alias("inner"), F.col("row.parts")[0]["user_id"].alias("user_id"))
