"""The supplied ``events`` table as shop events.

view, click and purchase become view, cart and purchase; the other two types
stay outside the event domain and exercise the filters. The oracle repeats
these expressions in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import plus_seconds
from tidemark.operators import events as ev
from tidemark.schemas import RAW_EVENT
from tidemark.session import scratch_path
from tidemark.sinks import files as sink

SIX_HOURS = 21600
ROW_GROUP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows in the raw layout, times typed."""
    late = "(event_id * 7919 + 13) % 100 < 5"
    delay = f"CASE WHEN {late} THEN 120 + (event_id * 104729 + 7) % 781 END"
    number = "get_json_object(props, '$.k')"
    return table(spark, sf_dir, "events").withColumn("at", F.expr("CAST(ts AS timestamp)")).selectExpr(
        "CAST(event_id AS string) AS event_id",
        "at AS event_time",
        f"timestamp_micros(unix_micros(at) + coalesce({delay}, 1) * 1000000) AS arrival_time",
        "CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type",
        f"{number} AS product_id",
        f"CAST(CAST({number} AS int) % 10 AS string) AS category_id",
        "CAST(NULL AS string) AS category_code",
        f"CASE WHEN CAST({number} AS int) % 7 <> 0 THEN concat('brand', {number}) END AS brand",
        "value AS price",
        "CAST(user_id AS string) AS user_id",
        f"concat('s', user_id, '_', CAST(floor(unix_seconds(at) / {SIX_HOURS}) AS string)) AS session_id",
        f"{late} AS is_late_arrival",
        f"CAST({delay} AS bigint) AS late_arrival_delay_seconds",
    )


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events in the domain."""
    return ev.timed_events(ev.valid_events(ev.canonical_events(raw_events(spark, sf_dir))))


def _text_id() -> Column:
    """An identifier of the contract's form, from the row's number."""
    digest = F.md5(F.col("event_id"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def _dirty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows in raw text form, with faults planted by row number."""
    number = F.col("number")

    def every(n: int) -> Column:
        return number % n == 0

    rows = sink.raw_text(raw_events(spark, sf_dir)).withColumn("number", F.col("event_id").cast("bigint"))
    return rows.withColumns({
        "event_id": F.when(every(211), F.col("event_id")).otherwise(_text_id()),
        "event_time": F.when(every(89), F.lit("no time")).when(~every(83), F.col("event_time")),
        "event_type": F.when(every(5), F.concat(F.lit("  "), F.upper("event_type"), F.lit(" ")))
        .otherwise(F.col("event_type")),
        "product_id": F.when(~every(109), F.col("product_id")),
        "brand": F.when(every(3), F.lit("NaN")).otherwise(F.col("brand")),
        "price": F.when(every(101), F.lit(None)).when(every(103), F.lit(float("nan")))
        .when(every(107), -F.col("price")).otherwise(F.col("price")),
        "user_id": F.when(~every(113), F.col("user_id")),
        "session_id": F.when(~every(127), F.col("session_id")),
        "is_late_arrival": F.when(~every(131), F.col("is_late_arrival")),
        "late_arrival_delay_seconds": F.when(every(137), F.lit(-1).cast("bigint"))
        .otherwise(F.col("late_arrival_delay_seconds")),
    }).drop("number")


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(RAW_EVENT).parquet(landed(spark, sf_dir, "dirty"))


def _wire_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows as JSON text with their arrival time; some lines are broken.
    With them the same as records of a stream, some of which are no base64."""
    rows = raw_events(spark, sf_dir)
    text = sink.raw_text(rows)
    broken = F.col("event_id").cast("bigint") % 97 == 0
    line = F.to_json(F.struct(*text.columns), {"ignoreNullFields": "false"})
    lines = text.select(
        F.when(broken, F.concat(F.lit("NOT JSON {{{"), F.col("event_id"))).otherwise(line).alias("value"),
        F.try_to_timestamp("arrival_time").alias("arrival_time"),
        "is_late_arrival",
        F.col("event_id").cast("bigint").alias("number"),
    )
    return lines.select(
        "*",
        F.when(F.col("number") % 59 == 0, F.concat(F.lit("!!not base64!!"), F.col("number").cast("string")))
        .otherwise(F.base64(F.encode("value", "UTF-8"))).alias("data"),
        F.concat(F.lit("seq"), F.col("number").cast("string")).alias("sequence"),
        (F.unix_micros("arrival_time") / 1e6).alias("arrival"),
    )


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(landed(spark, sf_dir, "wire"))


def outcome_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines under the time they arrived, which a broken line has as well."""
    return wire(spark, sf_dir).select("value", F.col("arrival_time").alias("arrived"),
                                      F.col("is_late_arrival").alias("late"))


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire(spark, sf_dir).select("data", "sequence", "arrival", "number")


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(landed(spark, sf_dir, "letters"))


def _letter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of up to four records; some only name a batch, some are
    broken text."""
    records = stream_records(spark, sf_dir).withColumn("letter", F.floor(F.col("number") / 4))
    one = F.struct(F.struct(
        F.col("sequence").alias("sequenceNumber"), "data", F.col("arrival").alias("approximateArrivalTimestamp"),
    ).alias("kinesis"))
    letters = records.groupBy("letter").agg(F.collect_list(one).alias("Records"))
    body = (
        F.when(F.col("letter") % 31 == 0, F.lit("NOT JSON {{{"))
        .when(F.col("letter") % 29 == 0, F.to_json(F.struct(F.struct(
            F.lit("shard-0").alias("shardId"), F.col("letter").cast("string").alias("startSequenceNumber"),
            F.col("letter").cast("string").alias("endSequenceNumber"), F.lit(4).cast("bigint").alias("batchSize"),
            F.lit("events").alias("streamArn"),
        ).alias("KinesisBatchInfo"), F.struct(F.lit("RetryAttemptsExhausted").alias("condition"))
            .alias("requestContext"))))
        .otherwise(F.to_json(F.struct("Records")))
    )
    return letters.select(F.concat(F.lit("m"), F.col("letter").cast("string")).alias("message_id"), body.alias("body"))


def typed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed sessions as typed JSON items."""
    from tidemark.operators.speed import speed_sessions

    state = speed_sessions(shop_events(spark, sf_dir))

    def typed(mark: str, value: Column) -> Column:
        return F.struct(value.alias(mark))

    item = F.struct(
        typed("S", F.col("session_id")).alias("session_id"),
        typed("S", F.col("user_id")).alias("user_id"),
        typed("N", F.col("event_count").cast("string")).alias("event_count"),
        typed("N", F.col("cart_total").cast("decimal(18,2)").cast("string")).alias("cart_total"),
        typed("BOOL", F.col("converted")).alias("converted"),
        typed("L", F.transform("event_types_seen", lambda t: F.struct(t.alias("S")))).alias("event_types_seen"),
    )
    return state.select(F.to_json(item).alias("item"))


# --- stored forms, written once per session and folder ------------------------
_landed: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Path of the supplied events in one of the stored layouts."""
    slot = (spark.sparkContext.applicationId, sf_dir, kind)
    if slot not in _landed:
        path = scratch_path(spark, kind)
        _WRITERS[kind](spark, sf_dir, path)
        _landed[slot] = path
    return _landed[slot]


def _by_arrival(rows: DataFrame) -> DataFrame:
    """Rows in arrival order over several tasks, as a stream delivers them."""
    return rows.repartitionByRange(16, "arrival_time")


def _land_events(spark: SparkSession, sf_dir: str, path: str) -> None:
    sink.write_events(_by_arrival(raw_events(spark, sf_dir)), path)


def _land_delayed(spark: SparkSession, sf_dir: str, path: str) -> None:
    """As a store looks after weeks: every 29th event came three days late (a replayed
    dead letter), every 50th was delivered again a day later."""
    late, number = slow_events(spark, sf_dir), F.col("event_id").cast("bigint")
    again = late.where(number % 50 == 0).withColumn("arrival_time", plus_seconds(F.col("arrival_time"), F.lit(86400)))
    sink.write_events(_by_arrival(late.unionByName(again)), path)


def _land_late(spark: SparkSession, sf_dir: str, path: str) -> None:
    sink.write_events(_by_arrival(ev.late_events(raw_events(spark, sf_dir))), path)


def _land_lines(spark: SparkSession, sf_dir: str, path: str) -> None:
    _by_arrival(wire(spark, sf_dir)).select("value").write.text(path)


def _land_columnar(spark: SparkSession, sf_dir: str, path: str) -> None:
    sink.columnar_text(raw_events(spark, sf_dir)).write.parquet(path)


def _in_steps(rows: DataFrame, path: str, files: int = 5) -> None:
    """Files that hold equal spans of arrival time, written one after the other: as
    many micro-batches of a stream. All tasks prepare a file's rows, which one only
    writes, in row groups that several tasks can read."""
    at = F.unix_micros(F.col("arrival_time").cast("timestamp"))
    low, high = rows.agg(F.min(at), F.max(at)).first()
    step = (high - low) // files + 1
    for i in range(files):
        part = rows.where((at >= low + i * step) & (at < low + (i + 1) * step))
        sink.raw_text(part).repartition(1).write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def _land_arrivals(spark: SparkSession, sf_dir: str, path: str) -> None:
    _in_steps(raw_events(spark, sf_dir), path)


def _land_slow_arrivals(spark: SparkSession, sf_dir: str, path: str) -> None:
    _in_steps(slow_events(spark, sf_dir), path)


def slow_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows; every 29th came three days late (a replayed dead letter)."""
    rows, slow = raw_events(spark, sf_dir), F.col("event_id").cast("bigint") % 29 == 0
    late = plus_seconds(F.col("arrival_time"), F.lit(3 * 86400))
    return rows.withColumn("arrival_time", F.when(slow, late).otherwise(F.col("arrival_time")))


def large_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop events of which every hundredth costs 10^16 and more, the others nothing."""
    number = F.col("event_id").cast("bigint")
    return shop_events(spark, sf_dir).withColumn("price", F.when(number % 100 == 0, (number % 3 + 1) * F.lit(1e16)).otherwise(0.0))


def _land_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    shop_log(spark, sf_dir).write.option("header", True).csv(path)


def shop_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shop log as its CSV has it: text times in UTC to the second."""
    return raw_events(spark, sf_dir).select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss 'UTC'").alias("event_time"),
        "event_type", "product_id", "category_id", "category_code", "brand",
        F.col("price").cast("string").alias("price"), "user_id", F.col("session_id").alias("user_session"),
    )


def _land_snapshot(spark: SparkSession, sf_dir: str, path: str) -> None:
    from tidemark.operators.speed import speed_sessions

    sink.write_snapshot(speed_sessions(shop_events(spark, sf_dir)), path)


def _land_sessions(spark: SparkSession, sf_dir: str, path: str) -> None:
    from tidemark.operators.stitch import batch_sessions

    rows = ev.with_day_partitions(batch_sessions(shop_events(spark, sf_dir)), "session_start")
    rows.hint("rebalance", "year", "month", "day").write.partitionBy("year", "month", "day").parquet(path)


def _land_two_layouts(spark: SparkSession, sf_dir: str, path: str) -> None:
    """On-time rows in an older layout without brand and delay, late rows in
    the full one."""
    rows = sink.raw_text(raw_events(spark, sf_dir))
    ev.on_time_events(rows).drop("brand", "late_arrival_delay_seconds").write.parquet(f"{path}/layout=1")
    ev.late_events(rows).write.parquet(f"{path}/layout=2")


def _land_dirty(spark: SparkSession, sf_dir: str, path: str) -> None:
    _dirty_rows(spark, sf_dir).write.parquet(path)


def _land_wire(spark: SparkSession, sf_dir: str, path: str) -> None:
    _wire_rows(spark, sf_dir).write.parquet(path)


def _land_letters(spark: SparkSession, sf_dir: str, path: str) -> None:
    _letter_rows(spark, sf_dir).write.parquet(path)


_WRITERS = {
    "dirty": _land_dirty,
    "wire": _land_wire,
    "letters": _land_letters,
    "events": _land_events,
    "delayed": _land_delayed,
    "late-arrivals": _land_late,
    "lines": _land_lines,
    "columnar": _land_columnar,
    "shop-csv": _land_csv,
    "arrivals": _land_arrivals,
    "slow-arrivals": _land_slow_arrivals,
    "snapshot": _land_snapshot,
    "sessions": _land_sessions,
    "two-layouts": _land_two_layouts,
}
