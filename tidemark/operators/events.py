"""Event-level operators: one row in, at most one row out, no shuffle
except for the removal of duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import has_no_decimal, safe_price_sql
from tidemark.functions.times import (
    effective_time,
    parse_time,
    plus_seconds,
    seconds_between,
)
from tidemark.schemas import (
    CSV_MISSING,
    EVENT_TYPES,
    LATE_DELAY_MAX_SECONDS,
    LATE_DELAY_MIN_SECONDS,
    LATE_FRACTION,
    LATE_THRESHOLD_SECONDS,
    MAX_PAYLOAD_BYTES,
    RAW_EVENT,
    UNKNOWN_SESSION,
)


# A text that is one of the missing-value spellings of a CSV reader.
_MISSING_TEXTS = ", ".join(f"'{text}'" for text in CSV_MISSING)
_DOMAIN = ", ".join(f"'{kind}'" for kind in EVENT_TYPES)


def _text_or_null(column: str) -> str:
    return f"CASE WHEN CAST({column} AS string) NOT IN ({_MISSING_TEXTS}) THEN CAST({column} AS string) END"


def keep_event_domain(df: DataFrame) -> DataFrame:
    """Event types trimmed and lower-cased; rows of any other type dropped."""
    return df.withColumn("event_type", F.expr("lower(trim(event_type))")).filter(f"event_type IN ({_DOMAIN})")


def stable_event_id(*columns: str) -> Column:
    """Event id from the row's content, the same again when a task is retried."""
    parts = ", ".join(f"coalesce(CAST({c} AS string), '')" for c in columns)
    return F.expr(f"sha2(concat_ws('|', {parts}), 256)")


def canonical_events(df: DataFrame) -> DataFrame:
    """Raw or shop-log rows to the typed 13-column layout plus ``effective_time``.

    ``user_session`` is taken for ``session_id``. Rows outside the event domain
    are dropped. Columns the source lacks come out null (flags: false).
    """
    session = "session_id" if "session_id" in df.columns else "user_session"
    arrival = "arrival_time" if "arrival_time" in df.columns else "event_time"
    rows = keep_event_domain(df)
    if "event_id" not in df.columns:
        made_from = ("event_time", "event_type", "product_id", "price", "user_id", session)
        rows = rows.withColumn("event_id", stable_event_id(*made_from))

    def optional(name: str, expression: str) -> str:
        return f"{expression if name in df.columns else 'NULL'}"

    rows = rows.selectExpr(
        "CAST(event_id AS string) AS event_id",
        "try_to_timestamp(event_time) AS event_time",
        f"try_to_timestamp({arrival}) AS arrival_time",
        "event_type",
        "CAST(product_id AS string) AS product_id",
        f"nullif(CAST({optional('category_id', _text_or_null('category_id'))} AS string), '0') AS category_id",
        f"CAST({optional('category_code', _text_or_null('category_code'))} AS string) AS category_code",
        f"CAST({optional('brand', _text_or_null('brand'))} AS string) AS brand",
        f"{safe_price_sql('price')} AS price",
        "CAST(user_id AS string) AS user_id",
        f"CAST({session} AS string) AS session_id",
        f"coalesce(CAST({optional('is_late_arrival', 'is_late_arrival')} AS boolean), false) AS is_late_arrival",
        f"CAST({optional('late_arrival_delay_seconds', 'late_arrival_delay_seconds')} AS bigint)"
        " AS late_arrival_delay_seconds",
    )
    return add_effective_time(rows)


def add_effective_time(df: DataFrame) -> DataFrame:
    return df.withColumn("effective_time", effective_time(F.col("event_time"), F.col("arrival_time")))


def valid_events(df: DataFrame) -> DataFrame:
    """Rows with a user and a session id."""
    return df.filter(F.col("user_id").isNotNull() & F.col("session_id").isNotNull())


def timed_events(df: DataFrame) -> DataFrame:
    """Rows whose effective time is known; the rest belongs in quarantine."""
    return df.filter(F.col("effective_time").isNotNull())


def observed_valid_events(df: DataFrame, name: str) -> DataFrame:
    """:func:`valid_events`, with the counts delivered by the action that reads
    the result (``Observation`` in batch, query progress on a stream)."""
    missing = F.col("user_id").isNull() | F.col("session_id").isNull()
    return valid_events(df.observe(
        name, F.count(F.lit(1)).alias("total"), F.count_if(missing).alias("dropped"),
    ))


def invalid_event_counts(df: DataFrame) -> DataFrame:
    """One row: how many rows there are and how many lack a user or session id."""
    no_user, no_session = F.col("user_id").isNull(), F.col("session_id").isNull()
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(no_user).alias("without_user"),
        F.count_if(no_session).alias("without_session"),
        F.count_if(no_user | no_session).alias("dropped"),
    )


# --- rules of the event contract --------------------------------------------
# The identifier pattern of the event contract.
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def violation_reasons(df: DataFrame, check_formats: bool = True) -> Column:
    """Array of the rules a raw event breaks, in a fixed order; empty when fine."""
    required = (
        "event_id", "arrival_time", "event_type", "product_id", "price",
        "user_id", "session_id", "is_late_arrival",
    )
    rules = [(f"{name}_missing", F.col(name).isNull()) for name in required]
    rules += [
        ("event_type_unknown", ~F.col("event_type").isin(*EVENT_TYPES)),
        ("price_not_a_number", F.isnan("price")),
        ("price_negative", F.col("price") < 0),
        ("price_too_large", has_no_decimal()),
        ("delay_negative", F.col("late_arrival_delay_seconds") < 0),
    ]
    if check_formats:
        rules += [
            ("event_id_format", ~F.col("event_id").rlike(UUID_PATTERN)),
            ("event_time_format", F.col("event_time").isNotNull() & parse_time(F.col("event_time")).isNull()),
            ("arrival_time_format", F.col("arrival_time").isNotNull() & parse_time(F.col("arrival_time")).isNull()),
        ]
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def schema_violations(df: DataFrame, check_formats: bool = True) -> DataFrame:
    """Quarantine side of the contract: the broken rows with their reasons."""
    return df.withColumn("reasons", violation_reasons(df, check_formats)).filter(F.size("reasons") > 0)


def schema_conforming(df: DataFrame, check_formats: bool = True) -> DataFrame:
    return df.filter(F.size(violation_reasons(df, check_formats)) == 0)


# --- late events -------------------------------------------------------------
def is_late(column: str = "is_late_arrival") -> Column:
    return F.coalesce(F.col(column), F.lit(False))


def on_time_events(df: DataFrame) -> DataFrame:
    return df.filter(~is_late())


def late_events(df: DataFrame) -> DataFrame:
    return df.filter(is_late())


def flag_late_by_threshold(df: DataFrame, threshold_seconds: int = LATE_THRESHOLD_SECONDS) -> DataFrame:
    """Late = arrived more than the threshold after it happened."""
    lag = seconds_between(parse_time(F.col("arrival_time")), parse_time(F.col("event_time")))
    return df.withColumn("is_late_arrival", F.coalesce(lag > threshold_seconds, F.lit(False)))


def mark_late(
    df: DataFrame,
    fraction: float = LATE_FRACTION,
    min_delay: int = LATE_DELAY_MIN_SECONDS,
    max_delay: int = LATE_DELAY_MAX_SECONDS,
    seed: int = 0,
) -> DataFrame:
    """Hold back a fraction of the events by a delay from a range.

    The choice is a function of the event id, so a rerun marks the same rows.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    if not 0 <= min_delay <= max_delay:
        raise ValueError("delays must satisfy 0 <= min_delay <= max_delay")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("event_id")))
    roll = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    spread = F.conv(F.substring(digest, 9, 8), 16, 10).cast("long")
    chosen = roll < F.lit(int(fraction * 2**32))
    delay = F.lit(min_delay) + spread % F.lit(max_delay - min_delay + 1)
    arrival = parse_time(F.col("arrival_time"))
    return df.withColumns({
        "is_late_arrival": chosen,
        "late_arrival_delay_seconds": F.when(chosen, delay),
        "arrival_time": F.when(chosen, plus_seconds(arrival, delay)).otherwise(arrival),
    })


# --- size, partitions, duplicates --------------------------------------------
def payload_bytes(df: DataFrame) -> Column:
    """Size of the event as JSON; null members count, as the wire form has them."""
    names = [f.name for f in RAW_EVENT.fields if f.name in df.columns]
    return F.octet_length(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))


def within_payload_limit(df: DataFrame, limit: int = MAX_PAYLOAD_BYTES) -> DataFrame:
    return df.filter(payload_bytes(df) <= limit)


def with_hour_partitions(df: DataFrame, column: str = "arrival_time") -> DataFrame:
    at = parse_time(F.col(column))
    return df.withColumns({
        "year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at), "hour": F.hour(at),
    })


def with_day_partitions(df: DataFrame, column: str) -> DataFrame:
    at = F.col(column)
    return df.withColumns({"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)})


def unknown_session_filled(df: DataFrame) -> DataFrame:
    return df.withColumn("session_id", F.coalesce("session_id", F.lit(UNKNOWN_SESSION)))


def id_hash() -> Column:
    return F.xxhash64("event_id")


def dedup_events(df: DataFrame) -> DataFrame:
    """One row per event id: the first delivery, whole ties broken by content.

    Two passes. The first counts hashes of ids, eight bytes each, in a hash
    aggregation. Rows whose hash came once are done: they are neither shuffled nor
    sorted where the repeated hashes can be broadcast. Only the others are
    compared, by their ids, so ids that share a hash stay apart. Their minimum
    is combined map-side, so an id delivered a billion times reaches the shuffle once
    per task, and a retried task picks the same row.
    """
    own = id_hash()
    counts = df.select(own.alias("id_hash")).groupBy("id_hash").agg(F.count(F.lit(1)).alias("copies"))
    repeated = counts.where("copies > 1").select("id_hash")
    alone = df.join(repeated, own == F.col("id_hash"), "left_anti")
    again = df.join(repeated, own == F.col("id_hash"), "left_semi")
    first = ["arrival_time"] + [c for c in df.columns if c not in ("event_id", "arrival_time")]
    kept = again.groupBy("event_id").agg(F.min(F.struct(*first)).alias("row"))
    return alone.unionByName(kept.select("event_id", "row.*").select(*df.columns))


def union_all_events(on_time: DataFrame, late: DataFrame) -> DataFrame:
    """Both stores as one; an event present in both counts once."""
    return dedup_events(on_time.unionByName(late, allowMissingColumns=True))


def merged_schema(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Additive change of layout: columns only one side has are null on the other."""
    return older.unionByName(newer, allowMissingColumns=True)
