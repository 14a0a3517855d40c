"""Decoding of stream records, the split of what cannot be decoded, and the
replay of dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import DEAD_LETTER_BODY, RAW_EVENT

# Rows of ``from_json`` keep text that did not fit the schema in this member.
_CORRUPT = "_corrupt_record"
_EVENT = T.StructType(RAW_EVENT.fields + [T.StructField(_CORRUPT, T.StringType())])


def parse_event(text: Column) -> Column:
    """JSON text to a raw event with the corrupt-record member."""
    return F.from_json(text, _EVENT, {"columnNameOfCorruptRecord": _CORRUPT})


_FIELDS = [f.name for f in RAW_EVENT.fields]


def with_event(rows: DataFrame, text: Column) -> DataFrame:
    """Adds the members of the parsed event, and ``malformed`` where nothing
    could be read from the text.

    A field of the wrong type alone is no reason: it is null, the rest of the
    event stays, and the schema rules decide about it. The event leaves a
    generator, below which Catalyst pushes no filter on it; a filter on
    ``malformed`` would otherwise parse every text a second time.
    """
    keep = [F.col(c) for c in rows.columns]
    empty = F.coalesce(F.trim(text) == "", F.lit(True))
    parsed = rows.select(*keep, empty.alias("_empty"), F.inline(F.array(parse_event(text))))
    nothing = F.expr(f"coalesce({', '.join(f'CAST({name} AS string)' for name in _FIELDS)}) IS NULL")
    return parsed.withColumn(
        "malformed", nothing & (F.col("_empty") | F.col(_CORRUPT).isNotNull())
    ).drop("_empty", _CORRUPT)


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text lines as ``raw_line``, the event's members, and ``malformed``.
    Columns of ``lines`` that an event has too are replaced by the event's."""
    others = [c for c in lines.columns if c != column and c not in _FIELDS]
    rows = lines.select(F.col(column).alias("raw_line"), *others)
    return with_event(rows, F.col("raw_line"))


def events_of(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("malformed")).select(*_FIELDS)


def malformed_split(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(events, quarantine) of a set of text lines."""
    parsed = parse_lines(lines, column)
    bad = parsed.filter(F.col("malformed")).select("raw_line", F.lit("not_json").alias("reason"))
    return events_of(parsed), bad


def decode_payload(data: Column) -> Column:
    """Base64 text to JSON text; null when it is not base64 or not UTF-8."""
    return F.try_validate_utf8(F.try_to_binary(data, F.lit("base64")).cast("string"))


def parse_records(records: DataFrame) -> DataFrame:
    """Stream records (``data``, ``sequence``, ``arrival``) with the event's
    members, ``malformed`` where the payload cannot be decoded."""
    keep = [c for c in records.columns if c not in _FIELDS]
    rows = records.select(*keep, decode_payload(F.col("data")).alias("payload"))
    return with_event(rows, F.col("payload"))


def decode_records(records: DataFrame) -> DataFrame:
    """The events of the records that decode, with sequence and arrival."""
    return parse_records(records).filter(~F.col("malformed")).select(*_FIELDS, "sequence", "arrival")


def undecodable_records(records: DataFrame) -> DataFrame:
    return parse_records(records).filter(F.col("malformed")).select(
        "data", "sequence", "arrival", F.lit("undecodable").alias("reason")
    )


def envelope_records(envelopes: DataFrame) -> DataFrame:
    """Batches of stream records to one row per record."""
    return envelopes.select(F.explode("Records").alias("r")).select(
        F.col("r.kinesis.data").alias("data"),
        F.col("r.kinesis.sequenceNumber").alias("sequence"),
        F.col("r.kinesis.approximateArrivalTimestamp").alias("arrival"),
    )


# --- dead letters --------------------------------------------------------------
def dead_letter_records(messages: DataFrame) -> DataFrame:
    """Messages (``message_id``, ``body``) to one row per embedded record.

    Rows that embed nothing stay, with a null ``data``. ``kind`` tells whether
    the message holds records, only the position of a failed batch, or neither.
    """
    parsed = messages.withColumn("parsed", F.from_json("body", DEAD_LETTER_BODY))
    kind = (
        F.when(F.col("parsed.Records").isNotNull(), "records")
        .when(F.col("parsed.KinesisBatchInfo").isNotNull(), "batch_info")
        .otherwise("unreadable")
    )
    return parsed.select(
        "message_id", kind.alias("kind"), F.col("parsed.KinesisBatchInfo").alias("batch_info"),
        F.col("parsed.requestContext.condition").alias("condition"),
        F.explode_outer("parsed.Records").alias("r"),
    ).select(
        "message_id", "kind", "batch_info", "condition",
        F.col("r.kinesis.data").alias("data"),
        F.col("r.kinesis.sequenceNumber").alias("sequence"),
        F.col("r.kinesis.approximateArrivalTimestamp").alias("arrival"),
    )


def dlq_decode(messages: DataFrame) -> DataFrame:
    """Events embedded in dead letters; what does not decode is left out."""
    return parse_records(dead_letter_records(messages)).filter(~F.col("malformed")).select(
        "message_id", *_FIELDS
    )


def needs_refetch(messages: DataFrame) -> DataFrame:
    """Letters that only name the range of the stream to read again."""
    return dead_letter_records(messages).filter(F.col("kind") == "batch_info").select(
        "message_id", "condition", "batch_info.*"
    )


def not_yet_replayed(messages: DataFrame, replayed_ids: DataFrame) -> DataFrame:
    return messages.join(replayed_ids.select("message_id").distinct(), "message_id", "left_anti")


def dlq_replay_counts(messages: DataFrame, dry_run: bool = True) -> DataFrame:
    """One row: events replayed, letters without events, letters removed.

    A letter is skipped when none of its records decodes. A dry run counts the
    same events and removes nothing.
    """
    per_letter = parse_records(dead_letter_records(messages)).groupBy("message_id").agg(
        F.count_if(~F.col("malformed")).alias("events")
    )
    removed = F.lit(0).cast("bigint") if dry_run else F.count_if(F.col("events") > 0)
    return per_letter.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("replayed"),
        F.count_if(F.col("events") == 0).alias("skipped"),
        removed.alias("deleted"),
    )


# --- typed JSON items ------------------------------------------------------------
# Members of one typed value: text, number as text, flag, set of texts, list.
TYPED_ITEM = (
    "map<string, struct<S:string, N:string, BOOL:boolean, SS:array<string>,"
    " L:array<map<string,string>>>>"
)


def typed_json_flatten(items: DataFrame, column: str = "item") -> DataFrame:
    """Typed JSON items to maps of plain values.

    Scalars go to ``scalars`` (numbers stay text, flags become true/false);
    sets and lists go to ``lists``.
    """
    parsed = F.from_json(F.col(column), TYPED_ITEM)
    scalar = F.transform_values(parsed, lambda _, v: F.coalesce(v["S"], v["N"], v["BOOL"].cast("string")))
    listed = F.transform_values(
        parsed, lambda _, v: F.coalesce(v["SS"], F.transform(v["L"], lambda x: F.map_values(x)[0]))
    )
    return items.select(
        *[c for c in items.columns if c != column],
        F.map_filter(scalar, lambda _, v: v.isNotNull()).alias("scalars"),
        F.map_filter(listed, lambda _, v: v.isNotNull()).alias("lists"),
    )


def snapshot_from_items(items: DataFrame, column: str = "item") -> DataFrame:
    """Typed items as rows of the all-text snapshot layout."""
    flat = typed_json_flatten(items, column)
    names = (
        "session_id", "user_id", "event_count", "cart_total", "conversion_value",
        "converted", "session_start", "last_event_time", "duration_seconds",
    )
    return flat.select(*[F.col("scalars")[n].alias(n) for n in names])
