import base64
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quarantine as q
from tidemark.schemas import STREAM_RECORD


def event(event_id, **more):
    base = {
        "event_id": event_id, "event_time": "2024-10-15T10:00:00+00:00", "arrival_time": "2024-10-15T10:00:01+00:00",
        "event_type": "view", "product_id": "p1", "category_id": None, "category_code": None, "brand": None,
        "price": 49.99, "user_id": "user_001", "session_id": "sess_abc", "is_late_arrival": False,
        "late_arrival_delay_seconds": None,
    }
    return {**base, **more}


def b64(text):
    return base64.b64encode(text.encode()).decode()


def record(payload, n=1):
    return {"kinesis": {"partitionKey": "u", "sequenceNumber": f"seq{n:03d}", "data": payload,
                        "approximateArrivalTimestamp": 1729001000.0}}


def records_of(spark, *payloads):
    rows = [(p, f"seq{i}", 1729001000.0 + i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "data string, sequence string, arrival double")


def test_decode_skips_what_is_broken(spark):
    df = records_of(spark, b64(json.dumps(event("e9"))), b64("NOT VALID JSON {{{"), "!!!", None, b64("5"))
    good = q.decode_records(df).collect()
    assert [(r.event_id, r.sequence, r.arrival) for r in good] == [("e9", "seq0", 1729001000.0)]
    assert {r.sequence for r in q.undecodable_records(df).collect()} == {"seq1", "seq2", "seq3", "seq4"}


def test_wrong_field_type_keeps_the_event(spark):
    df = records_of(spark, b64(json.dumps(event("e1", price="cheap"))))
    row = q.decode_records(df).collect()[0]
    assert row.event_id == "e1" and row.price is None


def test_envelope(spark):
    schema = T.StructType([T.StructField("Records", T.ArrayType(STREAM_RECORD))])
    body = {"Records": [record(b64(json.dumps(event(f"e{i}"))), i) for i in range(3)]}
    df = spark.createDataFrame([(json.dumps(body),)], "v string").select(F.from_json("v", schema).alias("e")).select("e.*")
    rows = q.decode_records(q.envelope_records(df)).collect()
    assert [(r.event_id, r.sequence) for r in rows] == [("e0", "seq000"), ("e1", "seq001"), ("e2", "seq002")]


def test_line_split(spark):
    lines = spark.createDataFrame([(json.dumps(event("e1")),), ("NOT JSON {{{",), ('{"event_id": "e2"',)], "value string")
    good, bad = q.malformed_split(lines)
    assert [r.event_id for r in good.collect()] == ["e1"]
    assert {r.raw_line for r in bad.collect()} == {"NOT JSON {{{", '{"event_id": "e2"'}
    assert good.count() == 1 and bad.count() == 2


def letters(spark):
    two = {"Records": [record(b64(json.dumps(event("e1")))), record(b64(json.dumps(event("e2"))), 2)]}
    mixed = {"Records": [{"kinesis": {"data": "NOT_VALID_BASE64!!!!!!"}}, record(b64(json.dumps(event("e3"))))]}
    info = {"KinesisBatchInfo": {"shardId": "shardId-0", "startSequenceNumber": "1", "endSequenceNumber": "9",
                                 "batchSize": 3, "streamArn": "stream"},
            "requestContext": {"condition": "RetryAttemptsExhausted"}}
    rows = [("m1", json.dumps(two)), ("m2", json.dumps(mixed)), ("m3", json.dumps(info)), ("m4", "NOT JSON {{{"),
            ("m5", json.dumps({"Records": []}))]
    return spark.createDataFrame(rows, "message_id string, body string")


def test_dead_letters(spark):
    df = letters(spark)
    found = sorted((r.message_id, r.event_id) for r in q.dlq_decode(df).collect())
    assert found == [("m1", "e1"), ("m1", "e2"), ("m2", "e3")]
    assert [(r.message_id, r.condition, r.batchSize) for r in q.needs_refetch(df).collect()] == [
        ("m3", "RetryAttemptsExhausted", 3)]


def test_replay_counts(spark):
    df = letters(spark)
    assert q.dlq_replay_counts(df).collect()[0].asDict() == {"replayed": 3, "skipped": 3, "deleted": 0}
    assert q.dlq_replay_counts(df, dry_run=False).collect()[0].asDict() == {"replayed": 3, "skipped": 3, "deleted": 2}
    assert q.dlq_replay_counts(df.limit(0), dry_run=False).collect()[0].asDict() == {
        "replayed": 0, "skipped": 0, "deleted": 0}
    done = spark.createDataFrame([("m1",)], "message_id string")
    assert q.dlq_replay_counts(q.not_yet_replayed(df, done)).collect()[0].replayed == 1


def test_typed_items(spark):
    item = {"session_id": {"S": "s1"}, "event_count": {"N": "3"}, "converted": {"BOOL": True},
            "event_types_seen": {"L": [{"S": "view"}, {"S": "cart"}]}, "tags": {"SS": ["a", "b"]}}
    df = spark.createDataFrame([(json.dumps(item),)], "item string")
    row = q.typed_json_flatten(df).collect()[0]
    assert row.scalars == {"session_id": "s1", "event_count": "3", "converted": "true"}
    assert row.lists == {"event_types_seen": ["view", "cart"], "tags": ["a", "b"]}
    flat = q.snapshot_from_items(df).collect()[0]
    assert (flat.session_id, flat.event_count, flat.converted, flat.cart_total) == ("s1", "3", "true", None)
