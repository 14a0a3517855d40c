"""Column layouts and fixed values shared by every operator.

Timestamps are ``TimestampType`` everywhere once an event has been made
canonical; text forms exist only at the edges (raw NDJSON, state snapshots).
"""

from pyspark.sql import types as T

# --- Fixed values: these must stay as they are for results to agree ---------
SESSION_TIMEOUT_SECONDS = 1800  # a gap strictly above this opens a new session
EVENT_TYPES = ("view", "cart", "purchase")
LATE_FRACTION = 0.05
LATE_DELAY_MIN_SECONDS = 120
LATE_DELAY_MAX_SECONDS = 900
LATE_THRESHOLD_SECONDS = 300
STATE_TTL_SECONDS = 7200
TRIGGER_INTERVAL = "5 seconds"
REVENUE_TOLERANCE = 0.01
MAX_PAYLOAD_BYTES = 1048576
LAG_ALARM_MS = 60000
LAG_ALARM_MINUTES = 3
ERROR_ALARM_PCT = 5
ERROR_ALARM_MINUTES = 5
THROUGHPUT_WINDOW_SECONDS = 30
TOP_RESTATED = 20
TOP_DETAIL = 100
SPEED_LATENCY_LABEL = "< 30 seconds"
BATCH_LATENCY_LABEL = "~ 8 hours"
UNKNOWN_SESSION = "unknown"
# Texts that a CSV reader takes for a missing value.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# ---------------------------------------------------------------------------

# Money is added as decimals: sums are exact, do not depend on row order, and
# stay in the fixed-width buffers of the hash aggregation. A price is exact to
# six decimals below 10^22; from there on it is a violation of the contract.
PRICE_TYPE = "decimal(28,6)"
MONEY_TYPE = "decimal(38,6)"

# Sessions with more source ids than this carry them in the link table only;
# that table is complete for every session.
INLINE_ID_LIMIT = 100_000

RAW_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("arrival_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("is_late_arrival", T.BooleanType()),
    T.StructField("late_arrival_delay_seconds", T.LongType()),
])

# Raw events with times as timestamps, and the time that orders them.
CANONICAL_EVENT = T.StructType([
    T.StructField(f.name, T.TimestampType() if f.name in ("event_time", "arrival_time") else f.dataType)
    for f in RAW_EVENT.fields
] + [T.StructField("effective_time", T.TimestampType())])

SHOP_CSV = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("user_session", T.StringType()),
])

BATCH_SESSION = T.StructType([
    T.StructField("batch_session_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_start", T.TimestampType()),
    T.StructField("session_end", T.TimestampType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("cart_total", T.DoubleType()),
    T.StructField("conversion_value", T.DoubleType()),
    T.StructField("converted", T.BooleanType()),
    T.StructField("duration_seconds", T.LongType()),
    T.StructField("late_arrival_count", T.LongType()),
    T.StructField("had_restatement", T.BooleanType()),
    T.StructField("original_session_ids", T.ArrayType(T.StringType())),
    T.StructField("session_date", T.DateType()),
])

SESSION_LINK = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("batch_session_id", T.StringType()),
    T.StructField("batch_cart_total", T.DoubleType()),
    T.StructField("batch_conversion_value", T.DoubleType()),
    T.StructField("batch_event_count", T.LongType()),
    T.StructField("batch_converted", T.BooleanType()),
    T.StructField("batch_duration_seconds", T.LongType()),
    T.StructField("late_arrival_count", T.LongType()),
    T.StructField("had_restatement", T.BooleanType()),
    T.StructField("batch_session_date", T.DateType()),
])

SPEED_SNAPSHOT = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "session_id", "user_id", "event_count", "cart_total",
        "conversion_value", "converted", "session_start", "last_event_time",
        "duration_seconds", "date_partition",
    )
])

# One record of the stream: the payload is base64 text of one raw event. The
# member names here and below are fixed values of the stored formats.
STREAM_RECORD = T.StructType([
    T.StructField("eventID", T.StringType()),
    T.StructField("kinesis", T.StructType([
        T.StructField("partitionKey", T.StringType()),
        T.StructField("sequenceNumber", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("approximateArrivalTimestamp", T.DoubleType()),
    ])),
])

DEAD_LETTER_BODY = T.StructType([
    T.StructField("Records", T.ArrayType(STREAM_RECORD)),
    T.StructField("KinesisBatchInfo", T.StructType([
        T.StructField("shardId", T.StringType()),
        T.StructField("startSequenceNumber", T.StringType()),
        T.StructField("endSequenceNumber", T.StringType()),
        T.StructField("batchSize", T.LongType()),
        T.StructField("streamArn", T.StringType()),
    ])),
    T.StructField("requestContext", T.StructType([
        T.StructField("condition", T.StringType()),
    ])),
])
